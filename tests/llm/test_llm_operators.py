"""Every training-data query against a plain version, on awkward, empty and generated tables."""

import collections
import hashlib
import itertools
import math
import os
import random
import zlib

import duckdb
import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import bestfit, bloom_lm, chat, common, components, decontam, host_rules, kd_shards, pu_quality, simhash_ring, trie_counts, warc_chain
from tidemark.llm.common import shared_path
from tidemark.llm.oracle import SQL
from tidemark.llm.queries import QUERIES

ITEMS = [(1, "the cat sat on the mat and the dog ran after the red ball in the park"), (2, "Quite Different words"),
         (3, None), (4, "..."), (None, "nothing else is said here"), (5, "quite different WORDS"), (6, "one")]
LABELS = [(i, 1, 0) for i in range(100, 130)] + [(8, 0, 0), (13, 0, None), (None, 1, 0), (7, None, None), (9, 0, 0), (9, 1, 0)]
TURNS = [(1, 0, "user", "hi"), (1, 1, "assistant", "</s>[INST] \\- \\\\ <|end|>"), (1, 2, None, None), (2, None, "assistant", ""),
         (2, 0, "assistant", "b"), (2, 0, "assistant", "a"), (2, 0, "assistant", "a"), (None, 0, "user", "x"), (3, 0, "assist<|text|>ant", "y"),
         *[(4, i, ("user", "assistant")[i % 2], f"turn {i} " * (i % 5)) for i in range(300)], (5, 0, "assistant", "[INST][/INST]" * 9 + "")]
PAGES = [(1, "http://a/", "x" * 1000), (2, None, "x" * 1000), (3, "u", "x" * 999), (4, "u", "x" * 999), (5, "u\r\nWARC-Type: z%0D", None),
         (6, "", ""), (7, "é", "é" * 700), (8, "é", "é" * 700), (8, "é", "é" * 700), (None, "n", "x" * 1000),
         (9, "m", "a" + "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 2\r\n\r\nhi\r\n\r\n" * 3 + "WARC/1.1\r\n"),
         (10, "m", "WARC/1.1\r\n\r\n\r\n\r\n"), (11, "m", "b" * 300_000)]


def write(spark, name_rows, clash=False):
    """Tables as the driver lays them out; ``clash`` adds columns with names that operators use."""
    path = shared_path(spark, "test-tables")
    for name, (rows, schema) in name_rows.items():
        df = spark.createDataFrame(rows, schema)
        if clash:
            df = df.withColumns({c: F.lit(i) for i, c in enumerate(brute.CLASHES)})
        df.write.parquet(f"{path}/{name}.parquet")
    return path


SCHEMAS = {"documents": brute.DOCUMENTS, "benchmark": "item_id long, text string", "labels": "doc_id long, quality int, toxic int",
           "conversations": "conv_id long, turn long, role string, text string", "pages": "page_id long, url string, html string"}


@pytest.fixture(scope="module")
def awkward(spark):
    rows = {"documents": brute.awkward_documents(), "benchmark": ITEMS, "labels": LABELS, "conversations": TURNS, "pages": PAGES}
    return write(spark, {k: (v, SCHEMAS[k]) for k, v in rows.items()}, clash=True)


@pytest.fixture(scope="module")
def short(spark):
    """The same without the texts that take DuckDB's list functions minutes."""
    docs = [r for r in brute.awkward_documents() if len(r[1] or "") < 50_000]
    rows = {"documents": docs, "benchmark": ITEMS, "labels": LABELS, "conversations": TURNS, "pages": PAGES}
    return write(spark, {k: (v, SCHEMAS[k]) for k, v in rows.items()}, clash=True)


@pytest.fixture(scope="module")
def empty(spark):
    return write(spark, {k: ([], s) for k, s in SCHEMAS.items()})


def docs_of():
    return [(r[0], r[1]) for r in brute.awkward_documents()]


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)


def same(a, b):
    return sorted(map(tuple, a), key=repr) == sorted(map(tuple, b), key=repr)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_empty_tables(spark, empty, name):
    got = QUERIES[name](spark, empty).collect()
    assert [r["conv_id"] for r in got] == [-1] if name == "op5_chat" else got == []


def test_tokenizers_agree():
    t = bestfit.Tokenizer.load(bestfit.tokenizer_path(), bestfit.tokenizer_path(bestfit.RANKS))
    whole = lambda s: t.file.encode(s, add_special_tokens=False).ids
    ids = lambda s: np.frombuffer(t.ids(s), "<u4").tolist()
    r = random.Random(0)
    parts = ["a", "foo", " ", "  ", "\n", "\n\n", "'s", "'!", "..", "\u2026", "\u00b2", "\u00bd", "\u00e9", "1", "23", "_", "\t", "\xa0", "\u3000",
             "\U0001f600", "e\u0301", "\x1c", "<|endoftext|>", "\u4e2d", "-", "don't", "I'll", "\u200b"]
    texts = ["".join(r.choices(parts, k=r.randint(0, 8))) for _ in range(5000)] + [t.file.decode([i]) for i in range(50256)] + [" " * 3_000_000 + "x"]
    assert all(whole(s) == ids(s) for s in texts)


@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_on_awkward_tables(spark, short, name):
    con = duckdb.connect()
    for t in SCHEMAS:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{short.removeprefix('file:')}/{t}.parquet/*.parquet')")
    want = con.sql(SQL[name])
    assert same(rows(QUERIES[name](spark, short), *want.columns), want.fetchall())


def test_rules_measurements(spark, awkward):
    got = {(r[0], tuple(r[1:6])) for r in QUERIES["op1_quality_rules"](spark, awkward).collect()}
    assert got == {(d, brute.base_metrics(t)) for d, t in docs_of()}


def test_bad_host_is_rejected_and_prior_shrinks(spark):
    good = "a perfectly ordinary sentence that has enough different words to pass every base rule"
    docs = [(i, good + f" {i}", "en", "clean", 0) for i in range(60)]
    docs += [(100 + i, "bad" if i < 38 else good, "en", "junk", 0) for i in range(40)] + [(200, "bad", "en", "small", 0), (201, good, "en", "small", 0)]
    df = spark.createDataFrame(docs, brute.DOCUMENTS)
    kept = {r["doc_id"]: (r["base_failed"], r["kept"]) for r in host_rules.quality_report(df).collect()}
    assert kept[139] == (False, False)                     # passes, but its host does not
    assert kept[201] == (False, True) and kept[0] == (False, True) and kept[100] == (True, False)
    assert host_rules.passing(df).columns == df.columns


def test_position_packing_matches_whole_sort(spark, monkeypatch):
    texts = [(" ".join(random.Random(i).choices("abc", k=200)),) for i in range(5)]
    df = spark.createDataFrame(texts, "t string")
    monkeypatch.setattr(host_rules, "POSITION_BITS", 3)    # forces the whole-sort branch
    got = [r[0] for r in df.select(host_rules.repeated_words(host_rules.words(F.col("t")))).collect()]
    assert got == [brute.base_metrics(t)[4] for t, in texts]


def test_classifier_scores(spark, awkward):
    got = QUERIES["op2_quality_classifier"](spark, awkward).collect()
    assert sorted((r["doc_id"] for r in got), key=repr) == sorted((d for d, _ in docs_of()), key=repr)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) and r["held_out"] == (brute.crc_mod(r["doc_id"], 5) == 0) for r in got)


def test_classifier_finds_junk_it_never_saw_labelled(spark):
    r = random.Random(5)
    vocabulary = ["".join(r.choices("abcdeilnorst", k=r.randint(2, 9))) for _ in range(400)]
    docs, labels = [], []
    for i in range(1200):
        w = r.choices(vocabulary, k=r.randint(20, 80))
        bad = i % 4 == 0
        docs.append((i, " ".join(x + "$$$" if bad else x for x in w), "en", "s", 0))
        labels.append((i, int(not bad), 0))
    d, lab = spark.createDataFrame(docs, brute.DOCUMENTS), spark.createDataFrame(labels, SCHEMAS["labels"])
    got = {x["doc_id"]: x for x in pu_quality.scored(d, lab).collect()}
    held = [i for i in got if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == (i % 4 != 0) for i in held]) > 0.98
    model = pu_quality.train(d, lab)
    assert abs(model.prior - 0.75) < 0.08
    flipped = lab.withColumn("quality", F.when(pu_quality.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert np.allclose(pu_quality.train(d, flipped).weights, model.weights)      # held-out labels are not read


def test_lm_base(spark, awkward):
    got = QUERIES["op3_lm_scoring"](spark, awkward).collect()
    want = brute.base_scores(docs_of())
    cut = lambda x: (x[0], x[1], x[2], x[3], x[4], round(x[5], 3))
    assert same([cut(tuple(r)) for r in got], [cut(w) for w in want])
    assert all(r["score"] < 0 for r in got)


def test_lm_counts_in_small_parts(spark, monkeypatch, awkward):
    """Counts flushed often and dealt to many segments, most of them without an n-gram of a chunk."""
    monkeypatch.setattr(bloom_lm, "FLUSH_TOKENS", 1000)
    monkeypatch.setattr(bloom_lm, "segments_for", lambda size: 5000)
    got = QUERIES["op3_lm_scoring"](spark, awkward).collect()
    assert same([(r[0], r[3], round(r[5], 3)) for r in got], [(w[0], w[3], round(w[5], 3)) for w in brute.base_scores(docs_of())])


def test_lm_segments_grow_with_the_text():
    assert [bloom_lm.segments_for(b) for b in (0, 1 << 20, 512 << 20)] == [64, 64, 256]
    for power in range(28, 50):                              # to 0.5 PB: at most 16 MB of text each
        n = bloom_lm.segments_for(1 << power)
        assert n < 1 << 31 and (1 << power) / n <= 16 << 20
    for runs in ([], [3], [0, 0, 1, 5, 5, 5, 9]):
        got = [(int(s), b - a) for part, cuts in bloom_lm.runs_of(np.array(runs, np.int64), 2) for s, (a, b) in zip(part, cuts, strict=True)]
        assert got == sorted(collections.Counter(runs).items())


def test_lm_score_against_exact_counts(spark):
    """The model's score within the width of the levels of the score from exact counts."""
    r = random.Random(11)
    words = [f"w{i}" for i in range(60)]
    docs = [(i, " ".join(r.choices(words, [1 / (k + 1) for k in range(60)], k=r.randint(0, 80)))) for i in range(200)]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], brute.DOCUMENTS)
    got = {x["doc_id"]: (x["n_tokens"], x["score"]) for x in bloom_lm.scored(d).collect()}
    want = brute.bigram_scores(docs, bloom_lm.MIX)
    assert got.keys() == want.keys()
    # a level is 1.5 wide and its middle stands for it: the quotient of two counts is off by 1.5 at most
    close = [abs(got[i][1] - want[i]) <= math.log10(1.5) * got[i][0] for i in want]
    assert all(close)
    assert np.corrcoef([got[i][1] / got[i][0] for i in want], [want[i] / got[i][0] for i in want])[0, 1] > 0.9


def test_bloom_levels(spark):
    texts = [("a b " * 50 + "c d",), ("a b c",), ("x y " * 7,)]
    model, counts = bloom_lm.fit(spark.createDataFrame(texts, "text string"))
    exact = collections.Counter()
    for t, in texts:
        w = t.split()
        exact.update(zip(w, w[1:]))
    one = lambda w: np.uint64(bloom_lm.xxhash.xxh64_intdigest(w.encode()))
    for (a, b), n in exact.items():
        level = model.levels(bloom_lm.mixed(np.array([one(a)]), np.array([one(b)])), 2)
        assert level >= bloom_lm.levels_of(np.array([n]))             # never too low: no false negatives
    missing = model.levels(bloom_lm.mixed(np.arange(1, 3000, dtype=np.uint64), np.uint64(9)), 2)
    assert (missing > 0).mean() < 0.1
    assert counts.agg(F.sum("c")).first()[0] == model.tokens == sum(len(t.split()) + 1 for t, in texts)
    assert bloom_lm.levels_of(np.array([0, 1, 2, 3])).tolist() == [0, 1, 2, 3]


def test_lm_rare_pairs_count_in_a_large_corpus(spark):
    """0.54 GB of text, nearly all of it one long word: pairs seen once are still in the filter."""
    many = spark.range(540).select(F.lit("a b").alias("text"), F.expr("repeat('z', 1000000)").alias("z"))
    texts = many.select(F.concat_ws(" ", "text", "z").alias("text")).unionByName(spark.createDataFrame([("rare pair",)], "text string"))
    model, _ = bloom_lm.fit(texts)
    one = lambda w: np.array([bloom_lm.xxhash.xxh64_intdigest(w)], np.uint64)
    assert model.levels(one(b"rare"), 1) >= 1
    assert model.levels(bloom_lm.mixed(one(b"rare"), one(b"pair")), 2) >= 1


def test_lm_scores_in_chunks(spark, monkeypatch, awkward):
    whole = sorted(map(str, QUERIES["op3_lm_scoring"](spark, awkward).collect()))
    monkeypatch.setattr(bloom_lm, "CHUNK_TOKENS", 1)
    monkeypatch.setattr(common, "BATCH_ROWS", 3)
    assert sorted(map(str, QUERIES["op3_lm_scoring"](spark, awkward).collect())) == whole


def test_contamination(spark, awkward):
    got = QUERIES["op4_decontamination"](spark, awkward).collect()
    assert same(got, brute.contamination(docs_of(), ITEMS))


def test_contamination_in_blocks(spark):
    r = random.Random(3)
    words = [f"w{i}" for i in range(6)]
    docs = [(i, " ".join(r.choices(words, k=r.randint(0, 60)))) for i in range(50)]
    items = [(i, " ".join(r.choices(words, k=r.choice([1, 2, 3, 4, 5, 12])))) for i in range(30)] + [(99, docs[7][1]), (98, docs[8][1])]
    d = spark.createDataFrame([(i, t, None, None, None) for i, t in docs], brute.DOCUMENTS)
    m = decontam.marked(d, spark.createDataFrame(items, SCHEMAS["benchmark"]), ["doc_id"], block_windows=7)
    got = [(x["doc_id"], x["n_words"], x["n_hit"], len(x["items"])) for x in m.select("row.doc_id", "n_words", "n_hit", "items").collect()]
    assert same(got, [w[:4] for w in brute.contamination(docs, items)])


def test_chat(spark, awkward):
    got = {r["conv_id"]: (r["n_turns"], r["turns_sha256"], r["loss_chars"], r["loss_sha256"]) for r in QUERIES["op5_chat"](spark, awkward).collect()}
    said = "</s>[INST] ok [/INST]"
    assert got == brute.conversations(TURNS + [(-1, 0, "user", said), (-1, 1, "assistant", said)])


def test_chat_finds_rewritten_history():
    def strips(turns):                                      # drops what earlier assistant turns said
        return "".join(f"[{r}]" + (t if r != "assistant" or i == len(turns) - 1 else "...") for i, (r, t) in enumerate(turns))
    turns = [("user", "a"), ("assistant", "long answer"), ("user", "b"), ("assistant", "c")]
    assert [x[4] for x in chat.spans(iter(turns), strips)] == [False, False, True, False]
    shouts = lambda turns: "".join(f"<{r}>{t.upper()}" for r, t in turns)
    for (_, t), piece, a, b, rewrote in chat.spans(iter(turns), shouts):
        assert piece[a:b] == t.upper() and not rewrote


def plain_spans(turns, template):
    """Every prefix rendered whole: what each adds, and whether it rewrote."""
    out = [template(turns[:k]) for k in range(len(turns) + 1)]
    got = []
    for k, (a, b) in enumerate(itertools.pairwise(out)):
        same = len(os.path.commonprefix([a, b]))
        got.append((b if k == 0 and same == len(a) else b[same:], same < len(a)))
    return got


def numbered(turns):
    return "".join(f"{i}:{t};" for i, (_, t) in enumerate(turns))


def forgets(turns):                                         # drops the first turn's text at the 200th turn
    return "".join("..." if i == 0 and len(turns) >= 200 else f"[{t}]" for i, (_, t) in enumerate(turns))


def merges(turns):                                          # an opening system turn goes into every later user turn
    system = turns[0][1] if turns else ""
    return "".join(f"<{r}>{system if i > 150 and r == 'user' else ''}{t}" for i, (r, t) in enumerate(turns))


def trims(turns):                                           # shows the last 140 turns only
    return "<s>" + "".join(f"({t})" for _, t in turns[-140:])


@pytest.mark.parametrize("history", [1, 3, 64])
@pytest.mark.parametrize("n", [1, 5, 128, 129, 300, 520])
@pytest.mark.parametrize("template", [numbered, forgets, merges, trims, chat.turn_template])
def test_chat_equals_whole_prefixes(template, n, history):
    turns = [(("user", "assistant")[i % 2], f"t{i}") for i in range(n)]
    got = list(chat.spans(iter(turns), template, history))
    assert [x[0] for x in got] == turns
    assert [(x[1], x[4]) for x in got] == plain_spans(turns, template)
    if template is not trims:
        assert all(p[a:b] == t for (_, t), p, a, b, rewrote in got if not rewrote)


def test_chat_cost_of_long_conversations():
    """A template that needs no history is rendered over a number of turns in proportion to the conversation's."""
    seen = [0]

    def counted(turns):
        seen[0] += len(turns)
        return chat.turn_template(turns)
    for n in (2000, 8000):
        seen[0] = 0
        turns = [("user", f"t{i}") for i in range(n)]
        assert "".join(x[1] for x in chat.spans(iter(turns), counted)) == chat.turn_template(turns)
        assert seen[0] < 2 * 128 * n + 4 * n


def test_chat_finds_text_among_private_use_characters():
    icons = "\ue000\ue001\ue002\uf8ff\ue001\ue000\ue002\ue001"
    turns = [("user", icons), ("assistant", icons), ("assistant", "\ue000" + icons * 3), ("assistant", "plain")]
    for (_, t), piece, a, b, _ in chat.spans(iter(turns), chat.turn_template):
        assert piece[a:b] == t


def test_chat_escape_round_trip():
    parts = ["\\", "-", "<|", "turn", "|>", "<|end|>", "</s>", "[INST]", "[/INST]", "[", "a"]
    for n in range(4):
        for t in map("".join, itertools.product(parts, repeat=n)):
            e = chat.escape(t)
            assert chat.unescape(e) == t and not any(c in e for c in chat.CONTROLS)
    many = [("user", f"t{i}") for i in range(500)]
    whole = "".join(x[1] for x in chat.spans(iter(many), chat.turn_template))
    assert whole == chat.turn_template(many) and chat.read_turns(whole) == many


def test_sharding(spark, awkward):
    got = QUERIES["op6_sharding"](spark, awkward).collect()
    want = [(d, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t in docs_of()]
    assert same([r[:3] for r in got], want)
    assert {r["shard"] for r in got} <= set(range(24))
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("shards", [2, 7, 24])
def test_shards_equal_a_plain_tree(spark, shards):
    """Languages, sources and lengths that all differ, so every cut has one right place."""
    r = random.Random(shards)
    n = 600
    langs, sources, lengths = r.sample(range(n), n), r.sample(range(n), n), r.sample(range(1, 2 * n), n)
    docs = [(i, "x" * lengths[i], f"language {langs[i]:05}", f"source {sources[i]:05}", 0) for i in range(n)]
    got = collections.defaultdict(set)
    for x in kd_shards.sharded(spark.createDataFrame(docs, brute.DOCUMENTS).repartition(5), shards).collect():
        got[x["shard"]].add(x["doc_id"])
    logs = [math.log1p(k) for k in lengths]
    low, wide = min(logs), max(logs) - min(logs)
    rows = [(i, lengths[i] + 8, (langs[i] / (n - 1), sources[i] / (n - 1), (logs[i] - low) / wide)) for i in range(n)]
    assert set(map(frozenset, got.values())) == set(brute.kd_leaves(rows, shards))


def test_shards_are_even_with_hot_values(spark):
    r = random.Random(1)
    docs = [(i, "same text" if i % 3 == 0 else "x" * r.randint(1, 300), "en" if i % 2 else None, "hot" if i % 4 else f"s{i % 50}", 0) for i in range(6000)]
    df = spark.createDataFrame(docs, brute.DOCUMENTS)
    per = [x[0] for x in kd_shards.sharded(df).groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(per) == 24 and max(per) < 1.05 * min(per)
    assert kd_shards.sharded(df, target_bytes=100_000).agg(F.max("shard")).first()[0] + 1 == -(-sum(per) // 100_000)


def test_packing(spark, awkward):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(bestfit.tokenizer_path())
    got = QUERIES["op7_packing"](spark, awkward).collect()
    assert same([r[:5] for r in got], [(d, *p) for d, text in docs_of() for p in brute.pieces(text, t, 2048)])
    check_places(got, 2048)


def check_places(got, size):
    by = collections.defaultdict(list)
    for r in got:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_plan_is_as_good_as_best_fit_over_documents():
    r = random.Random(2)
    for _ in range(30):
        size = r.choice([8, 50, 200])
        lengths = [min(size, max(1, int(r.expovariate(3 / size)))) for _ in range(r.randint(1, 400))]
        used = collections.Counter()
        ranks = collections.Counter()
        for length, rank, n, first, offset in bestfit.plan(dict(collections.Counter(lengths)), size):
            assert rank == ranks[length] and n > 0
            ranks[length] += n
            for k in range(n):
                assert used[first + k] == offset           # places are filled in order, without gaps
                used[first + k] += length
        assert ranks == collections.Counter(lengths) and max(used.values()) <= size
        free = []
        for length in sorted(lengths, reverse=True):        # the same over documents
            fit = min((f for f in free if f >= length), default=None)
            if fit is not None:
                free.remove(fit)
            free.append((fit if fit is not None else size) - length)
        assert len(used) <= len(free) + 1


def test_near_duplicates(spark, awkward):
    assert same(QUERIES["op8_simhash"](spark, awkward).collect(), brute.near_duplicates(docs_of()))


@pytest.mark.parametrize(("chain", "hot"), [(1, 1 << 24), (2, 1 << 24), (3, 1 << 24), (2, 8)])
def test_links_of_random_fingerprints(spark, monkeypatch, chain, hot):
    monkeypatch.setattr(simhash_ring, "HOT_PAIRS", hot)     # 8: buckets go out in blocks
    monkeypatch.setattr(simhash_ring, "HOT_SIDE", 4)
    r = random.Random(chain)
    fps = {0}
    for _ in range(60):
        x = r.getrandbits(64)
        for _ in range(6):
            fps.add(x)
            for b in r.sample(range(64), r.randint(1, 5)):
                x ^= 1 << b
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    df = spark.createDataFrame([(f,) for f in signed], "fp long")
    roots = {x["node"]: x["root"] for x in components.connected_components(simhash_ring.links(df, 4, chain)).collect()}
    groups = collections.defaultdict(set)
    for f in signed:
        groups[roots.get(f, f)].add(f % (1 << 64))
    left, parts = set(fps), []
    while left:
        part, todo = set(), [left.pop()]
        while todo:
            x = todo.pop()
            part.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 4}
            left -= near
            todo += near
        parts.append(part)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, parts))


def test_components_of_long_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, i) for i in range(1001, 1200)] + [(7000, 7000), (8001, 8000), (8000, 8001)]
    got = {r["node"]: r["root"] for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, **{i: 1000 for i in range(1001, 1200)}, 8001: 8000}


def test_first_of_each_keeps_one_row(spark):
    df = spark.createDataFrame(brute.awkward_documents(), brute.DOCUMENTS).withColumn("uid", F.lit(1))
    kept = simhash_ring.first_of_each(df).collect()
    comp = brute.near_duplicates(docs_of())
    assert len(kept) == len({(c[2], c[1] if c[2] is None else "") for c in comp})
    assert kept[0].asDict().keys() == set(df.columns)


def test_archives(spark, awkward):
    got = QUERIES["op9_warc"](spark, awkward).collect()
    best = {}
    for p, _, h in PAGES:
        if h and len(h.encode()) >= 1000 and PAGES and sum(x[2] == h for x in PAGES) > 1:
            best[h] = max(best.get(h, -1), -1 if p is None else p)
    want = []
    for p, _, h in PAGES:
        b = (h or "").encode()
        again = h in best and best[h] != p
        want.append((p, len(b), hashlib.sha1(b).hexdigest(), "revisit" if again else "response", best[h] if again else None))
    assert same(got, want)


def test_plain_archives_are_read_in_splits(spark):
    path = shared_path(spark, "plain")
    def record(i, body):
        http = f"HTTP/1.1 200 OK\r\nContent-Length: {len(body.encode())}\r\n\r\n{body}"
        return f"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:{i}>\r\nContent-Length: {len(http.encode())}\r\n\r\n{http}\r\n\r\n"
    r = random.Random(4)
    fake = record(999, "fake")
    bodies = [r.choice(["", "é", fake, "x" * 50 + fake + "y", "WARC/1.1\r\n"]) + "z" * r.randint(0, 400) for _ in range(300)]
    whole = "".join(record(i, b) for i, b in enumerate(bodies))
    spark.createDataFrame([(whole[:-1],), ("no archive at all",)], "value string").repartition(2).write.option("lineSep", "\n").text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")
    try:
        got = {warc: bytes(p) for warc, p in warc_chain.read(spark, path).select("record_id", "payload").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {f"<urn:page:{i}>": b.encode() for i, b in enumerate(bodies)}


def test_token_counts(spark, awkward):
    v = trie_counts.Vocabulary.load(trie_counts.vocabulary_path())
    got = QUERIES["op10_token_counts"](spark, awkward).collect()
    memo = {}
    want = []
    for d, t in docs_of():
        w = brute.words(t)
        for x in w:
            if x not in memo:
                memo[x] = brute.segmentation(trie_counts.MARK + x, v)
        want.append((d, len(w), sum(memo[x][0] for x in w), round(sum(memo[x][1] for x in w), 3)))
    assert same([(r[0], r[1], r[2], round(r[3], 3)) for r in got], want)


def test_trie_shares_prefixes_without_changing_results():
    v = trie_counts.Vocabulary.ranked(["a", "ab", "b", "abc", "c", "bc", "x"])
    r = random.Random(0)
    words = {"".join(r.choices("abcxé", k=r.randint(0, 9))) for _ in range(500)}
    got = trie_counts.trie_counts(list(words), v)
    assert all(got[w][0] == brute.segmentation(w, v)[0] and abs(got[w][1] - brute.segmentation(w, v)[1]) < 1e-9 for w in words)
