"""Window packing, importance resampling and the source audit against plain versions."""

import collections
import json
import random
import zlib

import llm_brute as brute
import numpy as np
import pytest
from pyspark.sql import functions as F
from test_llm_operators import awkward, docs_of, same  # noqa: F401  (a fixture)
from tokenizers import Tokenizer

from tidemark.llm import importance, source_audit, window_packing
from tidemark.llm.common import ordered_rank
from tidemark.llm.queries import QUERIES


# ---------------------------------------------------------------- packing into windows

@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(window_packing.tokenizer_path())


def random_texts(seed, n):
    r = random.Random(seed)
    parts = ["a", "Foo", " ", "  ", "\n", "\t", "'s", "'S", "don't", ".", ",", "a.", "é,", "É.", "...", "1", "23", "\xa0", "　", "\x1c", "\x85",
             "é", "́", "K", "İ", "ΑΣ ", "Σ", "<|endoftext|>", "<|STARTOFTEXT|>", "<|", "|>", "😀", "中文", "ि.", "x̸", "≠", "​"]
    return ["".join(r.choices(parts, k=r.randint(0, 12))) for _ in range(n)]


def test_word_ids_are_those_of_the_whole_text(tokenizer):
    tok = window_packing.WordTokenizer.load(window_packing.tokenizer_path())
    r = random.Random(8)
    texts = random_texts(0, 6000) + [t or "" for _, t in docs_of()] + [tokenizer.decode([i]) for i in range(0, 49406, 7)]
    texts += ["".join(r.choices("etaoinshrdlucmfwypvbgkjqxzéèàßüöñ", k=r.randint(1, 15))) for _ in range(20_000)]
    whole = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in tok.ids_of([t.encode() for t in texts])] == whole
    assert [np.frombuffer(tok.ids_of([t.encode()])[0], "<u4").tolist() for t in texts[:200]] == whole[:200]


def test_every_token_comes_whole_from_its_bytes():
    """What the ranks rely on: merging a token's own bytes by the file's merges gives that token."""
    with open(window_packing.tokenizer_path(), encoding="utf-8") as f:
        model = json.load(f)["model"]
    rank = {tuple(m): i for i, m in enumerate(model["merges"])}
    for a, b in model["merges"]:
        token = a + b
        parts = [*token.removesuffix("</w>")]
        if token.endswith("</w>"):
            parts[-1] += "</w>"
        while len(parts) > 1:
            best, i = min((rank.get(p, len(rank)), i) for i, p in enumerate(zip(parts, parts[1:], strict=False)))
            if best == len(rank):
                break
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
        assert parts == [token]


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(window_packing, "CACHED_WORDS", 10)
    tok = window_packing.WordTokenizer(window_packing.tokenizer_path())
    for i in range(50):
        text = f"w{i} q{'x' * (i % 7)} " + "z" * 100
        assert tok.ids_of([text.encode(), b""]) == [tok.encode(text), b""]
        assert len(tok.known) <= 13 and b"z" * 100 not in tok.known


@pytest.mark.parametrize("size", [1, 7, 64, 100])
def test_best_fit_is_that_of_a_plain_search(size):
    for seed in range(20):
        r = random.Random(seed)
        lengths = [r.randint(1, size) for _ in range(r.randint(0, 200))]
        window, offset, room = window_packing.best_fit(np.array(lengths, np.int64), size)
        got = collections.defaultdict(list)
        for i in sorted(range(len(lengths)), key=lambda i: (window[i], offset[i])):
            assert offset[i] == sum(got[window[i]])
            got[window[i]].append(lengths[i])
        assert all(room[w] == size - sum(ls) >= 0 for w, ls in got.items())
        # windows of equal room are alike, so only the fills are determined
        assert sorted(map(sum, got.values())) == sorted(map(sum, brute.best_fit_decreasing(lengths, size)))


def check_packing(rows, docs, tokenizer, size):
    """Every id once, in order, gapless places; returns the sequences' fills."""
    want = collections.Counter()
    for d, t in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")
        want.update((d, a, min(size, len(ids) - a), zlib.crc32(ids[a:a + size].tobytes()), len(ids)) for a in range(0, len(ids), size))
    assert collections.Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]) for r in rows) == want
    by = collections.defaultdict(list)
    for r in rows:
        by[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= size
    return [sum(n for _, n in p) for p in by.values()]


def test_packing_on_awkward_documents(spark, awkward, tokenizer):  # noqa: F811
    docs = docs_of()
    rows = QUERIES["op11_window_packing"](spark, awkward).collect()
    fills = check_packing(rows, docs, tokenizer, 2048)
    tails = [r["length"] for r in rows if r["length"] < 2048]
    assert len(fills) == len(rows) - len(tails) + len(brute.best_fit_decreasing(tails, 2048))


def test_rounds_pack_like_one_batch(spark, tokenizer):
    r = random.Random(3)
    texts = [(i, " ".join(r.choices(["cat", "dog", "of", "the"], k=r.choice([1, 3, 10, 30, 60])))) for i in range(2000)]
    docs = spark.createDataFrame(texts, "doc_id long, text string").repartition(7)
    once = check_packing(window_packing.packed(docs, size=64).collect(), texts, tokenizer, 64)
    many = check_packing(window_packing.packed(docs, size=64, batch_pieces=50).collect(), texts, tokenizer, 64)
    assert len(once) <= len(many) <= 1.02 * len(once) + 2


def test_rounds_end_when_lengths_do_not_fit(spark, tokenizer):
    texts = [(i, "cat " * 39) for i in range(300)]                # 40 of 64 tokens: no two meet
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    assert len(check_packing(window_packing.packed(docs, size=64, batch_pieces=20).collect(), texts, tokenizer, 64)) == 300


def test_sequences_hold_the_ids(spark, tokenizer):
    texts = [(i, t) for i, t in enumerate(random_texts(5, 60))] + [(900, "word " * 500), (901, None), (900, "word " * 500)]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    ids = {}
    for i, t in texts:
        ids[i] = [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1]
    seen = collections.Counter()
    for r in window_packing.sequences(docs, size=128).collect():
        got = np.frombuffer(bytes(r["ids"]), "<u4").tolist()
        assert len(got) == r["n_tokens"] <= 128
        for p in r["pieces"]:
            assert got[p["offset"]:p["offset"] + p["length"]] == ids[p["doc_id"]][p["start"]:p["start"] + p["length"]]
            seen[p["doc_id"]] += p["length"]
    assert seen == collections.Counter({i: len(ids[i]) * sum(j == i for j, _ in texts) for i in ids})


# ---------------------------------------------------------------- importance resampling

@pytest.mark.parametrize("max_n", [1, 2, 3])
@pytest.mark.parametrize("step", [1, 7, 50, 1 << 20])
def test_features_do_not_cross_documents_or_depend_on_steps(max_n, step):
    r = random.Random(step)
    texts = ["".join(r.choices(["a", "B", "é", "1", " ", "  ", "\n", "-", "word", "😀"], k=r.randint(0, 40))) for _ in range(40)] + ["", "x", "", "y z"]
    words, got = collections.Counter(), collections.Counter()
    for doc, grams in importance.features([t.encode() for t in texts], 10_000, max_n, step):
        words.update(doc.tolist())
        for owner, bucket in grams:
            got.update(zip(owner.tolist(), bucket.tolist(), strict=True))
    assert words == collections.Counter(i for i, t in enumerate(texts) for _ in brute.ITEM_WORD.findall(brute.lower(t)))
    assert got == collections.Counter((i, zlib.crc32(f.encode()) % 10_000) for i, t in enumerate(texts) for f in brute.ngrams(t, max_n))


def test_resampling_on_awkward_documents(spark, awkward):  # noqa: F811
    items = [r["text"] for r in spark.read.parquet(f"{awkward}/benchmark.parquet").collect()]
    assert same(QUERIES["op12_importance_resampling"](spark, awkward).collect(), brute.resampled(docs_of(), items))


def test_draws_follow_the_target(spark):
    r = random.Random(1)
    texts = [(i, " ".join(r.choices(["red", "blue", "green"] if i % 10 else ["proof", "lemma", "axiom"], k=40))) for i in range(400)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts], "doc_id long, text string, rank string")
    target = spark.createDataFrame([("lemma proof axiom " * 30,)], "text string")
    got = importance.drawn(docs, target, percent=10)
    ids = [x["doc_id"] for x in got.collect()]
    assert got.columns == docs.columns and len(ids) == 40 and sum(i % 10 == 0 for i in ids) >= 35
    assert same(importance.resampled(docs, target, percent=10).collect(), brute.resampled(texts, ["lemma proof axiom " * 30], percent=10))
    none = importance.resampled(docs, target.limit(0), percent=0)
    assert none.count() == 400 and none.filter("rank IS NOT NULL").count() == 0


def test_repeated_rows_are_drawn_one_after_the_other(spark):
    docs = spark.createDataFrame([(1, "word " * 25)] * 4 + [(2, "other " * 25)] * 4, "doc_id long, text string")
    got = importance.resampled(docs, docs.limit(0), percent=50).collect()
    assert sorted(r["rank"] for r in got if r["rank"]) == [1, 2, 3, 4] and len({r["doc_id"] for r in got if r["rank"]}) == 1


def test_ordered_rank_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).alias("x"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 50).alias("hot"))
    old = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = ordered_rank(df, [F.col("hot").desc(), F.col("x").asc()], "rank").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", old)
    assert [(r["hot"], r["x"]) for r in sorted(got, key=lambda r: r["rank"])] == sorted(((r["hot"], r["x"]) for r in got), key=lambda t: (-t[0], t[1]))
    assert sorted(r["rank"] for r in got) == list(range(5000))


# ---------------------------------------------------------------- source divergence

def test_audit_on_awkward_documents(spark, awkward):  # noqa: F811
    docs = [(r[2], r[3], r[1]) for r in brute.awkward_documents()]
    got = [tuple(r) for r in QUERIES["op13_source_divergence"](spark, awkward).collect()]
    assert len(got) == len(set(got)) and set(got) == brute.divergence(docs)


def test_audit_in_small_slices_steps_and_flushes(spark, monkeypatch):
    for name in ("FLUSH_ENTRIES", "SCATTER", "BLOCK_PEERS"):
        monkeypatch.setattr(source_audit, name, 3)
    r = random.Random(2)
    vocabulary = ["ab", "Éa", "é", "zz", "b", "Z", "ba", "中", "q", "the"]
    docs = [(r.choice(["en", None, "x"]), f"s{min(r.randint(0, 12), r.randint(0, 12))}", " ".join(r.choices(vocabulary, k=r.randint(0, 30)))) for _ in range(300)]
    docs += [("one", "a", "solo"), ("one", "b", None), ("one", None, "solo"), ("one", "", "other"), ("bare", "a", None), ("bare", "b", "1 2 3"), ("alone", "a", "x x x")]
    df = spark.createDataFrame([(*d, 0) for d in docs], "lang string, source string, text string, value int")
    for top, postings in ((200, 5), (3, 1 << 17)):
        got = [tuple(x) for x in source_audit.audit(df, top=top, slice_postings=postings).collect()]
        assert len(got) == len(set(got)) and set(got) == brute.divergence(docs, top)
    assert {x[5] for x in got if x[0] == "bare"} == {1} and all(x[4] == 0 for x in got if x[0] == "bare")


def test_shares_of_large_counts_are_exact():
    r = random.Random(4)
    for _ in range(2000):
        n, v = r.randint(0, 10 ** 15), r.randint(1, 10 ** 6)
        c = r.randint(0, n)
        assert int(source_audit.share(c, n, v)) == 1 + 10 ** 9 * (c + 1) // (n + v)
    assert int(source_audit.share(9, 9, 1)) == 1 + 10 ** 9


# ---------------------------------------------------------------- k-d sharding by the values' places

def test_values_with_a_common_beginning_stay_apart(spark):
    from tidemark.llm import kd_shards
    names = [f"https://www.example.org/{i}" for i in range(40)]
    docs = spark.createDataFrame([(i, "x" * 100, "en", names[i % 40]) for i in range(4000)] + [(9000, None, None, None)],
                                 "doc_id long, text string, lang string, source string")
    places = {r["value"]: r["place"] for r in kd_shards.value_places(docs, "source").collect()}
    assert len(set(places.values())) == 41 and places[""] == 0 and all(0 <= p < 1 for p in places.values())
    assert sorted(places, key=places.get) == sorted(places)
    docs = docs.filter("source IS NOT NULL")
    got = kd_shards.sharded(docs, shards=4).join(docs.select("doc_id", "source"), "doc_id").collect()
    by_shard = collections.defaultdict(set)
    for r in got:
        by_shard[r["shard"]].add(r["source"])
    # texts are alike, so only the source can be cut: a source lies in one shard, or in two where a cut goes through it
    assert len(got) == 4000 and sum(map(len, by_shard.values())) <= 40 + 3
