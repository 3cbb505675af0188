"""Divergence of every source's terms from those of its language's other sources and of the whole language.

Counts by (language, source, term) become a term-major index: one row a kept term with its postings, the
sources that use it. The index is dealt out in slices of terms. A task accumulates row by row, in
Gustavson's order: for each source it walks the source's terms, scatters every term's postings into one
dense accumulator over the peers, and returns the accumulator once, not a row a pair of postings. Terms that
one or both sources lack still have a share of their own, the zero baseline: postings add only what differs
from the baselines, and the baselines are added for all pairs from each source's histogram of counts.

All shares are whole parts of 1e9 and every sum is exact.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import stored, text_bytes

SCALE_STEP, SCALE_STEPS = 1000, 3                      # shares are parts of 1000 ** 3
MIN_DOCUMENTS = 3
TOP_TERMS = 200
# runs of letters and non-ASCII characters of a lower-cased text, as UTF-8 bytes
TERM = re.compile(rb"[a-z\x80-\xff]+")
# entries that a task's counters hold before they are sent on
FLUSH_ENTRIES = 1_000_000
# postings of one slice of the index, and the slices that a language has at least
SLICE_POSTINGS = 1 << 17
LEAST_SLICES = 8
# peers of one baseline block, and pairs of postings that one numpy step scatters
BLOCK_PEERS = 1024
SCATTER = 1 << 20


def share(count, total, terms):
    """``1 + floor(1e9 * (count + 1) / (total + terms))`` without leaving 64 bits, digit group by digit group."""
    rest, whole = np.asarray(count, np.int64) + 1, np.asarray(total, np.int64) + terms
    out = np.zeros(np.broadcast(rest, whole).shape, np.int64)
    for _ in range(SCALE_STEPS):
        rest = rest * SCALE_STEP
        out = out * SCALE_STEP + rest // whole
        rest = rest % whole
    return out + 1


def divergence(p, q):
    """``floor((p - q)^2 / q)`` of whole shares; below 1e18 * 1.01, so it fits 64 bits."""
    d = p - q
    return d * d // q


# ---------------------------------------------------------------- counts and index

def _term_counts():
    """Batches of (lang, source, text) -> (lang, source, term, n, df), summed over what a task holds at a time."""
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("df", pa.int64())])

    def flush(held: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), (n, df) in held.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()), pa.array(list(n), pa.string()),
                pa.array(list(n.values()), pa.int64()), pa.array([df[t] for t in n], pa.int64())], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, tuple[Counter, Counter]] = {}
        entries = 0
        for batch in batches:
            for lang, source, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                n, df = held.setdefault((lang, source), (Counter(), Counter()))
                before = len(n)
                words = TERM.findall(text.lower())
                n.update(words)
                df.update(set(words))
                entries += len(n) - before
                if entries >= FLUSH_ENTRIES:
                    yield from flush(held)
                    held, entries = {}, 0
        yield from flush(held)
    return run


def _named(docs: DataFrame) -> list[Column]:
    return [F.coalesce(docs[c].cast("string"), F.lit("")).alias(c) for c in ("lang", "source")]


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, df) by task, not yet summed; nulls are ''."""
    return (docs.select(*_named(docs), text_bytes("text").alias("t"))
            .mapInArrow(_term_counts(), "lang string, source string, term string, n long, df long"))


def term_index(counts: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Kept terms: lang, term, n (in the language), postings (source, n). One shuffle by (lang, term): a term that
    every task has seen costs a row a task and source; a term's postings are as many as its language has sources."""
    by_source = (counts.repartition("lang", "term").groupBy("lang", "term", "source")
                 .agg(F.sum("n").alias("n"), F.sum("df").alias("df")))
    return (by_source.groupBy("lang", "term")
            .agg(F.sum("n").alias("n"), F.sum("df").alias("df"), F.collect_list(F.struct("source", "n")).alias("postings"))
            .filter(F.col("df") >= min_documents).drop("df"))


def group_table(groups: DataFrame, index: DataFrame) -> DataFrame:
    """One row a (lang, source): its kept occurrences ``total`` and kept terms ``own``, its language's kept terms
    ``terms``, occurrences ``lang_total``, postings ``lang_postings`` and sources ``lang_sources``."""
    langs = index.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("n").alias("lang_total"),
                                      F.sum(F.size("postings")).cast("long").alias("lang_postings"))
    posts = index.select("lang", F.explode("postings").alias("p"))
    own = posts.groupBy("lang", F.col("p.source").alias("source")).agg(F.sum("p.n").alias("total"), F.count(F.lit(1)).alias("own"))
    sources = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("lang_sources"))
    zero = {c: 0 for c in ("total", "own", "terms", "lang_total", "lang_postings")}
    return groups.join(own, ["lang", "source"], "left").join(sources, "lang").join(langs, "lang", "left").fillna(zero)


# ---------------------------------------------------------------- scattered postings

def _scatter(top: int):
    """Sorted rows of slices -> pair corrections and the best terms of each source in the slice.

    A slice comes as its peers (kind 0: source, total, terms, lang_total) and its index rows (kind 1).
    Returned: part, lang, source, item, value.
    """
    schema = pa.schema([("part", pa.string()), ("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def rows(part: str, lang: str, source: str, items: list, values: np.ndarray) -> pa.RecordBatch:
        n = len(items)
        return pa.RecordBatch.from_arrays([pa.array([part] * n, pa.string()), pa.array([lang] * n, pa.string()),
                                           pa.array([source] * n, pa.string()), pa.array(items, pa.string()), pa.array(values)], schema=schema)

    def slice_rows(lang: str, peers: pa.Table, index: pa.Table) -> Iterator[pa.RecordBatch]:
        names = peers["source"].to_pylist()
        total = peers["total"].to_numpy()
        terms, lang_total = peers["terms"][0].as_py(), peers["lang_total"][0].as_py()
        zero = share(0, total, terms)                  # every peer's share of a term it lacks
        words = index["term"].to_pylist()
        order = np.argsort(np.argsort(np.array([w.encode() for w in words], object), kind="stable"), kind="stable")
        whole = share(index["n"].to_numpy(), lang_total, terms)
        posts = index["postings"].combine_chunks()
        size = np.diff(posts.offsets.to_numpy())
        flat = posts.flatten()
        place = {s: i for i, s in enumerate(names)}
        peer = np.fromiter(map(place.__getitem__, flat.field("source").to_pylist()), np.int64, len(flat))
        first = np.concatenate(([0], np.cumsum(size)))
        term = np.repeat(np.arange(len(words)), size)
        p = share(flat.field("n").to_numpy(), total[peer], terms)
        by_source = np.argsort(peer, kind="stable")
        edge = np.searchsorted(peer[by_source], np.arange(len(names) + 1))
        for a, source in enumerate(names):
            own = by_source[edge[a]:edge[a + 1]]       # the source's postings
            if not len(own):
                continue
            acc, touched = np.zeros(len(names), np.int64), np.zeros(len(names), bool)
            for part in np.split(own, np.flatnonzero(np.diff(np.cumsum(size[term[own]]) // SCATTER)) + 1):
                w = size[term[part]]
                at = np.repeat(first[term[part]], w) + np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
                b, pa_, pb = peer[at], np.repeat(p[part], w), p[at]
                value = divergence(pa_, pb) - divergence(pa_, zero[b]) - divergence(zero[a], pb) + divergence(zero[a], zero[b])
                np.add.at(acc, b, value)
                touched[b] = True
            touched[a] = False
            hit = np.flatnonzero(touched)
            if len(hit):
                yield rows("pair", lang, source, [names[b] for b in hit], acc[hit])
            q = whole[term[own]]
            more = p[own] > q
            own, q = own[more], q[more]
            f = divergence(p[own], q)
            best = np.lexsort((order[term[own]], -f))[:top]
            if len(best):
                yield rows("term", lang, source, [words[t] for t in term[own[best]]], f[best])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def done() -> Iterator[pa.RecordBatch]:
            if held:
                t = pa.Table.from_batches(held)
                kinds = t["kind"].to_numpy()
                split = int((kinds == 0).sum())
                if split < len(kinds):                 # a slice without terms has only its peers
                    yield from slice_rows(key[0], t.slice(0, split), t.slice(split))

        for batch in batches:
            if not batch.num_rows:
                continue
            lang, piece = batch.column(0).to_pylist(), batch.column(1).to_numpy(zero_copy_only=False)
            change = [0, *(i for i in range(1, len(lang)) if piece[i] != piece[i - 1] or lang[i] != lang[i - 1]), len(lang)]
            for x, y in zip(change, change[1:], strict=False):
                if key != (lang[x], piece[x]):
                    yield from done()
                    key, held = (lang[x], piece[x]), []
                held.append(batch.slice(x, y - x))
        yield from done()
    return run


def scattered(index: DataFrame, groups: DataFrame, top: int = TOP_TERMS, slice_postings: int = SLICE_POSTINGS) -> DataFrame:
    """Corrections by pair and best terms by source, from every slice of the term-major index.

    Slices are cut by a hash of the term, as many as hold ``slice_postings`` postings each; every slice gets its
    language's peers beside it. A task's memory is one slice and one accumulator over the peers.
    """
    slices = F.greatest(F.lit(LEAST_SLICES), F.ceil(F.col("lang_postings") / slice_postings)).cast("int")
    by_lang = groups.groupBy("lang").agg(F.first(slices).alias("slices"))
    count = by_lang.agg(F.sum("slices").alias("n")).first()["n"] or 1
    terms = index.join(by_lang, "lang").select(
        "lang", F.pmod(F.xxhash64("term"), "slices").cast("int").alias("slice"), F.lit(1).alias("kind"), F.lit(None).cast("string").alias("source"),
        *[F.lit(None).cast("long").alias(c) for c in ("total", "terms", "lang_total")], "term", "n", "postings")
    peers = groups.select(
        "lang", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"), F.lit(0).alias("kind"), "source", "total", "terms", "lang_total",
        F.lit(None).cast("string").alias("term"), F.lit(None).cast("long").alias("n"),
        F.lit(None).cast(index.schema["postings"].dataType).alias("postings"))
    return (peers.unionByName(terms).repartition(count, "lang", "slice").sortWithinPartitions("lang", "slice", "kind")
            .mapInArrow(_scatter(top), "part string, lang string, source string, item string, value long"))


# ---------------------------------------------------------------- zero baselines

def _baselines():
    """(a source with its histogram of counts) x (a block of its language's peers) -> the pairs' baselines.

    For source x and peer y: the sum over x's terms against y's zero share goes to (x, y), the sum of x's terms
    seen from y's zero share goes to (y, x), and the terms beyond both to (x, y) at the two zero shares.
    """
    schema = pa.schema([("lang", pa.string()), ("source", pa.string()), ("item", pa.string()), ("value", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lang, source, total, own, terms, hist, block in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                names = [b["source"] for b in block]
                if terms:
                    peer_total, peer_own = (np.array([b[k] for b in block], np.int64) for k in ("total", "own"))
                    zero, own_zero = share(0, peer_total, terms), share(0, total, terms)
                    n = np.array([h["n"] for h in hist or ()], np.int64)
                    many = np.array([h["many"] for h in hist or ()], np.int64)
                    p = share(n, total, terms)
                    forth, back = np.zeros(len(names), np.int64), np.zeros(len(names), np.int64)
                    for x in range(0, len(p), 1024):   # bounded memory for sources with many different counts
                        px, mx = p[x:x + 1024, None], many[x:x + 1024, None]
                        forth += (divergence(px, zero[None, :]) * mx).sum(axis=0)
                        back += (divergence(zero[None, :], px) * mx).sum(axis=0)
                    forth += (terms - own - peer_own) * divergence(own_zero, zero)
                else:
                    forth = back = np.zeros(len(names), np.int64)
                other = np.array([x != source for x in names], bool)
                items = [x for x in names if x != source]
                yield pa.RecordBatch.from_arrays([
                    pa.array([lang] * 2 * len(items), pa.string()), pa.array([source] * len(items) + items, pa.string()),
                    pa.array(items + [source] * len(items), pa.string()), pa.array(np.concatenate((forth[other], back[other])))], schema=schema)
    return run


def baselines(index: DataFrame, groups: DataFrame) -> DataFrame:
    """Every ordered pair of a language's sources with its zero baselines: each source's histogram meets its
    language's peers in blocks of ``BLOCK_PEERS``."""
    posts = index.select("lang", F.explode("postings").alias("p")).select("lang", "p.source", "p.n")
    hist = (posts.groupBy("lang", "source", "n").agg(F.count(F.lit(1)).alias("many"))
            .groupBy("lang", "source").agg(F.collect_list(F.struct("n", "many")).alias("hist")))
    blocks = F.ceil(F.col("lang_sources") / BLOCK_PEERS).cast("int")
    peers = (groups.groupBy("lang", F.pmod(F.xxhash64("source"), blocks).cast("int").alias("block"))
             .agg(F.collect_list(F.struct("source", "total", "own")).alias("peers")))
    every = groups.join(hist, ["lang", "source"], "left").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return (every.join(peers, ["lang", "block"]).select("lang", "source", "total", "own", "terms", "hist", "peers")
            .mapInArrow(_baselines(), "lang string, source string, item string, value long"))


# ---------------------------------------------------------------- report

def _ranked(df: DataFrame, best: int | None = None) -> DataFrame:
    order: list[Column] = [F.col("value").desc(), F.col("item").asc()]
    out = df.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "source").orderBy(*order)))
    return out if best is None else out.filter(F.col("rank") <= best)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, top: int = TOP_TERMS, slice_postings: int = SLICE_POSTINGS) -> DataFrame:
    """lang, source, part, item, value, rank for every (lang, source) group of ``docs`` (lang, source, text).

    Part ``pair``: every other source of the language with the divergence of the group from it, summed over
    the language's kept terms. Part ``term``: the ``top`` terms whose share in the group exceeds that in the language.
    Null and empty texts, languages and sources are ''; a group without terms still has its pairs; a
    language without kept terms has pairs of value 0; repeated rows count as often as they occur; ties go by
    the item's bytes; an empty table gives no rows. Other columns are not read.
    """
    index = stored(term_index(term_counts(docs), min_documents), "audit-index")
    groups = stored(group_table(docs.select(*_named(docs)).distinct(), index), "audit-groups")
    found = stored(scattered(index, groups, top, slice_postings), "audit-scattered")
    columns = ["lang", "source", "item", "value"]
    pairs = (baselines(index, groups).select(*columns).unionByName(found.filter("part = 'pair'").select(*columns))
             .groupBy("lang", "source", "item").agg(F.sum(F.col("value").cast("decimal(38,0)")).cast("long").alias("value")))
    terms = _ranked(found.filter("part = 'term'").select(*columns), top)
    return (_ranked(pairs).withColumn("part", F.lit("pair")).unionByName(terms.withColumn("part", F.lit("term")))
            .select("lang", "source", "part", "item", "value", "rank"))
