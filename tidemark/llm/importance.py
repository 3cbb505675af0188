"""Target-distribution importance resampling over hashed word n-grams.

Documents and target texts are compared by the counts of their hashed n-grams. Texts are handled a batch at
a time: a batch's texts are joined with separators, one pass of a regular expression finds all words, the
place of each word among the documents' offsets (``searchsorted``) tells which n-grams would cross from one
document to the next, and ``bincount`` counts the buckets of the others. Two passes read the texts: one
counts the buckets, one weighs every document by the buckets' gains. Documents are then drawn without
replacement by the largest of weight plus Gumbel noise, the noise from a hash of the document's id.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import ordered_rank, stored, text_bytes

BUCKETS = 10_000
MAX_N = 2
MIN_WORDS = 20
PERCENT = 25
SEED = 7
# runs of [0-9a-z] and non-ASCII characters of a lower-cased text, as UTF-8 bytes
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
NO_WORD = re.compile(rb"[^0-9a-z\x80-\xff]")
SEPARATOR = b"\n"
# joined bytes whose words are in memory at a time
STEP = 1 << 20
CRC_TABLE = np.array([zlib.crc32(bytes([i]), 0xFFFFFFFF) ^ 0xFFFFFFFF for i in range(256)], np.uint32)


def _with_space(crc: np.ndarray) -> np.ndarray:
    """CRC-32 of what ``crc`` is the CRC-32 of with one space behind."""
    c = ~crc
    return ~((c >> np.uint32(8)) ^ CRC_TABLE[(c ^ np.uint32(0x20)) & np.uint32(0xFF)])


def features(texts: list[bytes], buckets: int = BUCKETS, max_n: int = MAX_N, step: int = STEP) -> Iterator[tuple]:
    """Joined texts -> per step ``(words' documents, [(n-grams' documents, n-grams' buckets) for n = 1 .. max_n])``.

    Documents are places in ``texts``. A step ends between two words; the words before it that an n-gram can
    still begin with are carried over, so a text of any length gives the same n-grams in any steps.
    """
    joined = SEPARATOR.join(texts).lower()
    # the offset behind each text and its separator: a word that starts at or behind it is of a later document
    ends = np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)) + len(SEPARATOR))
    # the last max_n - 1 words: for n, the CRC-32 of the n - 1 words up to each place, and its document
    tail: list[tuple[np.ndarray, np.ndarray]] = [(np.empty(0, np.uint32), np.empty(0, np.int64)) for _ in range(max_n)]
    at = 0
    while at < len(joined):
        cut = at + step
        if cut < len(joined):
            gap = NO_WORD.search(joined, cut)
            cut = gap.start() if gap else len(joined)
        found = list(WORD.finditer(joined, at, cut))
        at = cut
        if not found:
            continue
        words = [m[0] for m in found]
        doc = np.searchsorted(ends, np.fromiter((m.start() for m in found), np.int64, len(found)), side="right")
        del found
        grams = []
        for n in range(1, max_n + 1):
            if n == 1:
                crc = np.fromiter(map(zlib.crc32, words), np.uint32, len(words))
                whole, kept = crc, doc
            else:
                # n - 1 words that end before each word here: those carried over, then this step's
                before, owner = (np.concatenate(x) for x in zip(tail[n - 1], (grams[-1][2], grams[-1][3]), strict=True))
                before, owner = before[:-1], owner[:-1]
                own_words, own_docs = words[len(words) - len(before):], doc[len(words) - len(before):]
                whole = np.fromiter(map(zlib.crc32, own_words, _with_space(before).tolist()), np.uint32, len(before))
                kept = np.where(owner == own_docs, own_docs, -1)
            inside = kept >= 0
            grams.append((kept[inside], (whole[inside] % np.uint32(buckets)).astype(np.int64), whole, kept))
        tail = [(np.empty(0, np.uint32), np.empty(0, np.int64)), *((g[2][-1:], g[3][-1:]) for g in islice(grams, max_n - 1))]
        yield doc, [g[:2] for g in grams]


def _counts(buckets: int, max_n: int):
    """Batches of texts -> one row a bucket and task that has any: (bucket, n)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, grams in features(batch.column(0).to_pylist(), buckets, max_n):
                for _, bucket in grams:
                    total += np.bincount(bucket, minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["bucket", "n"])
    return run


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N) -> np.ndarray:
    """Features a bucket over all rows: each task counts into one array, the sums (``buckets`` numbers at
    most, whatever the input) come to the driver."""
    rows = texts.select(text_bytes(F.col(text)).alias("t")).mapInArrow(_counts(buckets, max_n), "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for r in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of the add-one-smoothed target to source shares, rounded down, by bucket."""
    b = len(source)
    s, t = source.astype(np.float64), target.astype(np.float64)
    ratio = (t + 1) * (source.sum() + b) / ((s + 1) * (target.sum() + b))
    return np.floor(1000 * np.log(ratio)).astype(np.int64)


def _weights(gain: np.ndarray, max_n: int, keep: int):
    """Batches of (kept columns, text) -> kept columns, n_words, n_features, weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            n_words, n_features, total = (np.zeros(n, np.int64) for _ in range(3))
            for doc, grams in features(batch.column(keep).to_pylist(), len(gain), max_n):
                n_words += np.bincount(doc, minlength=n)
                for owner, bucket in grams:
                    n_features += np.bincount(owner, minlength=n)
                    # n-grams lie in document order: the sums are differences of one running sum
                    run_sum = np.concatenate(([0], np.cumsum(gain[bucket])))
                    edge = np.searchsorted(owner, np.arange(n + 1))
                    total += run_sum[edge[1:]] - run_sum[edge[:-1]]
            weight = np.where(n_features > 0, total // np.maximum(n_features, 1), 0)
            yield pa.RecordBatch.from_arrays([*batch.columns[:keep], *map(pa.array, (n_words, n_features, weight))],
                                             [*batch.schema.names[:keep], "n_words", "n_features", "weight"])
    return run


def gumbel(doc_id: Column, seed: int = SEED) -> Column:
    """Thousandths of the id's Gumbel noise, rounded down: from 32 bits of a hash of seed and id (null: no id)."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")


def weighed(docs: DataFrame, target: DataFrame, text: str = "text", target_text: str = "text",
            buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """Every document's doc_id, n_words, n_features and weight: the floored mean gain of its n-grams."""
    gain = gains(bucket_counts(docs, text, buckets, max_n), bucket_counts(target, target_text, buckets, max_n))
    kind = docs.schema["doc_id"].dataType.simpleString()
    return (docs.select("doc_id", text_bytes(F.col(text)).alias("t"))
            .mapInArrow(_weights(gain, max_n, 1), f"doc_id {kind}, n_words long, n_features long, weight long"))


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: int = SEED,
              text: str = "text", target_text: str = "text", buckets: int = BUCKETS, max_n: int = MAX_N) -> DataFrame:
    """Every document's doc_id, n_features, weight, score, rank: rank 1, 2, 3 ... for the drawn ones, else null.

    Of the N documents with at least ``min_words`` words, the ``floor(percent * N / 100)`` highest scores are
    drawn, ties to the smaller doc_id (null last), repeated rows one after the other. Null and empty texts
    have no features and weight 0. Empty documents give no rows; an empty target is a uniform one.

    The score is a whole number within some ten thousands of zero at any input size, so the drawn score's
    bound comes from a histogram of scores; only documents from the bound up are sorted, by range, and
    numbered from the ranges' sizes.
    """
    rows = weighed(docs, target, text, target_text, buckets, max_n)
    rows = stored(rows.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed)), "importance-rows")
    able = F.col("n_words") >= min_words
    counts = {r["score"]: r["n"] for r in rows.filter(able).groupBy("score").agg(F.count(F.lit(1)).alias("n")).collect()}
    draw = percent * sum(counts.values()) // 100
    bound, above = None, 0
    for score in sorted(counts, reverse=True):
        if above >= draw:
            break
        bound, above = score, above + counts[score]
    near = able & (F.col("score") >= bound) if bound is not None else F.lit(False)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    ranked = ordered_rank(rows.filter(near), order, "rank")
    ranked = ranked.withColumn("rank", F.when(F.col("rank") < draw, F.col("rank") + 1))
    rest = rows.filter(~near).withColumn("rank", F.lit(None).cast("long"))
    return ranked.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")


def drawn(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn documents themselves, with their own columns. Documents and draws meet by doc_id: rows that
    repeat an id stay together if any of them is drawn."""
    ids = resampled(docs, target, **options).filter(F.col("rank").isNotNull()).select(F.col("doc_id").alias("__drawn"))
    return docs.join(ids.distinct(), docs["doc_id"].eqNullSafe(F.col("__drawn")), "left_semi")
