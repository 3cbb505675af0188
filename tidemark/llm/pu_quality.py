"""Quality classifier learnt from trusted positives and unlabelled text (non-negative PU learning).

Features are computed once for every document and stored. Mean, scale and the score tails behind the class prior
are Spark aggregates over all training rows; the risk is minimised on a sample of them drawn by row hash, so the
model hangs on the rows alone and not on how they are split.

A linear model over style features of the whole text minimises the non-negative unbiased risk
``pi * E_p[l(z)] + max(0, E_u[l(-z)] - pi * E_p[l(-z)])`` with the logistic loss, where ``pi``, the share
of positives among the unlabelled, is estimated from the scores of a first positive-against-unlabelled
model. Labelled negatives are never read.
"""

from __future__ import annotations

import math
import operator
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, stored, text_bytes

# rows the risk is minimised on: trusted positives, and (about, by row hash) distinct unlabelled documents
MAX_POSITIVES = 4000
MAX_UNLABELLED = 8000
FOLDS = 5
THRESHOLD = 0.3
SHAPE_BUCKETS = 128

# byte classes of word shapes: upper case, lower case, digit, white space, beyond ASCII; other bytes stand
# for themselves
_CLASS = np.array([65 if 65 <= c <= 90 else 97 if 97 <= c <= 122 or c >= 128 else 48 if 48 <= c <= 57
                   else 32 if c in b" \t\n\x0b\x0c\r" else c for c in range(256)], np.uint8)
_KINDS = np.zeros((256, 6))
for _c in range(256):
    _KINDS[_c, 0] = 65 <= _c <= 90
    _KINDS[_c, 1] = 48 <= _c <= 57
    _KINDS[_c, 2] = chr(_c) in "#*$%&|<>@^~=_{}[]\\/+" and _c < 128
    _KINDS[_c, 3] = chr(_c) in "!?" and _c < 128
    _KINDS[_c, 4] = chr(_c) in ".,;:'\"()-" and _c < 128
    _KINDS[_c, 5] = _c < 32 and chr(_c) not in "\t\n\r"
N_DENSE = 14
N_FEATURES = N_DENSE + SHAPE_BUCKETS
# moments are summed as integers of 1 / UNIT, so that their order is indifferent. In them a feature counts as MOST at
# most (only words of 2,560 bytes on average reach it), so that the squares of FLUSH rows fit 64 bits
UNIT, MOST, FLUSH = 1 << 14, 256.0, 100_000


def _bucket(shape: bytes, cache: dict[bytes, int]) -> int:
    b = cache.get(shape)
    if b is None:
        if len(cache) > 100_000:
            cache.clear()
        b = cache[shape] = xxhash.xxh64_intdigest(shape) % SHAPE_BUCKETS
    return b


def features(text: bytes, cache: dict[bytes, int]) -> np.ndarray:
    """Style features of a whole text: log-scaled shares of byte kinds, repeats, and hashed word shapes."""
    out = np.zeros(N_FEATURES, np.float32)
    words = text.split()
    n = len(words)
    if not n:
        out[0] = 1.0
        return out
    raw = np.frombuffer(text, np.uint8)
    kinds = np.bincount(raw, minlength=256) @ _KINDS / len(raw)
    again = sum(map(operator.eq, words, words[1:]))
    lines = text.split(b"\n")
    distinct = len(set(words))
    per_mille = [*kinds, again / n, 1 - len(set(lines)) / len(lines), max(Counter(words).values()) / n]
    out[1:10] = np.log1p(1000 * np.array(per_mille))
    out[10] = math.log1p(n)
    out[11] = math.log(distinct) / math.log(n) if n > 1 else 1.0
    out[12] = len(text) / n / 10
    out[13] = math.log1p(100 * len(lines) / n)
    shape = _CLASS[raw]
    shape = shape[np.concatenate(([True], shape[1:] != shape[:-1]))]
    for word, k in Counter(shape.tobytes().split()).items():
        out[N_DENSE + _bucket(word, cache)] += k
    out[N_DENSE:] = np.log1p(100 * out[N_DENSE:] / n)
    return out


def _feature_column(text: str) -> Column:
    def start():
        cache: dict[bytes, int] = {}
        return lambda batch: pa.array([features(t, cache).tobytes() for t in batch.to_pylist()], pa.binary())
    return per_batch(start, "binary")(text_bytes(text))


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float

    def raw(self, x: np.ndarray) -> np.ndarray:
        return np.round(np.clip((x - self.mean) / self.scale, -8, 8) @ self.weights + self.bias, 9)

    def scores(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.raw(x), -30, 30)))


def _fit(pos: np.ndarray, unl: np.ndarray, weight: np.ndarray, prior: float, steps: int = 1000, rate: float = 0.05, decay: float = 1e-4):
    """Weights and bias that minimise the non-negative risk (full-batch Adam, deterministic); ``weight`` says how
    many documents each unlabelled row stands for."""
    share = weight / weight.sum()
    w, b = np.zeros(pos.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    for t in range(1, steps + 1):
        sp, su = (1 / (1 + np.exp(-np.clip(x @ w + b, -30, 30))) for x in (pos, unl))
        as_negative = -np.log1p(-np.minimum(su, 1 - 1e-12)) @ share + prior * np.log1p(-np.minimum(sp, 1 - 1e-12)).mean()
        # gradients by z: of l(z) = -(1 - s), of l(-z) = s
        gp = -prior * (1 - sp) / len(pos)
        hp, hu = -prior * sp / len(pos), su * share
        if as_negative < 0:                               # over-fitted: step back on the negative part only
            gp, hp, hu = np.zeros_like(gp), -hp, -hu
        g = np.append(pos.T @ (gp + hp) + unl.T @ hu + decay * w, (gp + hp).sum() + hu.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, b = w - step[:-1], b - step[-1]
    return w, b


def prior_of_tails(held: np.ndarray, tails: Callable[[np.ndarray], tuple[np.ndarray, int]]) -> float:
    """Share of positives among the unlabelled: the least ratio of score tails (best bin), with a margin for
    sampling noise. ``held`` are scores of positives that the scoring model hasn't seen; ``tails`` gives the count
    of unseen unlabelled rows from each cut on, and of all."""
    cuts = np.round(np.quantile(held, np.linspace(0, 0.8, 161)), 9) - 5e-10
    counts, rows = tails(cuts)
    if not rows:
        return 0.5
    fp, fu = (held[:, None] >= cuts).mean(axis=0), counts / rows
    margin = math.sqrt(math.log(40) / 2 / len(held)) + math.sqrt(math.log(40) / 2 / rows)
    best = np.argmin((fu + margin) / np.maximum(fp, 1e-9))
    return float(np.clip(fu[best] / fp[best], 0.05, 0.99))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float32).reshape(-1, N_FEATURES).astype(np.float64)


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n, first, second = 0, np.zeros(N_FEATURES, np.int64), np.zeros(N_FEATURES, np.int64)

    def sums() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.arange(N_FEATURES, dtype=np.int64)), pa.array(np.full(N_FEATURES, n)),
                                           pa.array(first), pa.array(second)], ["k", "n", "first", "second"])

    for batch in batches:
        q = np.rint(np.minimum(_matrix(batch.column(0)), MOST) * UNIT).astype(np.int64)
        n, first, second = n + len(q), first + q.sum(axis=0), second + (q * q).sum(axis=0)
        if n > FLUSH:
            yield sums()
            n, first, second = 0, first * 0, second * 0
    if n:
        yield sums()


def moments(features_: DataFrame) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and deviation of each feature over all rows: exact sums, some rows a task and feature."""
    big = "decimal(38,0)"
    sums = (features_.select("f").mapInArrow(_moments, "k long, n long, first long, second long")
            .groupBy("k").agg(F.sum("n").alias("n"), F.sum(F.col("first").cast(big)).alias("first"), F.sum(F.col("second").cast(big)).alias("second"))
            .orderBy("k").collect())
    n = sums[0]["n"] if sums else 0
    if not n:
        return 0, np.zeros(N_FEATURES), np.ones(N_FEATURES)
    mean = np.array([float(r["first"]) / UNIT / n for r in sums])
    square = np.array([float(r["second"]) / UNIT ** 2 / n for r in sums])
    return n, mean, np.sqrt(np.maximum(square - mean * mean, 0))


def _tails(features_: DataFrame, model: Model, cuts: np.ndarray) -> tuple[np.ndarray, int]:
    """How many rows score from each cut on, and how many rows there are."""
    shared = features_.sparkSession.sparkContext.broadcast((model, cuts))

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, c = shared.value
        n, counts = 0, np.zeros(len(c), np.int64)
        for batch in batches:
            z = np.sort(m.raw(_matrix(batch.column(0))))
            n, counts = n + len(z), counts + len(z) - np.searchsorted(z, c, side="left")
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(c), dtype=np.int64)), pa.array(np.full(len(c), n)), pa.array(counts)], ["k", "n", "c"])

    sums = (features_.select("f").mapInArrow(counted, "k long, n long, c long").groupBy("k")
            .agg(F.sum("n").alias("n"), F.sum("c").alias("c")).orderBy("k").collect())
    return (np.array([r["c"] for r in sums]), sums[0]["n"]) if sums else (np.zeros(len(cuts)), 0)


def fold(doc_id: Column) -> Column:
    """Remainder of the crc32 of the id as text (null: of the empty text); 0 is held out."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def featured(docs: DataFrame) -> DataFrame:
    """``doc_id``, a hash of the row (id and text) and the features of every document, stored: one reading of the texts."""
    return stored(docs.select("doc_id", F.xxhash64("doc_id", "text").alias("row_hash"), _feature_column("text").alias("f")), "pu-features")


def train(docs: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
          max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """The model learnt from documents outside the held-out fold; labels are read for trusted positives alone.

    Mean, scale and prior cover all those documents. The risk is minimised on at most ``max_positives`` documents
    labelled 1 (ids with contradicting labels are none; of a repeated id the row with the least features counts)
    and on about ``max_unlabelled`` distinct documents, whatever their label, drawn by row hash; equal rows are one
    that counts as often as it occurs. Only these feature vectors (568 bytes each) come to the driver. Without
    positives or documents there is no model (None).
    """
    return train_on(featured(docs), labels, max_positives, max_unlabelled)


def train_on(features_: DataFrame, labels: DataFrame, max_positives: int = MAX_POSITIVES,
             max_unlabelled: int = MAX_UNLABELLED) -> Model | None:
    """``train`` on what ``featured`` made."""
    trusted = (labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isNotNull() & (fold(F.col("doc_id")) != 0))
               .groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
               .orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_positives).select("doc_id"))
    pos = features_.join(F.broadcast(trusted), "doc_id").groupBy("doc_id").agg(F.min("f").alias("f")).select("f").collect()
    seen = features_.filter(fold(F.col("doc_id")) != 0)
    rows, mean, deviation = moments(seen)
    if not pos or not rows:
        return None
    # the hash's upper 31 bits draw, its lowest bit says which half fits the model that the prior is read from
    drawn = seen.filter(F.shiftrightunsigned("row_hash", 33) < int(min(1.0, max_unlabelled / rows) * (1 << 31)))
    unl = drawn.groupBy("row_hash").agg(F.min("f").alias("f"), F.count(F.lit(1)).alias("n")).orderBy("row_hash").collect()
    if not unl:
        return None
    scale = deviation + 1e-3
    p, u = (np.array([np.frombuffer(r["f"], np.float32) for r in x], np.float64) for x in (pos, unl))
    p = p[np.lexsort(p.T[::-1])]                 # the split into halves doesn't hang on the order of arrival
    p, u = (np.clip((x - mean) / scale, -8, 8) for x in (p, u))
    weight = np.array([r["n"] for r in unl], np.float64)
    even = np.array([r["row_hash"] % 2 == 0 for r in unl])
    prior = 0.5
    if len(p) >= 20 and rows >= 20 and even.any():
        w, b = _fit(p[::2], u[even], weight[even], 0.5, steps=150, decay=1e-3)
        half = Model(mean, scale, w, b, 0.5)
        other = seen.filter(F.col("row_hash").bitwiseAND(F.lit(1)) == 1)
        prior = prior_of_tails(np.round(p[1::2] @ w + b, 9), lambda cuts: _tails(other, half, cuts))
    w, b = _fit(p, u, weight, prior)
    return Model(mean, scale, w, b, prior)


def score_column(text: str, model: Model | None, spark) -> Column:
    """Score 0 to 1 of every whole text (0.5 without a model)."""
    if model is None:
        return F.lit(0.5)
    return _score(_feature_column(text), model, spark)


def _score(features_: Column, model: Model | None, spark) -> Column:
    if model is None:
        return F.lit(0.5)
    shared = spark.sparkContext.broadcast(model)
    return per_batch(lambda: lambda batch: pa.array(shared.value.scores(_matrix(batch))), "double")(features_)


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a document: doc_id, held_out, score, predicted. Null texts score as empty ones; repeated rows
    each get the same score; labels, language, source and id are no inputs of a score."""
    f = featured(docs)
    s = f.select("doc_id", _score(F.col("f"), train_on(f, labels), docs.sparkSession).alias("score"))
    return s.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents predicted to be good, with their own columns."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    s = docs.select(row, score_column("text", train(docs, labels), docs.sparkSession).alias("score"))
    return s.filter(F.col("score") >= THRESHOLD).select("row.*")
