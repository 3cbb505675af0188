"""Language-model scoring with a log-frequency Bloom filter.

N-gram counts are quantised on a log scale, ``level = 1 + floor(log_base(count))``, and an n-gram of level
``j`` is put into the filter as ``(n-gram, 1) .. (n-gram, j)``. A reader probes levels upwards until one is
missing, which gives the level back with an error that shrinks with every further probe. Every n-gram of the
training texts is put in, so the filter grows with them; it lies in parts by hash range, and no task holds more
than one part at a time: the documents' distinct n-grams go to the parts, and the answers come back.

The smoothed probability of a word ``w`` after ``v`` is
``(1 - mix) * (c(w) + 1) / (N + V + 1) + mix * c(v, w) / c(v)`` with the counts that the levels stand for.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.common import stored, text_bytes

FOLDS, HELD_OUT = 7, 2
BASE = 1.5
BITS_AN_ENTRY = 8
PROBES = 4
MIX = 0.3
# training bytes of one segment of the n-gram space: the lower bound up to 0.1 TB, the upper one from 1 TB on
SEGMENT_BYTES = (2 << 20, 16 << 20)
FLUSH_TOKENS = 1_500_000
CACHE_WORDS = 200_000
# tokens of the documents whose n-grams are asked for together
CHUNK_TOKENS = 1_000_000
# no word holds a space, so these two stand apart from all words
END, START = (np.uint64(xxhash.xxh64_intdigest(x)) for x in (b" end", b" start"))
_MUL = np.uint64(0x9E3779B97F4A7C15)


def mixed(a: np.ndarray, b: np.ndarray | np.uint64) -> np.ndarray:
    """64-bit hash of an ordered pair of hashes."""
    x = (a ^ (a >> np.uint64(29))) * _MUL + b
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


class Words(dict):
    """word -> row of ``hashes``; grows with the words seen, and starts anew beyond a bound."""

    def __init__(self):
        super().__init__()
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.new: list[bytes] = []
        self.hashes = np.empty(0, np.uint64)

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        self.new.append(word)
        return n

    def rows(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Rows of all words of the texts, and the number of words of each text. Lower-cases A-Z."""
        if len(self) > CACHE_WORDS:
            self.reset()
        split = [t.lower().split() for t in texts]
        n = np.array([len(s) for s in split], np.int64)
        get = self.__getitem__
        rows = np.fromiter((get(w) for s in split for w in s), np.int64, int(n.sum()))
        if self.new:
            digest = xxhash.xxh64_intdigest
            self.hashes = np.concatenate((self.hashes, np.array([digest(w) for w in self.new], np.uint64)))
            self.new = []
        return rows, n


def with_ends(values: np.ndarray, n: np.ndarray, first, last) -> tuple[np.ndarray, np.ndarray]:
    """Per text: ``first`` before and ``last`` behind its values. Returns the values and each text's begin."""
    begin = np.cumsum(n + 2) - (n + 2)
    out = np.empty(int((n + 2).sum()), values.dtype)
    inside = np.ones(len(out), bool)
    inside[begin] = inside[begin + n + 1] = False
    out[inside], out[begin], out[begin + n + 1] = values, first, last
    return out, begin


def pairs_of(tokens: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(previous, token) for every token but the starts."""
    keep = np.ones(len(tokens), bool)
    keep[begin] = False
    at = np.flatnonzero(keep)
    return tokens[at - 1], tokens[at]


def _count(hashes: list[np.ndarray], counts: list[np.ndarray] | None = None) -> tuple[np.ndarray, np.ndarray]:
    h = np.concatenate(hashes)
    if counts is None:
        return np.unique(h, return_counts=True)
    order = np.argsort(h, kind="stable")
    h, c = h[order], np.concatenate(counts)[order]
    first = np.flatnonzero(np.concatenate(([True], h[1:] != h[:-1]))) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(c, first) if len(h) else c


def _counted(segments: int):
    """Texts -> (segment, order, hashes, counts): each task's n-gram counts, combined and dealt by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size = Words(), ([], []), 0

        def flush() -> Iterator[pa.RecordBatch]:
            for order in (0, 1):
                h, c = _count(held[order])
                held[order].clear()
                for part, cuts in runs_of(segment_of(h, segments)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(part), pa.array(np.full(len(part), order + 1, np.int8)),
                        pa.array([h[a:b].tobytes() for a, b in cuts], pa.binary()),
                        pa.array([c[a:b].astype(np.uint32).tobytes() for a, b in cuts], pa.binary())],
                        ["segment", "n", "hashes", "counts"])

        for batch in batches:
            rows, n = words.rows(batch.column(0).to_pylist())
            tokens, begin = with_ends(words.hashes[rows], n, START, END)
            before, token = pairs_of(tokens, begin)
            held[0].append(token)
            held[1].append(mixed(before, token))
            size += len(token)
            if size >= FLUSH_TOKENS:
                yield from flush()
                size = 0
        if size:
            yield from flush()
    return run


def levels_of(counts: np.ndarray, base: float = BASE) -> np.ndarray:
    """Quantised log frequency; 0 for what was not seen."""
    out = np.zeros(len(counts), np.int64)
    some = counts >= 1
    out[some] = 1 + np.floor(np.log(counts[some]) / np.log(base) + 1e-9).astype(np.int64)
    return out


def _positions(h: np.ndarray, level: np.ndarray, bits: np.ndarray | int) -> Iterator[np.ndarray]:
    a = mixed(h, (level.astype(np.uint64) + np.uint64(1)) * np.uint64(0xA0761D6478BD642F))
    b = mixed(a, _MUL) | np.uint64(1)
    for k in range(PROBES):
        yield (((a + np.uint64(k) * b) >> np.uint64(32)) * bits.astype(np.uint64) if isinstance(bits, np.ndarray)
               else ((a + np.uint64(k) * b) >> np.uint64(32)) * np.uint64(bits)) >> np.uint64(32)


def probed(h: np.ndarray, bits: int, filter_: np.ndarray) -> np.ndarray:
    """Levels of n-grams in a part of the filter by probing (n-gram, 1), (n-gram, 2), ... until one is missing."""
    out = np.zeros(len(h), np.int64)
    open_ = np.arange(len(h))
    level = 1
    while len(open_):
        a = mixed(h[open_], np.uint64((level + 1) * 0xA0761D6478BD642F & 0xFFFFFFFFFFFFFFFF))
        b = mixed(a, _MUL) | np.uint64(1)
        for k in range(PROBES):                              # as _positions, for those not yet missing
            at = ((((a + np.uint64(k) * b) >> np.uint64(32)) * np.uint64(bits)) >> np.uint64(32)).astype(np.int64)
            found = (filter_[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
            open_, a, b = open_[found], a[found], b[found]
        out[open_] = level
        level += 1
    return out


def _filtered():
    """Each segment's counts, summed -> its part of the filter, and for tokens their hashes and exact counts."""
    names = ["segment", "n", "bits", "body", "distinct", "total", "h", "c"]
    kinds = [pa.int32(), pa.int8(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def part(segment: int, n: int, h: np.ndarray, c: np.ndarray) -> Iterator[pa.RecordBatch]:
        level = levels_of(c)
        bits = int(max(64, 64 * -(-int(level.sum()) * BITS_AN_ENTRY // 64)))
        array = np.zeros(bits, bool)
        h2, lv = h, level
        step = 1
        while True:
            some = lv >= step
            if not some.any():
                break
            h2, lv = h2[some], lv[some]
            for at in _positions(h2, np.full(len(h2), step), bits):
                array[at] = True
            step += 1
        exact = [h.tobytes(), c.astype(np.int64).tobytes()] if n == 1 else [None, None]
        row = [segment, n, bits, np.packbits(array, bitorder="little").tobytes(), len(h), int(c.sum()), *exact]
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(row, kinds, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, hs, cs, size = None, [], [], 0
        for batch in batches:                           # sorted by segment and order
            for segment, n, h, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if (segment, n) != key:
                    if hs:
                        yield from part(*key, *_count(hs, cs))
                    key, hs, cs, size = (segment, n), [], [], 0
                hs.append(np.frombuffer(h, np.uint64))
                cs.append(np.frombuffer(c, np.uint32).astype(np.int64))
                size += len(hs[-1])
                if size > 4_000_000 and len(hs) > 1:     # combine as it comes: memory follows distinct n-grams
                    both = _count(hs, cs)
                    hs, cs, size = [both[0]], [both[1]], 0
        if hs:
            yield from part(*key, *_count(hs, cs))
    return run


def _unpacked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for h, c in zip(*(x.to_pylist() for x in batch.columns), strict=True):
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(h, np.int64)), pa.array(np.frombuffer(c, np.int64))], ["h", "c"])


@dataclass
class BloomModel:
    """The stored filter parts by segment, and the scalars."""

    parts: DataFrame
    segments: int
    tokens: int
    distinct: int
    texts: int

    def levels(self, h: np.ndarray, order: int) -> np.ndarray:
        """Levels of a few n-grams; reads their parts of the filter one by one."""
        out, seg = np.zeros(len(h), np.int64), segment_of(h, self.segments)
        wanted = self.parts.filter((F.col("n") == order) & F.col("segment").isin(np.unique(seg).tolist()))
        for r in wanted.select("segment", "bits", "body").toLocalIterator():
            here = seg == r["segment"]
            out[here] = probed(h[here], r["bits"], np.frombuffer(r["body"], np.uint8))
        return out


def segment_of(h: np.ndarray, segments: int) -> np.ndarray:
    return (((h >> np.uint64(32)) * np.uint64(segments)) >> np.uint64(32)).astype(np.int64)


def runs_of(segment: np.ndarray, rows: int = 512) -> Iterator[tuple[np.ndarray, list[tuple[int, int]]]]:
    """Ascending segments -> the segments that occur, and begin and end of each, so many at a time."""
    cuts = np.flatnonzero(np.diff(segment, prepend=-1, append=-1)) if len(segment) else np.zeros(1, np.int64)
    for at in range(0, len(cuts) - 1, rows):
        part = cuts[at:at + rows + 1]
        yield segment[part[:-1][:rows]].astype(np.int32), list(zip(part[:-1].tolist(), part[1:].tolist(), strict=True))


def counts_of(levels: np.ndarray) -> np.ndarray:
    """The middle of the counts that a level stands for; 0 for level 0."""
    return np.where(levels > 0, BASE ** np.maximum(levels - 1.0, 0) * (1 + BASE) / 2, 0.0)


def log10_of(before: np.ndarray, token: np.ndarray, pair: np.ndarray, total: int, mix: float = MIX) -> np.ndarray:
    """log10 probability of tokens from estimated counts of the context, the token and the pair."""
    one = (token + 1) / total
    two = np.minimum(pair, np.minimum(before, token)) / np.maximum(before, 1e-9)
    return np.log10((1 - mix) * np.minimum(one, 1.0) + mix * np.minimum(two, 1.0))


def _planes(h: np.ndarray) -> bytes:
    """Hashes byte plane by byte plane: the upper ones of a sorted run compress."""
    return h.view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplaned(data: bytes) -> np.ndarray:
    return np.frombuffer(np.frombuffer(data, np.uint8).reshape(8, -1).T.tobytes(), np.uint64)


def _asked(segments: int, chunk_tokens: int):
    """(uid, text) -> (uid, segment, n, body): the distinct n-grams of a chunk of documents, named by its first
    document's uid, dealt by hash range."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, held, size, first = Words(), ([], []), 0, None

        def flush() -> Iterator[pa.RecordBatch]:
            for order in (0, 1):
                h = np.unique(np.concatenate(held[order]))
                held[order].clear()
                for part, cuts in runs_of(segment_of(h, segments)):
                    yield pa.RecordBatch.from_arrays([
                        pa.array(np.full(len(part), first, np.int64)), pa.array(part),
                        pa.array(np.full(len(part), order + 1, np.int8)),
                        pa.array([_planes(h[a:b]) for a, b in cuts], pa.binary())], ["uid", "segment", "n", "body"])

        for batch in batches:
            if not batch.num_rows:
                continue
            first = batch.column(0)[0].as_py() if first is None else first
            rows, n = words.rows(batch.column(1).to_pylist())
            tokens, begin = with_ends(words.hashes[rows], n, START, END)
            before, token = pairs_of(tokens, begin)
            held[0].append(np.unique(token))
            held[1].append(mixed(before, token))
            size += len(token)
            if size >= chunk_tokens:
                yield from flush()
                size, first = 0, None
        if size:
            yield from flush()
    return run


ANSWERS = "uid long, segment int, n byte, levels binary, counts binary, digest long"


def _answered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted parts of the filter, each followed by its questions -> levels, and exact counts of tokens."""
    kinds = [pa.int64(), pa.int32(), pa.int8(), pa.binary(), pa.binary(), pa.int64()]
    names = ["uid", "segment", "n", "levels", "counts", "digest"]
    key, bits, filter_, h, c = None, 0, None, None, None
    for batch in batches:
        out: list[tuple] = []
        rows = zip(*(x.to_pylist() for x in batch.columns), strict=True)
        for of, run in groupby(rows, itemgetter(0, 1)):      # a part's questions are probed together
            asking = []
            for segment, n, uid, size, body, hs, cs in run:
                if uid >= 0:
                    asking.append((uid, _unplaned(body)))
                    continue
                key, bits, filter_ = of, size, np.frombuffer(body, np.uint8)
                if n == 1:
                    h, c = np.frombuffer(hs, np.uint64), np.frombuffer(cs, np.int64)
            if not asking:
                continue
            asked = np.concatenate([q for _, q in asking])
            known = key == of                                # a range without training n-grams has no part
            levels = (probed(asked, bits, filter_) if known else np.zeros(len(asked), np.int64)).astype(np.uint8)
            exact = None
            if of[1] == 1:
                exact = np.zeros(len(asked), np.int64)
                if known:
                    at = np.minimum(np.searchsorted(h, asked), len(h) - 1)
                    exact = np.where(h[at] == asked, c[at], 0)
            end = 0
            for uid, q in asking:
                begin, end = end, end + len(q)
                out.append((uid, *of, levels[begin:end].tobytes(), None if exact is None else exact[begin:end].tobytes(),
                            int(np.bitwise_xor.reduce(q).view(np.int64))))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


def _scored(total: int, n_texts: int, id_type: pa.DataType):
    """Sorted answers of a chunk, each followed by its documents -> the documents' scores."""
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = Words()
        answers: dict[int, list[tuple]] = {1: [], 2: []}
        ids, texts = [], []

        def answer(order: int, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            got = answers[order]
            levels = np.frombuffer(b"".join(x[0] for x in got), np.uint8)
            digest = np.bitwise_xor.reduce(np.array([x[2] for x in got], np.int64))
            if len(levels) != len(h) or digest != np.bitwise_xor.reduce(h).view(np.int64):
                raise ValueError("the documents changed between two readings")
            return counts_of(levels.astype(np.int64)), np.frombuffer(b"".join(x[1] or b"" for x in got), np.int64)

        def chunk() -> pa.RecordBatch:
            rows, n = words.rows(texts)
            last = len(words.hashes)                     # the end's and the start's rows, behind all words
            hashes = np.concatenate((words.hashes, np.array([END, START], np.uint64)))
            tokens, begin = with_ends(rows, n, last + 1, last)
            before, token = pairs_of(tokens, begin)
            used = np.unique(token)
            h1, at1 = np.unique(hashes[used], return_inverse=True)
            h2, one_of, at2 = np.unique(mixed(hashes[before], hashes[token]), return_index=True, return_inverse=True)
            about, exact = answer(1, h1)
            pair, _ = answer(2, h2)
            guess, count = np.zeros(last + 2), np.zeros(last + 2, np.int64)
            guess[used], count[used] = about[at1], exact[at1]
            guess[last + 1] = n_texts
            logs = log10_of(guess[before[one_of]], guess[token[one_of]], pair, total)
            first = np.cumsum(n + 1) - (n + 1)
            columns = [n + 1, np.add.reduceat((count > 0)[token].astype(np.int64), first),
                       np.add.reduceat(np.log10((count + 1) / total)[token], first), np.add.reduceat(logs[at2], first)]
            return pa.RecordBatch.from_arrays([pa.array(ids, id_type), *map(pa.array, columns)], names)

        for batch in batches:
            for _, kind, n, _, levels, counts, digest, doc_id, text in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if kind == 1:
                    ids.append(doc_id)
                    texts.append(text)
                    continue
                if ids:
                    yield chunk()
                    ids, texts, answers = [], [], {1: [], 2: []}
                answers[n].append((levels, counts, digest))
        if ids:
            yield chunk()
    return run


def remainder(doc_id: Column) -> Column:
    """Remainder of the crc32 of the id as text (null: of the empty text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def tasks_for(texts: DataFrame, segments: int) -> int:
    """Eight segments a task; from 8,192 tasks on up to 64, about 1 GB of text. A task takes its segments in turn."""
    most = max(1 << 13, segments // 64)
    return max(int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(segments // 8, most))


def segments_for(size: int) -> int:
    """Segments for so many bytes of training text: at least 64, and as many as the upper bound of one asks for."""
    low, high = SEGMENT_BYTES
    return int(max(64, size // min(max(low, size >> 16), high)))


def fit(texts: DataFrame) -> tuple[BloomModel, DataFrame]:
    """Count all n-grams of the column ``text``, build the filter, and return it with the table of exact token
    counts ``(h, c)``.

    Tasks combine their counts and hand them on as packed runs of one hash range each; a hot n-gram is one
    entry a task. Each range is summed, quantised and put into its own part of the filter by one task; the
    parts stay in the shared folder.
    """
    sums = texts.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b"), F.count(F.lit(1)).alias("n")).first()
    segments = segments_for(sums["b"])
    packed = texts.select(text_bytes("text").alias("b")).mapInArrow(
        _counted(segments), "segment int, n byte, hashes binary, counts binary")
    parts = stored(packed.repartition(tasks_for(texts, segments), "segment").sortWithinPartitions("segment", "n").mapInArrow(
        _filtered(), "segment int, n byte, bits long, body binary, distinct long, total long, h binary, c binary"), "lm-parts")
    own = parts.filter(F.col("n") == 1)
    known = own.agg(F.coalesce(F.sum("distinct"), F.lit(0)).alias("d"), F.coalesce(F.sum("total"), F.lit(0)).alias("t")).first()
    return (BloomModel(parts, segments, known["t"], known["d"], sums["n"]),
            own.select("h", "c").mapInArrow(_unpacked, "h long, c long"))


def scored(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    The model learns from the documents outside the held-out remainder. The distinct n-grams of each chunk of
    documents go to the task that holds their part of the filter and, for tokens, the exact counts; the
    answers come back to the chunk's documents. Both readings number the documents by their place in the
    table's files, and a chunk whose n-grams are not those asked for raises. Null and empty texts are the end
    token alone; repeated rows each get their row; without training documents every token is unknown; an
    empty table gives no rows.
    """
    model, _ = fit(docs.filter(remainder(F.col("doc_id")) != HELD_OUT).select("text"))
    tagged = docs.select("doc_id", text_bytes("text").alias("text")).withColumn("uid", F.monotonically_increasing_id())
    asked = tagged.select("uid", "text").mapInArrow(
        _asked(model.segments, CHUNK_TOKENS), "uid long, segment int, n byte, body binary")
    parts = model.parts.select("segment", "n", F.lit(-1).cast("long").alias("uid"), "bits", "body", "h", "c")
    answers = (parts.unionByName(asked, allowMissingColumns=True).repartition(tasks_for(docs, model.segments), "segment")
               .sortWithinPartitions("segment", "n", "uid").mapInArrow(_answered, ANSWERS))
    row = answers.select("uid", F.lit(0).alias("kind"), "n", "segment", "levels", "counts", "digest")
    both = row.unionByName(tagged.withColumn("kind", F.lit(1)), allowMissingColumns=True)
    total = model.tokens + model.distinct + 1
    id_type = docs.schema["doc_id"].dataType
    # one task a part of the scan: as even as the scan is
    out = (both.repartitionById(max(1, docs.rdd.getNumPartitions()), F.shiftright("uid", 33).cast("int"))
           .sortWithinPartitions("uid", "kind", "n", "segment")
           .mapInArrow(_scored(total, model.texts, to_arrow_type(id_type)),
                       f"doc_id {id_type.simpleString()}, n_tokens long, n_known long, base_score double, score double"))
    return out.select("doc_id", (remainder(F.col("doc_id")) == HELD_OUT).alias("held_out"), "n_tokens", "n_known",
                      F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")
