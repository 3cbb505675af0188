"""Benchmark decontamination: a prefix-filtered containment join with exact verification.

Every benchmark item gives windows: each run of ``window`` consecutive words, or all words of a shorter
item. A window is the set of its word shingles; its shingles are ordered by how rare they are in the
documents, and for containment ``t`` only the first ``n - ceil(t * n) + 1`` of them (the necessary prefix)
can be missed by no match. Documents are joined on prefix shingles alone; the positional bound fixes where
the window would lie, the length bound keeps it inside the document, and the words there are compared.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, stored, text_bytes

WINDOW = 10
SHINGLE = 3
# windows of one broadcast block (about 100 bytes each); a larger benchmark is joined block by block
BLOCK_WINDOWS = 200_000

# word characters are 0-9, A-Z (lower-cased), a-z and everything beyond ASCII
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: bytes) -> list[bytes]:
    return text.translate(_FOLD).split()


def item_windows(items: DataFrame, window: int = WINDOW) -> DataFrame:
    """``(item_id, words)``: the distinct windows of every item, as arrays of lower-case words.

    Null texts and texts without words have none; items that share an id add up; the windows of a null
    item_id mark words but name no item.
    """
    lower = F.translate(F.coalesce("text", F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    w = F.regexp_extract_all(lower, F.lit(r"([^\x00-\x2F\x3A-\x60\x7B-\x7F]+)"), F.lit(1))
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - (window - 1), F.lit(1)))
    return (items.select("item_id", w.alias("w")).filter(F.size("w") > 0)
            .select("item_id", F.explode(F.transform(starts, lambda i: F.slice("w", i, window))).alias("words")).distinct())


class Vocabulary:
    """Words of some windows as small numbers; rows of the windows as number lists."""

    def __init__(self, windows: list[list[str]]):
        self.of: dict[bytes, int] = {}
        self.rows = [[self.of.setdefault(w.encode(), len(self.of)) for w in ws] for ws in windows]

    def numbers(self, text_words: list[bytes]) -> np.ndarray:
        get = self.of.get
        return np.array([get(w, -1) for w in text_words], np.int64)


def shingle_numbers(ids: np.ndarray, width: int, base: int) -> np.ndarray:
    """A number for each run of ``width`` known words; -1 where a word is unknown. Exact: no hash."""
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    out, ok = np.zeros(n, np.int64), np.ones(n, bool)
    for k in range(width):
        part = ids[k:k + n]
        out = out * base + part
        ok &= part >= 0
    return np.where(ok, out, -1)


class Block:
    """One broadcast block of windows, with its shingles numbered by first use."""

    def __init__(self, windows: list[list[str]], shingle: int = SHINGLE):
        self.vocabulary = Vocabulary(windows)
        self.base = len(self.vocabulary.of) + 1
        self.width = min(shingle, max(1, int(62 // math.log2(self.base + 1))))
        self.windows = [np.array(r, np.int64) for r in self.vocabulary.rows]
        # a window shorter than a shingle is one shingle of its own length
        self.shingles = [shingle_numbers(r, min(self.width, len(r)), self.base) for r in self.windows]
        self.widths = sorted({min(self.width, len(r)) for r in self.windows})
        keys = {(min(self.width, len(r)), int(s)) for r, ss in zip(self.windows, self.shingles, strict=True) for s in ss}
        self.known = {w: np.array(sorted(k for v, k in keys if v == w), np.int64) for w in self.widths}


def _find(known: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions of ``keys`` that are in the sorted ``known``, and their places there."""
    at = np.minimum(np.searchsorted(known, keys), len(known) - 1)
    hit = np.flatnonzero(known[at] == keys)
    return hit, at[hit]


def _frequencies(block_value):
    """Texts -> (width, shingle, documents that hold it), combined in each task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = block_value.value
        total = {w: np.zeros(len(block.known[w]), np.int64) for w in block.widths}
        for batch in batches:
            for text in batch.column(0).to_pylist():
                ids = block.vocabulary.numbers(words(text))
                for w in block.widths:
                    total[w][np.unique(_find(block.known[w], shingle_numbers(ids, w, block.base))[1])] += 1
        for w in block.widths:
            some = np.flatnonzero(total[w])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), w)), pa.array(block.known[w][some]),
                                              pa.array(total[w][some])], ["width", "shingle", "n"])
    return run


class Index:
    """Prefix shingles of a block's windows -> (window, place in it), rarest shingles first."""

    def __init__(self, block: Block, frequency: dict[tuple[int, int], int], containment: float):
        rows: dict[int, list[tuple[int, int, int]]] = {w: [] for w in block.widths}
        for i, shingles in enumerate(block.shingles):
            w = min(block.width, len(block.windows[i]))
            order = sorted(range(len(shingles)), key=lambda k: (frequency.get((w, int(shingles[k])), 0), int(shingles[k]), k))
            for k in order[:len(shingles) - math.ceil(containment * len(shingles)) + 1]:
                rows[w].append((int(shingles[k]), i, k))
        self.block, self.widths = block, [w for w in block.widths if rows[w]]
        self.keys, self.bounds, self.window, self.place = {}, {}, {}, {}
        for w in self.widths:
            key, window, place = np.array(sorted(rows[w]), np.int64).T
            self.keys[w], first = np.unique(key, return_index=True)
            self.bounds[w] = np.append(first, len(key))
            self.window[w], self.place[w] = window, place
        self.length = np.array([len(x) for x in block.windows], np.int64)
        self.first = np.cumsum(self.length) - self.length
        self.flat = np.concatenate(block.windows) if block.windows else np.empty(0, np.int64)

    def occurrences(self, text_words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(start, window) of every exact occurrence in a document."""
        ids = self.block.vocabulary.numbers(text_words)
        starts, found = [], []
        for w in self.widths:
            at, key = _find(self.keys[w], shingle_numbers(ids, w, self.block.base))
            if not len(at):
                continue
            n = self.bounds[w][key + 1] - self.bounds[w][key]
            row = np.repeat(self.bounds[w][key], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            start, window = np.repeat(at, n) - self.place[w][row], self.window[w][row]
            fits = (start >= 0) & (start + self.length[window] <= len(ids))          # positional and length bounds
            start, window = start[fits], window[fits]
            length = self.length[window]
            off = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
            same = ids[np.repeat(start, length) + off] == self.flat[np.repeat(self.first[window], length) + off]
            full = np.add.reduceat(same, np.cumsum(length) - length) == length if len(length) else np.empty(0, bool)
            starts.append(start[full])
            found.append(window[full])
        if not starts:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.concatenate(starts), np.concatenate(found)


def _marker(index_value, items_value):
    """Text -> (n_words, merged spans of hit words, item ids) for one block of windows."""
    kind = pa.struct([("n_words", pa.int64()), ("spans", pa.list_(pa.int64())), ("items", pa.list_(pa.int64()))])

    def start():
        index, items = index_value.value, items_value.value

        def one(text: bytes) -> dict:
            w = words(text)
            starts, windows = index.occurrences(w)
            spans: list[int] = []
            ids: set = set()
            if len(starts):
                order = np.argsort(starts, kind="stable")
                for a, b in zip(starts[order].tolist(), (starts + index.length[windows])[order].tolist(), strict=True):
                    if spans and a <= spans[-1]:
                        spans[-1] = max(spans[-1], b)
                    else:
                        spans += [a, b]
                for x in set(windows.tolist()):
                    ids.update(items[x])
            return {"n_words": len(w), "spans": spans, "items": list(ids)}

        return lambda batch: pa.array([one(t) for t in batch.to_pylist()], kind)

    return per_batch(start, "n_words long, spans array<long>, items array<long>")


def _blocks(windows: DataFrame, size: int) -> Iterator[tuple[list[list[str]], list[list[int]]]]:
    """The windows in blocks of bounded size, each window once with the items that hold it."""
    rows = windows.groupBy("words").agg(F.collect_set("item_id").alias("items")).toLocalIterator()
    ws, ids = [], []
    for r in rows:
        ws.append(list(r["words"]))
        ids.append(list(r["items"]))
        if len(ws) == size:
            yield ws, ids
            ws, ids = [], []
    if ws:
        yield ws, ids


def marked(docs: DataFrame, items: DataFrame, carry: list[str], window: int = WINDOW, containment: float = 1.0,
           block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """``row`` (the columns named in ``carry``), ``n_words``, ``n_hit``, ``items`` (ids, distinct) a document.

    The benchmark is the stated query set: it is taken in blocks of ``block_windows`` windows, each broadcast
    on its own, so its size is bounded whatever the benchmark's. One block needs two passes over the texts
    (shingle frequencies, then the join) and no shuffle of documents. Null and empty texts have no words and
    no hits; repeated rows each get their result; an empty benchmark marks nothing.
    """
    spark = docs.sparkSession
    sc = spark.sparkContext
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    out = docs.select(row, text_bytes("text").alias("b"), F.array().cast("array<struct<n_words:long,spans:array<long>,items:array<long>>>").alias("found"))
    if containment != 1.0:
        raise ValueError("verification is exact: only containment 1.0 is offered")
    any_block = False
    for ws, ids in _blocks(stored(item_windows(items, window), "decontam-windows"), block_windows):
        any_block = True
        block = Block(ws)
        shared = sc.broadcast(block)
        freq = (docs.select(text_bytes("text").alias("b")).mapInArrow(_frequencies(shared), "width long, shingle long, n long")
                .groupBy("width", "shingle").agg(F.sum("n").alias("n")).collect())       # at most the block's shingles
        index = Index(block, {(r["width"], r["shingle"]): r["n"] for r in freq}, containment)
        mark = _marker(sc.broadcast(index), sc.broadcast(ids))
        out = out.select("row", "b", F.array_append("found", mark(F.col("b"))).alias("found"))
    if not any_block:
        count = per_batch(lambda: lambda batch: pa.array([len(words(t)) for t in batch.to_pylist()], pa.int64()), "long")
        return out.select("row", count(F.col("b")).alias("n_words"), F.lit(0).cast("long").alias("n_hit"),
                          F.array().cast("array<long>").alias("items"))
    return out.select("row", F.col("found")[0]["n_words"].alias("n_words"), _covered(F.col("found")).alias("n_hit"),
                      F.array_distinct(F.flatten(F.transform("found", lambda x: x["items"]))).alias("items"))


def _covered(found):
    """Words covered by the spans of all blocks (spans of one block are merged already)."""
    ends = F.flatten(F.transform(found, lambda f: F.transform(
        F.filter(f["spans"], lambda x, i: i % 2 == 0), lambda a, i: F.struct(a.alias("a"), F.get(f["spans"], 2 * i + 1).alias("b")))))
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to"))
    return F.aggregate(F.array_sort(ends), zero, lambda s, x: F.struct(
        (s["n"] + F.greatest(x["b"] - F.greatest(x["a"], s["to"]), F.lit(0).cast("long"))).alias("n"),
        F.greatest(s["to"], x["b"]).alias("to")), lambda s: s["n"])


def contamination(docs: DataFrame, items: DataFrame) -> DataFrame:
    """One row a document: n_words, n_hit, n_items, items_sha256 (of the ids sorted as strings), contaminated."""
    m = marked(docs, items, ["doc_id"])
    ids = F.array_join(F.array_sort(F.transform("items", lambda x: x.cast("string"))), ",")
    return m.select("row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(ids, 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents without a hit word, with their own columns."""
    return marked(docs, items, docs.columns).filter("n_hit = 0").select("row.*")
