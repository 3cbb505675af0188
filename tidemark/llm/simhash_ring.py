"""SimHash near-duplicates with pigeonring candidate filtering.

A fingerprint of 64 bits is cut into ``m = d + 1`` consecutive segments on a ring, ``d`` the largest
number of differing bits. If two fingerprints differ in at most ``d`` bits, some segment starts a chain
whose first ``l`` segments differ in at most ``l * d / m`` bits together, for every ``l``. So a pair is
a candidate only if the chain's first ``chain`` segments meet these budgets (an equi-join on their bits,
one side with every difference the budgets allow), then only if all longer chains do, and only the rest
get the whole Hamming check.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import per_batch, stored, text_bytes
from tidemark.llm.components import connected_components, forest

BITS = 64
SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
# pairs that one numpy step compares, and from which size of a bucket its pairs are dealt to several tasks
PAIR_BLOCK = 1 << 21
HOT_PAIRS = 1 << 24
HOT_SIDE = 1 << 11
# rows of the candidate join that one task holds
ROWS_A_TASK = 1_500_000


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """SimHash of one text: a bit is 1 if more than half of the shingles' XXH64 (repeats counted) have it.

    A-Z are lower-cased, words are ``[^\\x20\\x09-\\x0D]+``; a text of fewer words than a shingle is one
    shingle, a text without words has fingerprint 0.
    """
    words = text.lower().split()
    if not words:
        return 0
    n = max(1, len(words) - shingle + 1)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[:-1]))[:n].tolist()
    stops = (ends[min(shingle, len(words)) - 1:][:n] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(BITS, np.int64)
    for at in range(0, n, 1 << 16):                    # bounded memory for very long texts
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[at:at + (1 << 16)], stops[at:at + (1 << 16)], strict=True)]
        bits = np.unpackbits(np.array(part, np.uint64).view(np.uint8).reshape(len(part), 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprint_column(text: str, shingle: int = SHINGLE_WORDS):
    """Fingerprints of a text column as signed longs (null texts: 0)."""
    def start():
        return lambda batch: pa.array(np.array([fingerprint(t, shingle) for t in batch.to_pylist()], np.uint64).view(np.int64))
    return per_batch(start, "long")(text_bytes(text))


def segments(distance: int) -> list[tuple[int, int]]:
    """(first bit, width) of the ``distance + 1`` ring segments."""
    m = distance + 1
    cuts = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:], strict=False)]


def chain_masks(distance: int, chain: int) -> list[tuple[int, list[int]]]:
    """For each start segment: the bits of its chain, and every difference in them that the budgets allow.

    The first difference is 0. With ``m = distance + 1`` the budget of ``l`` segments is ``l - 1``.
    """
    seg, out = segments(distance), []
    for i in range(len(seg)):
        parts = [seg[(i + j) % len(seg)] for j in range(chain)]
        covered = sum(((1 << w) - 1) << a for a, w in parts)
        found = [(0, 0)]
        for j, (a, w) in enumerate(parts):
            budget = (j + 1) * distance // (distance + 1)
            found = [(mask | sum(1 << b for b in flips), used + k)
                     for mask, used in found for k in range(budget - used + 1)
                     for flips in itertools.combinations(range(a, a + w), k)]
        out.append((covered, sorted({mask for mask, _ in found})))
    return out


def ring_linked(a: np.ndarray, b: np.ndarray, start: np.ndarray, distance: int) -> np.ndarray:
    """Which pairs pass every chain budget from ``start`` on; the whole ring's budget is the distance."""
    seg = segments(distance)
    m = len(seg)
    diff = a ^ b
    per = np.stack([np.bitwise_count((diff >> np.uint64(s)) & np.uint64((1 << w) - 1)) for s, w in seg]).astype(np.int16)
    total, ok = np.zeros(len(a), np.int16), np.ones(len(a), bool)
    at = np.arange(len(a))
    for length in range(1, m + 1):
        total += per[(start + length - 1) % m, at]
        ok &= total <= length * distance // m
    return ok & (np.bitwise_count(diff) <= distance)


def _probe_rows(distance: int, chain: int):
    """Batches of fingerprints -> (key, fp, probe): each fingerprint's chains, exact and with allowed differences."""
    plans = chain_masks(distance, chain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                part = fps[at:at + 4096]
                for i, (covered, masks) in enumerate(plans):
                    keys = (part & np.uint64(covered))[:, None] ^ np.array(masks, np.uint64)[None, :]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(part, len(masks)).view(np.int64)),
                        pa.array(np.tile(np.array([0] + [1] * (len(masks) - 1), np.int8), len(part))),
                        pa.array(np.full(keys.size, i, np.int8))], ["key", "fp", "probe", "start"])
    return run


def _bucket_edges(distance: int):
    """One task's buckets -> a spanning forest of its verified links; pairs of hot buckets as blocks instead."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols = [[], [], [], []]
        for batch in batches:
            for i, kind in enumerate((np.int64, np.uint64, np.int8, np.int8)):
                cols[i].append(batch.column(i).to_numpy(zero_copy_only=False).view(kind))
        if not cols[0]:
            return
        key, fp, probe, start = map(np.concatenate, cols)
        del cols
        order = np.lexsort((probe, start, key))
        key, fp, probe, start = key[order], fp[order], probe[order], start[order]
        del order
        new = np.flatnonzero(np.concatenate(([True], (key[1:] != key[:-1]) | (start[1:] != start[:-1]))))
        size = np.diff(np.append(new, len(key)))
        exact = np.add.reduceat((probe == 0).astype(np.int64), new)
        useful = (exact > 0) & (size > 1)
        new, size, exact = new[useful], size[useful], exact[useful]
        work = size * exact
        found = np.empty((0, 2), np.uint64)
        hot = np.flatnonzero(work > HOT_PAIRS)
        calm = np.flatnonzero(work <= HOT_PAIRS)
        for part in np.split(calm, np.flatnonzero(np.diff(np.cumsum(work[calm]) // PAIR_BLOCK)) + 1) if len(calm) else ():
            # every row of a bucket against every exact row of it, all buckets of the part at once
            w = work[part]
            group = np.repeat(np.arange(len(part)), w)
            k = np.arange(w.sum()) - np.repeat(np.cumsum(w) - w, w)
            i, j = new[part][group] + k // exact[part][group], new[part][group] + k % exact[part][group]
            keep = np.where(probe[i] == 0, i < j, fp[i] < fp[j])
            i, j = i[keep], j[keep]
            ok = ring_linked(fp[i], fp[j], start[i].astype(np.int64), distance)
            found = forest(np.concatenate((found, np.stack((fp[i[ok]], fp[j[ok]]), axis=1))))
        none = pa.nulls(len(found), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].view(np.int64)), pa.array(found[:, 1].view(np.int64)),
                                          pa.nulls(len(found), pa.int8()), none, none], ["a", "b", "start", "left", "right"])
        for g in hot:
            every, ex = fp[new[g]:new[g] + size[g]], fp[new[g]:new[g] + exact[g]]
            for x in range(0, len(every), HOT_SIDE):
                for y in range(0, len(ex), HOT_SIDE):
                    yield pa.RecordBatch.from_arrays([
                        pa.nulls(1, pa.int64()), pa.nulls(1, pa.int64()), pa.array([start[new[g]]], pa.int8()),
                        pa.array([every[x:x + HOT_SIDE].tobytes()]), pa.array([ex[y:y + HOT_SIDE].tobytes()])],
                        ["a", "b", "start", "left", "right"])
    return run


def _block_edges(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.empty((0, 2), np.uint64)
            for s, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                left, right = np.frombuffer(left, np.uint64), np.frombuffer(right, np.uint64)
                a, b = np.repeat(left, len(right)), np.tile(right, len(left))
                ok = (a != b) & (np.bitwise_count(a ^ b) <= distance)
                a, b = a[ok], b[ok]
                ok = ring_linked(a, b, np.full(len(a), s, np.int64), distance)
                found = forest(np.concatenate((found, np.stack((a[ok], b[ok]), axis=1))))
            yield pa.RecordBatch.from_arrays([pa.array(found[:, 0].view(np.int64)), pa.array(found[:, 1].view(np.int64))], ["a", "b"])
    return run


def chain_for(fingerprints: int) -> int:
    """Chain segments in the join key so that the expected random candidates a fingerprint stay few.

    Two segments are 25 bits with 70 probes a fingerprint, three are 38 bits with about 1,400. The links
    found are the same for every choice.
    """
    return 2 if fingerprints < 50_000_000 else 3


def links(fps: DataFrame, distance: int = MAX_DISTANCE, chain: int | None = None) -> DataFrame:
    """Edges ``(a, b)`` whose components are those of all fingerprints that differ in at most ``distance`` bits.

    ``fps`` is a stored table with one column ``fp`` of distinct signed longs. Buckets that share a chain
    key are compared inside the task that holds them; a bucket with more than ``HOT_PAIRS`` pairs is dealt
    out in blocks to all tasks. No pair list leaves a task: each returns a spanning forest of the links it
    verified, so the output grows with the fingerprints also inside a dense group of near copies.
    """
    spark = fps.sparkSession
    n = fps.count()
    chain = min(chain or chain_for(n), distance + 1)
    per = sum(len(masks) for _, masks in chain_masks(distance, chain))
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n * per // ROWS_A_TASK))
    rows = fps.select("fp").mapInArrow(_probe_rows(distance, chain), "key long, fp long, probe byte, start byte")
    dealt = rows.repartition(tasks, "key", "start").mapInArrow(
        _bucket_edges(distance), "a long, b long, start byte, left binary, right binary")
    dealt = stored(dealt, "simhash-buckets")
    blocks = dealt.filter(F.col("left").isNotNull()).select("start", "left", "right")
    edges = dealt.filter(F.col("left").isNull()).select("a", "b")
    if not blocks.isEmpty():
        edges = edges.union(blocks.repartition(tasks).mapInArrow(_block_edges(distance), "a long, b long"))
    return edges


def components_of(docs: DataFrame, distance: int = MAX_DISTANCE) -> DataFrame:
    """``fp -> (root, component_id)`` for the distinct fingerprints of ``docs`` (a stored table with
    ``doc_id`` and ``fp``): ``root`` names the component, ``component_id`` is the smallest doc_id in it.
    Exact copies meet in one fingerprint before any join. The components' smallest ids are stored before the
    fingerprints are joined with them, so that Spark can split those of a large component over tasks."""
    fps = stored(docs.groupBy("fp").agg(F.min("doc_id").alias("first")), "simhash-fps")
    roots = connected_components(links(fps.select("fp"), distance))
    rooted = stored(fps.join(roots, fps["fp"] == roots["node"], "left")
                    .select("fp", "first", F.coalesce("root", "fp").alias("root")), "simhash-rooted")
    least = stored(rooted.groupBy("root").agg(F.min("first").alias("component_id")), "simhash-least")
    return stored(rooted.join(least, "root").select("fp", "root", "component_id"), "simhash-components")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """One row a document: doc_id, fingerprint (16 hex digits), component_id.

    Null and wordless texts have fingerprint 0 and link like any other; repeated rows each get a row; a
    null doc_id never becomes a component's id unless the component has no other; empty tables give none.
    """
    tagged = stored(docs.select("doc_id", fingerprint_column("text", shingle).alias("fp")), "simhash-docs")
    comp = components_of(tagged, distance)
    return (tagged.join(comp, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id"))


def first_of_each(docs: DataFrame, shingle: int = SHINGLE_WORDS, distance: int = MAX_DISTANCE) -> DataFrame:
    """Keep one document of each component, with its own columns: the smallest doc_id (nulls last), of rows
    that repeat an id the one with the smallest row hash, of rows alike in every column one.

    Only (doc_id, row hash, fingerprint) are stored. The kept pairs of id and hash meet the documents in one
    shuffled join at every size, which builds its table from the pairs: the texts move once and are not sorted.
    """
    h = F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns])
    tagged = stored(docs.select(F.col("doc_id").alias("doc_id"), h.alias("h"), fingerprint_column("text", shingle).alias("fp")), "simhash-rows")
    comp = components_of(tagged.select("doc_id", "fp"), distance)
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("d"), F.col("h").alias("h"))
    per_fp = tagged.groupBy("fp").agg(F.min(order).alias("best"))
    winners = comp.join(per_fp, "fp").groupBy("root").agg(F.min("best").alias("best")).select(F.col("best.d").alias("kept_id"), F.col("best.h").alias("kept_h"))
    copies = tagged.groupBy("doc_id", "h").agg(F.count(F.lit(1)).alias("copies"))
    kept = stored(winners.join(copies, F.col("kept_id").eqNullSafe(F.col("doc_id")) & (F.col("kept_h") == F.col("h")))
                  .select("kept_id", "kept_h", "copies"), "simhash-kept").hint("shuffle_hash")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.select(row, docs["doc_id"].alias("row_id"), h.alias("row_h"))
    found = rows.join(kept, F.col("row_id").eqNullSafe(F.col("kept_id")) & (F.col("row_h") == F.col("kept_h")))
    # rows alike in every column lie together; the others need no second look
    alike = found.filter("copies > 1").groupBy("row_id", "row_h").agg(F.first("row").alias("row"))
    return found.filter("copies = 1").select("row.*").unionByName(alike.select("row.*"))
