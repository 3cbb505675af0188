"""K-d tree sharding: weighted median splits along the widest metadata dimension.

A node of the tree that should become ``k`` shards is split where ``floor(k / 2) / k`` of its bytes lie on
one side, along the dimension whose values are spread widest inside the node. The cut is found by counting
bytes in histogram cells and refining the cell that holds it: first by the dimension's value, then, if many
rows share one value, by a hash of the row, so that no value is too heavy to be cut. All nodes of a level
are refined together; the driver sees cells, never rows.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import buckets_for, ordered_rank, rank_within, stored

SHARDS = 24
CELLS = 512
# cells that come to the driver in one round, of all nodes together (each keeps at least 8)
MAX_CELLS = 1 << 17
# a cut is refined until its cell holds at most this share of a shard's target
TOLERANCE = 0.0005
ROUNDS = 12
HASH_SPAN = float(1 << 52)


def value_places(docs: DataFrame, column: str) -> DataFrame:
    """``value, place`` of a string column's distinct values: the place in their order, over their number, so in
    [0, 1) and different for different values of any length (null counts as the empty text)."""
    values = docs.select(_named(docs, column).alias("value")).distinct()
    ranked = stored(ordered_rank(values, [F.col("value").asc()], "place"), "shard-values")
    return ranked.withColumn("place", F.col("place") / F.lit(float(max(1, ranked.count()))))


def _named(docs: DataFrame, column: str) -> Column:
    return F.coalesce(docs[column].cast("string"), F.lit(""))


@dataclass
class Cut:
    """The cut of one node: rows with (value, hash) below ``(value, tie)`` go left."""

    node: int
    dim: int
    value: float
    tie: float


def _cells(rows: DataFrame, ranges: list[tuple]) -> dict[int, list[tuple]]:
    """Each node's (cell, bytes, least, largest) in its range; ``ranges``: (node, dim, low, high, fixed value or None)."""
    spark = rows.sparkSession
    cells = max(8, min(CELLS, MAX_CELLS // len(ranges)))
    r = spark.createDataFrame(ranges, "node int, dim int, low double, high double, at double")
    j = rows.join(F.broadcast(r), "node")
    v = F.get(F.col("v"), F.col("dim"))
    x = F.when(F.col("at").isNull(), v).otherwise(F.col("tie"))
    inside = (x >= F.col("low")) & (x < F.col("high")) & (F.col("at").isNull() | (v == F.col("at")))
    cell = F.least(F.lit(cells - 1), F.floor((x - F.col("low")) / (F.col("high") - F.col("low")) * cells)).cast("int")
    got = (j.filter(inside).groupBy("node", cell.alias("cell"))
           .agg(F.sum("size").alias("w"), F.min(x).alias("lo"), F.max(x).alias("hi")).collect())
    out: dict[int, list] = {}
    for g in got:
        out.setdefault(g["node"], []).append((g["cell"], g["w"], g["lo"], g["hi"]))
    return {k: sorted(v) for k, v in out.items()}


def find_cuts(rows: DataFrame, nodes: dict[int, int], target: float) -> list[Cut]:
    """Cuts of the nodes ``node -> shards`` at their weighted medians.

    Every round is one aggregate over all open nodes with at most ``CELLS`` cells each. A cell that holds
    the cut becomes the next range; a cell with one value goes on by the rows' hash.
    """
    spark = rows.sparkSession
    ids = spark.createDataFrame([(n,) for n in nodes], "node int")
    dims = len(rows.select("v").first()["v"])
    got = (rows.join(F.broadcast(ids), "node").groupBy("node")
           .agg(F.sum("size").alias("w"), *[F.min(F.col("v")[d]).alias(f"lo{d}") for d in range(dims)],
                *[F.max(F.col("v")[d]).alias(f"hi{d}") for d in range(dims)]).collect())
    cuts, state = [], {}
    for g in got:
        width, dim = max((g[f"hi{d}"] - g[f"lo{d}"], -d) for d in range(dims))
        dim, k = -dim, nodes[g["node"]]
        low, high = g[f"lo{dim}"], math.nextafter(g[f"hi{dim}"], math.inf)
        at = None
        if width == 0:                                   # all rows alike: cut by hash alone
            at, low, high = low, 0.0, HASH_SPAN
        state[g["node"]] = [dim, low, high, at, g["w"] * (k // 2) / k]
    for _ in range(ROUNDS):
        if not state:
            break
        cells = _cells(rows, [(n, s[0], s[1], s[2], s[3]) for n, s in state.items()])
        for node, found in cells.items():
            dim, low, high, at, want = state[node]
            below = 0
            for cell, w, lo, hi in found:
                if below + w >= want:
                    break
                below += w
            # the cell holds the cut: cut before or behind it if that is near enough, else look inside
            before, behind = abs(want - below), abs(below + w - want)
            if min(before, behind) <= TOLERANCE * target or (at is not None and lo == hi):
                x = lo if before <= behind else math.nextafter(hi, math.inf)
                cuts.append(Cut(node, dim, x if at is None else at, 0.0 if at is None else x))
                del state[node]
            elif lo == hi:
                state[node] = [dim, 0.0, HASH_SPAN, lo, want - below]
            else:
                state[node] = [dim, lo, math.nextafter(hi, math.inf), at, want - below]
    for node, (dim, low, _high, at, _want) in state.items():
        cuts.append(Cut(node, dim, low if at is None else at, 0.0 if at is None else low))
    return cuts


def split_rows(rows: DataFrame, nodes: dict[int, int], target: float) -> tuple[DataFrame, dict[int, int]]:
    """One level: every node with several shards gets two children (2n + 1 left, 2n + 2 right)."""
    spark = rows.sparkSession
    cuts = find_cuts(rows, {n: k for n, k in nodes.items() if k > 1}, target)
    table = spark.createDataFrame([(c.node, c.dim, c.value, c.tie) for c in cuts], "node int, dim int, at double, cut double")
    v = F.get(F.col("v"), F.col("dim"))
    left = (v < F.col("at")) | ((v == F.col("at")) & (F.col("tie") < F.col("cut")))
    node = F.when(F.col("dim").isNull(), F.col("node")).otherwise(2 * F.col("node") + F.when(left, 1).otherwise(2))
    out = rows.join(table, "node", "left").select("uid", "doc_id", "size", "crc", "v", "tie", node.cast("int").alias("node"))
    down: dict[int, int] = {}
    done = {c.node for c in cuts}
    for n, k in nodes.items():
        if n in done:
            down[2 * n + 1], down[2 * n + 2] = k // 2, k - k // 2
        else:
            down[n] = k
    return out, down


def sharded(docs: DataFrame, shards: int | None = SHARDS, target_bytes: int | None = None) -> DataFrame:
    """One row a document: doc_id, size, text_crc32, law (``bytes``), shard, slot, grown_shard (null).

    The dimensions are language and source, by the place of the value among the column's distinct values, and length. ``size`` is the text's UTF-8 bytes plus 8 (null: 8).
    Leaves are split until they are to hold ``target_bytes``, which defaults to the whole size over
    ``shards``. Null values sort first; ties, repeated rows and copies are cut by the hash of the stored row
    id, so any value may hold any share of the rows. An empty table gives no rows. Slots count from 0 in
    every shard.
    """
    size = (F.coalesce(F.octet_length("text"), F.lit(0)) + 8).cast("long")
    uid = F.monotonically_increasing_id()
    rows = docs.select(uid.alias("uid"), "doc_id", size.alias("size"), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("crc"),
                       _named(docs, "lang").alias("d0"), _named(docs, "source").alias("d1"),
                       (F.log1p(F.coalesce(F.char_length("text"), F.lit(0)).cast("double")) / 40).alias("d2"))
    # the places join by value: broadcast while the values are few, else shuffled, a hot value split by Spark
    for d, column in enumerate(("lang", "source")):
        places = value_places(docs, column).withColumnRenamed("place", f"p{d}")
        rows = rows.join(places, F.col(f"d{d}") == F.col("value")).drop("value")
    rows = rows.select("uid", "doc_id", "size", "crc", F.array("p0", "p1", "d2").alias("v"))
    tie = F.shiftrightunsigned(F.xxhash64("uid"), 12).cast("double")
    rows = stored(rows, "shard-rows").withColumn("tie", tie)
    whole = rows.agg(F.sum("size").alias("w"), F.count(F.lit(1)).alias("n"),
                     *[F.min(F.col("v")[d]).alias(f"a{d}") for d in range(3)], *[F.max(F.col("v")[d]).alias(f"b{d}") for d in range(3)]).first()
    count = whole["n"]
    if not count:
        return rows.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), F.lit(0).alias("shard"),
                           F.lit(0).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
    # every dimension over its whole range is 1 wide, so widths compare
    scaled = [(F.col("v")[d] - F.lit(whole[f"a{d}"])) / F.lit((whole[f"b{d}"] - whole[f"a{d}"]) or 1.0) for d in range(3)]
    rows = rows.select("uid", "doc_id", "size", "crc", F.array(*scaled).alias("v"), "tie", F.lit(0).alias("node"))
    leaves = shards if target_bytes is None else max(1, -(-whole["w"] // target_bytes))
    target = whole["w"] / leaves
    nodes = {0: leaves}
    level = 0
    while True:
        open_ = [n for n, k in nodes.items() if k > 1]
        if not open_:
            break
        rows, deeper = split_rows(rows, nodes, target)
        if deeper.keys() == nodes.keys():
            break
        nodes, level = deeper, level + 1
        if level % 6 == 0:
            rows = stored(rows, "shard-level")
    number = rows.sparkSession.createDataFrame([(n, i) for i, n in enumerate(sorted(nodes))], "node int, shard int")
    placed = stored(rows.join(number, "node").select("uid", "doc_id", "size", "crc", "shard"), "shard-placed")
    ranked = rank_within(placed, ["shard"], "uid", "slot", buckets_for(count))
    return ranked.select("doc_id", "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))
