"""Space-filling clustering (S13): interleaved ranks of the cluster columns, and files touched per filter."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import materialize_checkpoint

# ranks of a column are 0 to 2^BITS - 1: bits that each column gives to the interleaved key
BITS = 8


def rank_bounds(df: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """One row ``bounds``: the least value of each of ``2^bits`` slices of about equal row counts, ascending.

    Values are weighted by their rows, so a hot value takes as many ranks as its share and the others keep the
    rest apart. Rows are counted by value map-side; the distinct values are ranked by range partitions whose counts,
    one row a partition, give each its first place. Nulls have no place, a column of nulls has no bounds.
    """
    values = df.select(F.col(f"`{column}`").alias("v")).where("v IS NOT NULL").groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    # written once: a second range sampling could cut the partitions elsewhere
    values = materialize_checkpoint(values.repartitionByRange("v").withColumn("p", F.spark_partition_id()))
    sums = values.groupBy("p").agg(F.sum("n").alias("rows"))
    upto = Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    first = sums.select("p", F.coalesce(F.sum("rows").over(upto), F.lit(0)).alias("first"),
                        F.sum("rows").over(Window.partitionBy()).alias("total"))
    inside = Window.partitionBy("p").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("first") + F.coalesce(F.sum("n").over(inside), F.lit(0))
    ranked = values.join(first, "p").select("v", F.floor(place * F.lit(1 << bits) / F.col("total")).alias("slice"))
    return ranked.groupBy("slice").agg(F.min("v").alias("v")).agg(F.sort_array(F.collect_list("v")).alias("bounds"))


def with_rank(df: DataFrame, value: Column, bounds: str, name: str, bits: int = BITS) -> DataFrame:
    """``df`` with column ``name``: number of bounds up to the value, less one (null: 0), by bisection. Each halving
    is a projection of its own, so that it is computed once, in generated code."""
    df = df.withColumn(name, F.lit(0))
    for b in reversed(range(bits)):
        beyond = F.get(F.col(bounds), F.col(name) + F.lit(1 << b)) <= value
        df = df.withColumn(name, F.col(name) + F.when(beyond, F.lit(1 << b)).otherwise(F.lit(0)))
    return df.withColumn(name, F.col(name).cast("long"))


def interleave(ranks: list[Column], bits: int = BITS) -> Column:
    """One long that takes a bit of each rank in turn, the highest bits first (Morton order)."""
    if len(ranks) * bits > 62:
        raise ValueError(f"{len(ranks)} columns of {bits} bits do not fit a long")
    out = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for r in ranks:
            out = F.shiftleft(out, 1).bitwiseOR(F.shiftright(r, b).bitwiseAND(F.lit(1).cast("long")))
    return out


def interleaved(df: DataFrame, cluster_by: list[str], partitions: int, bits: int = BITS) -> DataFrame:
    """Rows range-partitioned and sorted by the interleaved ranks of the cluster columns.

    Unlike ``writers.clustered``, no column comes first: each file covers a narrow range of every one, so filters on
    any of them skip files. A row hash is the last range key, so rows that are equal in all cluster columns are
    split over several tasks. Bounds are one row of at most ``2^bits`` values a column. The input is read once more
    for each cluster column (that column alone) and once for the range sample.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    out = df.select(row.alias("row"), F.xxhash64(row).alias("spread"))
    for i, c in enumerate(cluster_by):
        out = out.crossJoin(F.broadcast(rank_bounds(df, c, bits).withColumnRenamed("bounds", f"bounds{i}")))
        out = with_rank(out, F.col("row").getField(c), f"bounds{i}", f"rank{i}", bits)
    key = interleave([F.col(f"rank{i}") for i in range(len(cluster_by))], bits)
    return (out.select("row", "spread", key.alias("key")).repartitionByRange(partitions, "key", "spread")
            .sortWithinPartitions("key").select("row.*"))


def interleaved_write(df: DataFrame, path: str, cluster_by: list[str], partitions: int, bits: int = BITS) -> str:
    interleaved(df, cluster_by, partitions, bits).write.mode("overwrite").parquet(path)
    return path


def files_touched(df: DataFrame, columns: list[str]) -> DataFrame:
    """How many files an equality filter has to open: ``column_name, filter_values, files, touched, needed``.

    ``df`` is a scan of files. For every distinct value of a column, ``touched`` counts the files whose least and
    greatest value enclose it (those that statistics cannot skip) and ``needed`` the files that hold it, both
    summed over all values; ``files`` are all files. Reads the named columns once each. Distinct values are numbered
    in order without gaps, so no file meets the values it encloses one by one.
    """
    out = None
    name = F.col("_metadata.file_path").alias("file")
    total = df.select(name).agg(F.count_distinct("file").alias("files"))
    for c in columns:
        held = df.select(name, F.col(f"`{c}`").alias("v")).where("v IS NOT NULL").groupBy("file", "v").agg(F.count(F.lit(1)).alias("n"))
        held = materialize_checkpoint(held)
        values = held.select("v").distinct()
        placed = materialize_checkpoint(values.repartitionByRange("v").withColumn("p", F.spark_partition_id()))
        sizes = placed.groupBy("p").agg(F.count(F.lit(1)).alias("k"))
        before = sizes.select("p", F.coalesce(F.sum("k").over(Window.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)),
                                              F.lit(0)).alias("b"))
        place = (placed.join(before, "p")
                 .select("v", (F.col("b") + F.row_number().over(Window.partitionBy("p").orderBy("v"))).alias("place")))
        # places have no gaps, so a file encloses as many values as lie from its least place to its greatest
        spans = held.join(place, "v").groupBy("file").agg((F.max("place") - F.min("place") + 1).alias("enclosed"),
                                                          F.count(F.lit(1)).alias("held"))
        part = (spans.agg(F.coalesce(F.sum("enclosed"), F.lit(0)).alias("touched"), F.coalesce(F.sum("held"), F.lit(0)).alias("needed"))
                .crossJoin(values.agg(F.count(F.lit(1)).alias("filter_values"))).crossJoin(total)
                .select(F.lit(c).alias("column_name"), "filter_values", "files", "touched", "needed"))
        out = part if out is None else out.unionByName(part)
    return out
