"""Sinks: snapshot export (S7), materialisations (S11/S12), clustered layout (S13), JSON lines."""

from __future__ import annotations

import datetime as _dt
from urllib.parse import unquote

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions.columns import export_stamp
from tidemark.session import folder_bytes


# least buckets of a materialised table, and the bytes that one bucket stands for
BUCKETS = 16
BUCKET_BYTES = 1 << 30
# the same for the files of a clustered table
FILES = 32
FILE_BYTES = 256 << 20


def buckets_for_bytes(size: int) -> int:
    return max(BUCKETS, -(-size // BUCKET_BYTES))


def scanned_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, by listing their folders. (The planner's size of a join is no
    table size: it multiplies both sides.) A frame that reads no files, such as a checkpointed one, has no such
    size: the caller names the bucket count then."""
    files = df.inputFiles()
    if not files:
        raise ValueError("the frame reads no files: give the bucket count")
    by_folder: dict[str, set[str]] = {}
    for f in files:
        folder, _, name = f.rpartition("/")
        by_folder.setdefault(folder, set()).add(unquote(name))
    total = 0
    for folder, names in by_folder.items():
        sizes = folder_bytes(df.sparkSession, unquote(folder))
        total += sum(sizes[n] for n in names)
    return total


def files_for(df: DataFrame) -> int:
    """Files of a rewritten table: about one for each 256 MB that ``df`` reads."""
    return max(FILES, -(-scanned_bytes(df) // FILE_BYTES))


def export_snapshot(df: DataFrame, base_dir: str, instant: _dt.datetime, prefix: str = "customers_cleaned",
                    stamp_col: str = "exported_at_utc_minus_5", counts: dict | None = None) -> str:
    """Write a full snapshot to ``<base>/<prefix>_<yyyyMMdd_HHmmss>`` with the batch stamp column.

    Pass a dict as ``counts`` to receive the exported row count, measured in the write itself.

    The path token is computed on the driver from the same instant as the
    column (no Spark job), so a rerun with the same instant targets the same
    path, and a new instant never overwrites an earlier export.
    """
    local = (instant.replace(tzinfo=_dt.timezone.utc) if instant.tzinfo is None else instant)
    token = (local.astimezone(_dt.timezone(_dt.timedelta(hours=-5)))).strftime("%Y%m%d_%H%M%S")
    path = f"{base_dir.rstrip('/')}/{prefix}_{token}"
    utc = local.astimezone(_dt.timezone.utc).strftime("%Y-%m-%d %H:%M:%S")
    obs = Observation("export_rows")
    df.withColumn(stamp_col, export_stamp(utc)).observe(obs, F.count(F.lit(1)).alias("rows")) \
        .write.mode("overwrite").parquet(path)
    if counts is not None:
        counts["rows"] = obs.get["rows"]       # counted during the write, no second scan
    return path


def materialize(df: DataFrame, kind: str, name: str, path: str | None = None,
                bucket_by: str | None = None, buckets: int = BUCKETS) -> DataFrame:
    """``view``: temp view, nothing computed. ``table``: full rebuild written to ``path``
    (overwrite) and read back, which also cuts the lineage of downstream models.

    With ``bucket_by`` the table is written bucketed and sorted by that key as
    an external catalog table at ``path``: tables bucketed on the same key with
    the same bucket count join and group on it without a shuffle. ``buckets`` is
    set by the table's size (about one per GB), not by the shuffle partitions;
    more than the session allows is an error, not fewer and larger buckets.
    """
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df
    if kind != "table" or not path:
        raise ValueError("table materialisation needs a path")
    spark = df.sparkSession
    if bucket_by:
        n, most = buckets, int(spark.conf.get("spark.sql.sources.bucketing.maxBuckets"))
        if n > most:
            raise ValueError(f"{n} buckets, but spark.sql.sources.bucketing.maxBuckets is {most}")
        # one task a bucket writes one file a bucket
        (df.repartition(n, bucket_by).write.mode("overwrite").bucketBy(n, bucket_by).sortBy(bucket_by)
           .option("path", path).saveAsTable(name))
        return spark.table(name)
    df.write.mode("overwrite").parquet(path)
    out = spark.read.parquet(path)
    out.createOrReplaceTempView(name)
    return out


def clustered(df: DataFrame, cluster_by: list[str], partitions: int | None = None) -> DataFrame:
    """Rows range-partitioned on the cluster columns and sorted inside each partition.

    A row hash is the last range key: rows of one hot cluster value (say a
    country holding a third of the table) are split over several partitions
    instead of all landing in one task, and each file still covers a narrow
    range of the cluster columns.
    """
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return (df.repartitionByRange(n, *[F.col(c) for c in cluster_by], spread)
              .sortWithinPartitions(*cluster_by))


def clustered_write(df: DataFrame, path: str, cluster_by: list[str], partitions: int | None = None) -> str:
    """Write with data clustered by columns (see ``clustered``): Parquet min/max statistics then let
    filters on the cluster columns skip whole files and row groups. ``partitions`` defaults to the
    session's shuffle partitions (AQE may coalesce small ones)."""
    clustered(df, cluster_by, partitions).write.mode("overwrite").parquet(path)
    return path
