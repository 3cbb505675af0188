"""Operations re-aimed as table jobs: profile (A11), retention list (O1), load-failure alerts (O2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DRIVER_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, row_count, column_count`` for each table, in one job (union of count aggregates).

    Column counts come from the schemas (no job); row counts from Parquet
    footers where Spark can answer ``count(*)`` from metadata.
    """
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count",
                     F.lit(len(df.columns)).cast("bigint").alias("column_count"))
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def table_storage(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table_name, file_count, total_bytes, largest_file_bytes`` of Parquet tables by path (a folder or one file).

    Spark's file reader lists paths and sizes in parallel; no content is read. A table without a file has zeros.
    """
    out = None
    for name, path in paths.items():
        files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
                 .agg(F.count(F.lit(1)).alias("file_count"), F.coalesce(F.sum("length"), F.lit(0)).alias("total_bytes"),
                      F.coalesce(F.max("length"), F.lit(0)).alias("largest_file_bytes")))
        part = files.select(F.lit(name).alias("table_name"), "*")
        out = part if out is None else out.unionByName(part)
    return out


def column_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """``table_name, position, column_name, column_type, row_count, null_count`` of every column.

    One aggregate a table counts rows and nulls of all its columns in one scan; its one row is then turned into
    a row a column.
    """
    out = None
    for name, df in tables.items():
        fields = df.schema.fields
        counts = df.agg(F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{f.name}`")).alias(f"c{i}") for i, f in enumerate(fields)])
        rows = F.array(*[F.struct(F.lit(i + 1).alias("position"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("column_type"),
                                  F.col("n").alias("row_count"), (F.col("n") - F.col(f"c{i}")).alias("null_count")) for i, f in enumerate(fields)])
        part = counts.select(F.lit(name).alias("table_name"), F.inline(rows))
        out = part if out is None else out.unionByName(part)
    return out


def unreferenced_files(spark: SparkSession, base: str, retained: list[dict]) -> DataFrame:
    """Data files below a store's folder with whether a retained version names them: ``path, folder, bytes, live``.

    ``retained`` are the log entries to keep. The folder is listed by Spark's file reader (paths and sizes, no
    content); what the entries name meets the listing by folder. Files of writers that died before their commit and
    of versions no longer retained come out not live. Nothing is deleted.
    """
    named = set()
    for entry in retained:
        for value in entry.values():
            parts = value.values() if isinstance(value, dict) else value if isinstance(value, list) else [value]
            named |= {_plain(p) for p in parts if isinstance(p, str) and "/" in p}
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(base)
             .select("path", F.col("length").alias("bytes")))
    folder = F.regexp_replace(F.regexp_replace(F.regexp_replace("path", "^file:/+", "/"), "/[^/]*$", ""), "%3D", "=")
    files = files.withColumn("folder", folder)
    live = spark.createDataFrame([(p,) for p in sorted(named)], "folder string").withColumn("__live", F.lit(True))
    return files.join(live, "folder", "left").select("path", "folder", "bytes", F.coalesce("__live", F.lit(False)).alias("live"))


def _plain(path: str) -> str:
    return "/" + path[len("file:"):].lstrip("/") if path.startswith("file:") else path.rstrip("/")


def expired_versions(log: DataFrame, retention_hours: int = 168, now=None) -> DataFrame:
    """Version log ``table_name, version, committed_at`` with an ``expired`` verdict.

    A version is expired when it is older than the retention relative to
    ``now`` (default: the newest commit in the log), except the newest version
    of each table, which is always kept. The newest commit per table is a
    partial aggregate joined back (one row per table), not a window, so a
    table holding most versions is not funnelled into one task.
    """
    latest = log.groupBy("table_name").agg(F.max(F.struct("committed_at", "version")).alias("__m"))
    latest = latest.select("table_name", F.col("__m.version").alias("__newest"))
    ref = F.lit(now).cast("timestamp_ntz") if now is not None else log.select(F.max("committed_at")).scalar()
    j = log.join(latest, "table_name", "left")
    # wall-clock difference of two timestamp_ntz values: no session time zone, no DST shift
    age = F.timestamp_diff("MICROSECOND", F.col("committed_at"), ref) / 3.6e9
    return j.select("table_name", "version", "committed_at",
                    ((age > retention_hours) & (F.col("version") != F.col("__newest"))).alias("expired"))


def load_failures(history: DataFrame, minutes: int = 15, failed_status: str = "LOAD_FAILED") -> DataFrame:
    """Failed loads per file in tumbling alert windows: ``window_start, window_end, file_name, failures``."""
    w = F.window("last_load_time", f"{minutes} minutes")
    return (history.where(F.col("status") == failed_status)
            .groupBy(w.alias("w"), "file_name").agg(F.count(F.lit(1)).alias("failures"))
            .select(F.col("w.start").cast("timestamp_ntz").alias("window_start"),
                    F.col("w.end").cast("timestamp_ntz").alias("window_end"), "file_name", "failures"))
