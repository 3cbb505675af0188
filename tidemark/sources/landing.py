"""Loading exports into an append-only landing table by column name."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def read_exports(spark: SparkSession, stage_dir: str, schema: T.StructType, pattern: str = "*.parquet") -> DataFrame:
    """Batch read of every export below ``stage_dir`` by column name.

    Columns are matched by name case-insensitively (Spark's default analyzer
    setting), columns absent from a file come back NULL, extra columns are
    ignored, and only files matching ``pattern`` are read, so control files
    (``_SUCCESS``, ``_started_*``, ``_committed_*``, checksums, text parts) never
    reach the Parquet reader.
    """
    return (spark.read.schema(schema).option("recursiveFileLookup", "true")
            .option("pathGlobFilter", pattern).parquet(stage_dir))


def load_new_exports(spark: SparkSession, stage_dir: str, landing_dir: str, checkpoint: str,
                     schema: T.StructType, pattern: str = "*.parquet") -> StreamingQuery:
    """Append every export file not loaded before into the landing table (auto-ingest).

    A file-source stream remembers loaded files in its checkpoint, so each file
    is appended once; the landing table is never truncated.
    """
    stream = (spark.readStream.schema(schema).option("recursiveFileLookup", "true")
              .option("pathGlobFilter", pattern).parquet(stage_dir))
    q = (stream.writeStream.format("parquet").option("path", landing_dir)
         .option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start())
    q.awaitTermination()
    return q
