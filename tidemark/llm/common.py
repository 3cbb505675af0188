"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid
import warnings
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.functions import ArrowUDFType, arrow_udf

from tidemark.session import ensure_checkpoint_dir

# ASCII white space: the word separators of every operator that says ``[^\x20\x09-\x0D]+``
WHITESPACE = " \t\n\x0b\x0c\r"
# rows and bytes of one Arrow batch handed to Python: bounds a worker's memory whatever the texts' lengths
BATCH_ROWS = 2000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of this session by rows and bytes (long texts must not pile up)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path in the folder that ``spark.checkpoint.dir`` names."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage, survives lost executors,
    and fixes values such as row ids that a recomputation could number differently."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, also where ``body`` uses it several times."""
    return F.transform(F.array(value), body)[0]


def per_batch(fn: Callable[[], Callable[[pa.Array], pa.Array]], return_type: str):
    """An Arrow UDF over one column. ``fn`` runs once in each task and returns the batch function."""

    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        step = fn()
        for batch in batches:
            yield step(batch)

    with warnings.catch_warnings():
        warnings.simplefilter("ignore")                # names the kind of function; closures carry no type hints
        return arrow_udf(run, return_type, ArrowUDFType.SCALAR_ITER)


def text_bytes(text: Column | str) -> Column:
    """UTF-8 bytes of a text column, empty for null."""
    col = F.col(text) if isinstance(text, str) else text
    return F.coalesce(col.cast("binary"), F.lit(b"").cast("binary"))


def as_signed(values: np.ndarray) -> np.ndarray:
    return values.astype(np.uint64, copy=False).view(np.int64)


def rank_within(df: DataFrame, keys: list[str], row_id: str, rank: str, buckets: int) -> DataFrame:
    """Number the rows of each key from 0 without gaps, whatever a key's size.

    Rows are numbered inside ``(key, hash bucket of row_id)`` and shifted by the counts of the buckets
    before, so a key that holds a third of all rows is numbered by ``buckets`` tasks. ``df`` must be a
    stored table with a unique ``row_id`` (it is read twice).
    """
    from pyspark.sql import Window

    b = F.pmod(F.xxhash64(row_id), F.lit(buckets)).cast("int")
    tagged = df.withColumn("__bucket", b)
    w = Window.partitionBy(*keys).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = (tagged.groupBy(*keys, "__bucket").agg(F.count(F.lit(1)).alias("__n"))
              .withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n"))
    inside = Window.partitionBy(*keys, "__bucket").orderBy(row_id)
    numbered = tagged.withColumn("__in", F.row_number().over(inside) - 1)
    return (numbered.join(before, [*keys, "__bucket"])
            .withColumn(rank, (F.col("__before") + F.col("__in")).cast("long"))
            .drop("__bucket", "__in", "__before"))


def ordered_rank(df: DataFrame, order: list[Column], rank: str) -> DataFrame:
    """Number all rows from 0 without gaps in a given order, with no task that sees them all.

    Rows are sorted by range and stored with their partition and place; the partitions' sizes, one row a
    partition, give each partition its first number. Rows that tie on the whole order are numbered in any order.
    """
    from pyspark.sql import Window

    place = F.monotonically_increasing_id()            # partition in the upper bits, place in it below
    ranged = df.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged = stored(ranged.select("*", F.shiftright(place, 33).alias("__part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("__place")),
                    "ordered-rank")
    w = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    first = (ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
             .withColumn("__first", F.coalesce(F.sum("__n").over(w), F.lit(0))).drop("__n"))
    # one row a shuffle partition: its bound is the session's partition count, not the data
    return ranged.join(F.broadcast(first), "__part").withColumn(rank, F.col("__first") + F.col("__place")).drop("__part", "__place", "__first")


def buckets_for(rows: int, per_bucket: int = 1_000_000, least: int = 64) -> int:
    """Hash buckets so that one key's bucket holds about ``per_bucket`` rows at most."""
    return max(least, -(-rows // per_bucket))
