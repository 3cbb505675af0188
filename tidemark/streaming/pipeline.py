"""Bronze -> unified -> clean as three ``availableNow`` streaming queries.

Every stage has its own checkpoint, so each input file is processed exactly
once (a re-used file name is ignored, as with any file-source checkpoint) and
each stage can be restarted after a lost executor or driver.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import columns as C
from tidemark.operators import expectations as X
from tidemark.operators.dedup import first_per_key
from tidemark.operators.stores import Buckets, CommitLog
from tidemark.session import materialize_checkpoint, put_in_place
from tidemark.sources.writers import clustered
from tidemark.sources.json_rescue import CORRUPT, RESCUED, SchemaStore, rescue_parse, resolve_schema


# bytes of one micro-batch: a backlog of any size is worked off in batches of bounded size
MAX_BYTES = 16 << 30


def _run(q: StreamingQuery) -> StreamingQuery:
    q.awaitTermination()
    if q.exception():
        raise q.exception()
    return q


def _stream_parquet(spark: SparkSession, path: str) -> DataFrame:
    """Incremental read of a table written by an upstream stage (schema from its files)."""
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxBytesPerTrigger", MAX_BYTES).parquet(path)


# ---------------------------------------------------------------- bronze

def ingest_json(spark: SparkSession, source_dir: str, bronze_dir: str, checkpoint: str,
                schema: T.StructType | None = None, pattern: str = "*.json", max_files: int | None = None,
                schema_location: str | None = None, evolve: bool = False) -> StreamingQuery:
    """New JSON-lines files -> bronze table, rescue mode, nothing lost (malformed lines kept in
    ``_corrupt_record``), source file recorded per row.

    Without a ``schema`` the one stored at ``schema_location`` (default: beside the checkpoint) is used; the
    first run infers it from the files that lie there and stores it, so later runs resume with the same one. With
    ``evolve`` every run first merges the files that are new since the last one into the stored schema: new fields
    become columns, known fields keep their type (``SchemaStore``). A micro-batch is bounded by bytes, or by
    ``max_files`` if given.
    """
    if schema is None:
        location = schema_location or f"{checkpoint.rstrip('/')}_schema"
        schema = SchemaStore(spark, location).update(source_dir, pattern) if evolve else resolve_schema(spark, location, source_dir, pattern=pattern)
    bound = ("maxBytesPerTrigger", MAX_BYTES) if max_files is None else ("maxFilesPerTrigger", max_files)
    reader = spark.readStream.format("text").option("pathGlobFilter", pattern).option(*bound)
    raw = reader.load(source_dir).select("value", F.col("_metadata.file_path").alias("_source_file"))
    bronze = rescue_parse(raw, schema)
    return _run(bronze.writeStream.format("parquet").option("path", bronze_dir)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


# ---------------------------------------------------------------- unified

RENAMES = {"customer_name": ["customerName"]}
DRIFT_MARKERS = ["customerName", "experimental_flag", RESCUED]
NOISE = ["customerName", "experimental_flag"]


def unify(df: DataFrame, renames=RENAMES, markers=DRIFT_MARKERS, noise=NOISE,
          numeric: tuple[str, ...] = ("account_balance",)) -> DataFrame:
    """Resolve known drift, keep the evidence: fold renames, flag drift, drop noise, repair types."""
    for target, olds in renames.items():
        df = C.coalesce_renamed(df, target, *olds)
    df = C.drift_flag(df, markers)
    df = C.drop_present(df, *noise)
    for c in numeric:
        if c in df.columns:
            df = df.withColumn(c, C.to_double(c))
    return df


def unify_stream(spark: SparkSession, bronze_dir: str, unified_dir: str, checkpoint: str) -> StreamingQuery:
    """Bronze -> unified; unparseable lines stay in bronze (quarantine) and are not forwarded."""
    s = _stream_parquet(spark, bronze_dir).where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return _run(unify(s).writeStream.format("parquet").option("path", unified_dir)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


def quarantine(spark: SparkSession, bronze_dir: str) -> DataFrame:
    return spark.read.parquet(bronze_dir).where(F.col(CORRUPT).isNotNull()).select("_source_file", CORRUPT)


# ---------------------------------------------------------------- clean

@dataclass
class CleanConfig:
    key: str = "customer_id"
    rules: tuple = ()
    order_by: str | list | None = None  # deterministic pick inside a micro-batch
    cluster_by: tuple = ()
    state: str = "native"               # "native": Spark's stateful dropDuplicates (RocksDB state at scale);
    #                                      "ordered": first by order_by, seen keys kept in a KeyIndex


def _apply_rules_batch(batch: DataFrame, batch_id: int, out_dir: str, metrics_dir: str, cfg: CleanConfig):
    """One pass over the batch: the kept rows are written to a folder beside the table while the metrics of all
    rules are observed; it is put in place when no fail rule fired (a failed batch is retried whole). A
    retry replaces ``batch_id=<n>``."""
    rules, spark = list(cfg.rules), batch.sparkSession
    staged = f"{out_dir.rstrip('/')}_staged/batch_id={batch_id}"

    def write(kept):
        if cfg.cluster_by:
            kept = clustered(kept, list(cfg.cluster_by))
        kept.write.mode("overwrite").parquet(staged)
    metrics = X.observed_write(batch, rules, write).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    failures = {r["rule_name"]: r["violations"] for r in metrics.collect() if r["action"] == "fail" and r["violations"]}
    if failures:
        raise X.ExpectationFailed(failures)
    put_in_place(spark, staged, f"{out_dir}/batch_id={batch_id}")
    metrics.coalesce(1).write.mode("overwrite").parquet(f"{metrics_dir}/batch_id={batch_id}")


# hash buckets of a key index, and the files of one bucket from which on they are written together
KEY_BUCKETS = 64
KEY_FILES = 16


class KeyIndex:
    """The keys that earlier micro-batches have seen, in hash-bucketed files beside the stream's checkpoint.

    A batch reads the buckets of its own keys only, never the sink. Versions of the index are batch ids: a
    batch, also when it is retried, sees the version before its own, and adds its new keys as one file a
    bucket; a bucket of ``KEY_FILES`` files is written together in the same commit.
    """

    def __init__(self, spark: SparkSession, path: str, key: str, buckets: int = KEY_BUCKETS):
        self.spark, self.key = spark, key
        self.buckets, self.log = Buckets(spark, path, key, buckets), CommitLog(spark, path)

    def _before(self, batch_id: int) -> dict[str, list[str]]:
        earlier = [v for v in self.log.versions() if v < batch_id]
        return self.log.entry(earlier[-1])["parts"] if earlier else {}

    def unseen(self, batch: DataFrame, batch_id: int) -> DataFrame:
        """Rows of ``batch`` whose key no earlier batch had (null is a key)."""
        parts = self._before(batch_id)
        mine, _ = self.buckets.of(batch)
        paths = [p for b in mine for p in parts.get(str(b), [])]
        if not paths:
            return batch
        seen = self.spark.read.parquet(*paths).select(F.col(self.key).alias("__seen"))
        own = batch.select(F.col(self.key).alias("__own"))
        # the batch is bounded by the trigger: narrowed to its keys first, the index is read but not shuffled
        here = seen.join(own, F.col("__seen").eqNullSafe(F.col("__own")), "left_semi")
        return batch.join(here, F.col(self.key).eqNullSafe(F.col("__seen")), "left_anti")

    def add(self, keys: DataFrame, batch_id: int) -> None:
        if batch_id in self.log.versions():            # a retry of a batch that got this far
            return
        parts = self._before(batch_id)
        for b, path in self.buckets.write(keys.select(self.key)).items():
            parts[b] = [*parts.get(b, []), path]
        full = {b: p for b, p in parts.items() if len(p) >= KEY_FILES}
        if full:
            together = self.buckets.write(self.spark.read.parquet(*[p for ps in full.values() for p in ps]).select(self.key))
            parts |= {b: [path] for b, path in together.items()}
        self.log.publish(batch_id, parts=parts)


def _first_of_batch(batch: DataFrame, cfg: CleanConfig) -> DataFrame:
    return first_per_key(batch, cfg.key, cfg.order_by) if cfg.order_by else batch.dropDuplicates([cfg.key])


def clean_stream(spark: SparkSession, unified_dir: str, clean_dir: str, metrics_dir: str, checkpoint: str,
                 cfg: CleanConfig) -> StreamingQuery:
    """Unified -> clean: dedup by key (first row ever wins), then expectations, then clustered write."""
    src = _stream_parquet(spark, unified_dir)
    if cfg.state == "native":
        src = src.dropDuplicates([cfg.key])

        def sink(batch, batch_id):
            _apply_rules_batch(batch, batch_id, clean_dir, metrics_dir, cfg)
    else:
        index = KeyIndex(spark, f"{checkpoint.rstrip('/')}_keys", cfg.key)

        def sink(batch, batch_id):
            # rows that a rule drops have been seen all the same, so the keys are taken before the rules
            new = materialize_checkpoint(index.unseen(_first_of_batch(batch, cfg), batch_id))
            _apply_rules_batch(new, batch_id, clean_dir, metrics_dir, cfg)
            index.add(new, batch_id)
    return _run(src.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())


def read_sink(spark: SparkSession, path: str) -> DataFrame:
    """Batch view of a per-batch sink (drops the ``batch_id`` directory column)."""
    return spark.read.parquet(path).drop("batch_id")


# ---------------------------------------------------------------- T1 runner

@dataclass
class MedallionPaths:
    raw: str
    bronze: str
    unified: str
    clean: str
    metrics: str
    checkpoints: str


def run_medallion(spark: SparkSession, paths: MedallionPaths, schema: T.StructType, cfg: CleanConfig,
                  pattern: str = "*.json") -> None:
    """Run the three stages in dependency order; each processes only what is new since its last run."""
    ingest_json(spark, paths.raw, paths.bronze, f"{paths.checkpoints}/bronze", schema, pattern)
    unify_stream(spark, paths.bronze, paths.unified, f"{paths.checkpoints}/unified")
    clean_stream(spark, paths.unified, paths.clean, paths.metrics, f"{paths.checkpoints}/clean", cfg)


# ---------------------------------------------------------------- T2 standalone, T3 on any stream

def dedup_stream(spark: SparkSession, stream: DataFrame, out_dir: str, checkpoint: str, key: str,
                 order_by: str | list | None = None, state: str = "ordered",
                 event_time: str | None = None, delay: str = "1 day") -> StreamingQuery:
    """Streaming dedup, first-ever row per key wins across all batches.

    ``native`` uses the stateful ``dropDuplicates`` (unbounded key state, use the
    RocksDB provider at scale; the pick inside one batch is arbitrary);
    ``watermark`` bounds the state: duplicates are dropped while they arrive
    within ``delay`` of the event-time watermark on ``event_time``
    (``dropDuplicatesWithinWatermark``), older keys are forgotten;
    ``ordered`` picks the earliest row by ``order_by`` inside a batch and
    excludes keys that earlier batches had, by a ``KeyIndex`` beside the checkpoint.
    """
    cfg = CleanConfig(key=key, order_by=order_by, state=state)
    if state in ("native", "watermark"):
        if state == "watermark":
            if not event_time:
                raise ValueError("watermark dedup needs an event_time column")
            wm = event_time
            if isinstance(stream.schema[event_time].dataType, T.TimestampNTZType):
                # watermarks need a zoned timestamp; the delay is relative, so the session zone is fine
                wm = "__event_time"
                stream = stream.withColumn(wm, F.col(event_time).cast("timestamp"))
            deduped = stream.withWatermark(wm, delay).dropDuplicatesWithinWatermark([key])
            if wm != event_time:
                deduped = deduped.drop(wm)
        else:
            deduped = stream.dropDuplicates([key])
        q = (deduped.writeStream.format("parquet").option("path", out_dir)
             .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        return _run(q)

    index = KeyIndex(spark, f"{checkpoint.rstrip('/')}_keys", key)

    def sink(batch, batch_id):
        path = f"{out_dir}/batch_id={batch_id}"
        index.unseen(_first_of_batch(batch, cfg), batch_id).write.mode("overwrite").parquet(path)
        index.add(spark.read.schema(batch.schema).parquet(path), batch_id)
    return _run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())


def expectations_stream(stream: DataFrame, out_dir: str, metrics_dir: str, checkpoint: str,
                        rules: list) -> StreamingQuery:
    """Fail / drop / warn rules evaluated on every micro-batch of any stream."""
    cfg = CleanConfig(rules=tuple(rules))

    def sink(batch, batch_id):
        _apply_rules_batch(batch, batch_id, out_dir, metrics_dir, cfg)
    return _run(stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint)
                .trigger(availableNow=True).start())
