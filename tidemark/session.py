"""Session defaults and shared working folders."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Defaults every job in this package assumes: UTC session clock (driver
# timestamps are NTZ), adaptive execution for runtime re-planning (partition
# coalescing, skew-join splitting, broadcast switch on measured sizes).
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a hot join key even when the split costs one more exchange downstream (e.g. a per-key
    # window right after the join): one key may hold a third of the rows
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # unbounded keyed state (streaming dedup) lives in RocksDB, not on the JVM heap
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # delete reliable-checkpoint files once the checkpointed data is no longer referenced
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_spark(app: str = "tidemark", master: str | None = None,
              shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Build (or reuse) a session with the package defaults.

    ``master`` is only set when given, so cluster submissions keep the
    master chosen by ``spark-submit``.
    """
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
    for k, v in DEFAULT_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    Reads ``spark.checkpoint.dir`` from the session (a core setting: it cannot
    be changed at runtime). When the session names none but a checkpoint folder
    was registered on the context, that one is used. Only on a local master
    (tests) a private folder is created and registered when neither exists; on a
    cluster that is an error, because executors would not see it.
    """
    sc = spark.sparkContext
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(base)
        return base
    current = sc.getCheckpointDir()
    if current:
        return current
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    sc.setCheckpointDir(tempfile.mkdtemp(prefix="tidemark-ckpt-"))
    return sc.getCheckpointDir()


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path below the shared checkpoint folder.

    Used for streaming checkpoints, schema stores, export versions and any
    table a job writes to cut lineage. Never a machine-local folder unless the
    session itself points there.
    """
    base = ensure_checkpoint_dir(spark).rstrip("/")
    if base.startswith("file:"):
        base = base[len("file:"):]
    return f"{base}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a ``file:`` scheme for the few places Python itself lists files (tests only)."""
    return path[len("file:"):] if path.startswith("file:") else path


def materialize_checkpoint(df):
    """Cut lineage by writing ``df`` to the shared checkpoint folder (reliable, survives a lost
    executor; never ``localCheckpoint``). The frame that comes back has no partitioning the planner
    knows of, so later joins and groupings on a key shuffle it again; write a bucketed table
    (``writers.materialize``) where that matters."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def cluster_conf(input_bytes: int, executor_cores: int, executors: int,
                 target_partition_bytes: int = 256 * 1024 ** 2) -> dict[str, str]:
    """Settings to submit a job with, sized from the bytes it reads.

    Shuffle partitions start at about one per ``target_partition_bytes`` of input
    (at least twice the task slots) and AQE coalesces what turns out small or
    splits what turns out skewed; scan splits are capped at the same size so a
    task's input fits comfortably in its share of executor memory.
    """
    slots = executor_cores * executors
    parts = max(2 * slots, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.shuffle.partitions": str(parts),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes // 2),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes * 2),
    }


def _hadoop(spark: SparkSession, path: str):
    """(file system, path) of ``path`` on the session's Hadoop file systems."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the entries of a folder; none if it does not exist."""
    fs, p = _hadoop(spark, path)
    return [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []


def folder_bytes(spark: SparkSession, path: str) -> dict[str, int]:
    """Bytes of every file directly in a folder, by the file's name."""
    fs, p = _hadoop(spark, path)
    return {f.getPath().getName(): f.getLen() for f in fs.listStatus(p) if f.isFile()}


def read_small(spark: SparkSession, path: str) -> str:
    """Content of a small text file (log entries), without a job."""
    fs, p = _hadoop(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file with this content unless it exists already; False if it does.

    Of several writers that try at the same time one succeeds: the file system decides (``create`` without
    overwrite is one step on HDFS and on object stores with conditional writes). A local file system checks and
    creates in two steps, so there the empty file is made first, in the operating system's one step.
    """
    from py4j.protocol import Py4JJavaError
    fs, p = _hadoop(spark, path)
    fs.mkdirs(p.getParent())
    local = fs.getScheme() == "file"
    if local and not spark.sparkContext._jvm.java.io.File(p.toUri().getPath()).createNewFile():
        return False
    try:
        out = fs.create(p, local)
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    return True


def put_in_place(spark: SparkSession, staged: str, path: str) -> None:
    """Make a staged folder visible under its final name, in place of an earlier try."""
    fs, src = _hadoop(spark, staged)
    _, dst = _hadoop(spark, path)
    if fs.exists(dst):
        fs.delete(dst, True)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise OSError(f"{staged} could not be renamed to {path}")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` exists on the session's Hadoop file system. A file system that cannot be asked
    raises: taking it for an absent path would start tables and streams anew over existing data."""
    fs, p = _hadoop(spark, path)
    return bool(fs.exists(p))
