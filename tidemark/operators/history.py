"""Change management: keyed incremental merge (M1), SCD2 history (M2, M4), point-in-time lookup (M3).

Versioned writes: a merge never overwrites the directory it reads. Each commit
writes a complete new version directory and creates one entry of the version log
(once: of two writers one raises); readers take the newest entry. Works on any
Hadoop file system and survives a lost executor (a failed commit leaves no
entry). ``operators.stores`` holds the tables that rewrite only what changed.
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.operators.dedup import latest_per_key
from tidemark.operators.stores import CommitLog
from tidemark.session import materialize_checkpoint

SCD_COLUMNS = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


# ---------------------------------------------------------------- M1 incremental merge

def incremental_merge(target: DataFrame | None, source: DataFrame, key: str, ts: str,
                      tiebreak: str | None = None, mark: _dt.datetime | None = None) -> DataFrame:
    """Keyed upsert of the source rows newer than the target's high-water mark (``mark``, or else the
    target's maximum, for which the target is scanned).

    First run (no target) takes all source rows. Later runs take rows with
    ``ts > max(target.ts)`` (strict: equal or older stamps are skipped; an empty
    target, whose max is NULL, takes everything), keep the latest per key,
    replace matching keys and insert new ones. Both sides of the join are
    unique per key, so no key can skew it.
    """
    if target is None:
        return latest_per_key(source, key, ts, tiebreak=tiebreak)
    hwm = mark or target.agg(F.max(ts)).first()[0]
    # a literal mark reaches the source's scan as a pushed filter and prunes its files
    new = source if hwm is None else source.where(F.col(ts) > F.lit(hwm))
    # the increment is written once: its keys and its rows are both read
    new = materialize_checkpoint(latest_per_key(new, key, ts, tiebreak=tiebreak).select(*target.columns))
    # the increment alone decides the join: while it is small AQE broadcasts its keys and the target
    # is only scanned; NULL keys match nothing, so they stay in the target and are inserted from the new rows
    return target.join(new.select(key), key, "left_anti").unionByName(new)


class VersionedTable:
    """Directory of immutable versions plus a log ``_log`` with one entry a version (path, committed_at)."""

    LOG_SCHEMA = "version long, path string, committed_at timestamp_ntz, source_hwm timestamp_ntz"

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")
        self.entries = CommitLog(spark, base)

    def log(self) -> DataFrame | None:
        """The version log; None before the first commit. An unreadable log raises."""
        if not self.entries.versions():
            return None
        return self.spark.read.schema(self.LOG_SCHEMA).json(self.entries.path)

    def current_path(self) -> str | None:
        last = self.last_commit()
        return last["path"] if last else None

    def read(self) -> DataFrame | None:
        p = self.current_path()
        return self.spark.read.parquet(p) if p else None

    def stage(self, df: DataFrame) -> tuple[int, str]:
        """Write the next version's files to a path of their own; invisible to readers until ``publish``.
        Two writers that stage at the same time never touch each other's files."""
        last = self.last_commit()
        version = last["version"] + 1 if last else 0
        path = f"{self.base}/v={version:06d}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return version, path

    def publish(self, version: int, path: str, committed_at: _dt.datetime | None = None,
                source_hwm: _dt.datetime | None = None) -> str:
        """Make a staged version current by creating its log entry (wall-clock commit time and, optionally,
        the newest source stamp the version was built from). Raises when another writer was first."""
        stamp = {"committed_at": committed_at} if committed_at else {}
        self.entries.publish(version, path=path, source_hwm=source_hwm, **stamp)
        return path

    def commit(self, df: DataFrame, committed_at: _dt.datetime | None = None,
               source_hwm: _dt.datetime | None = None) -> str:
        return self.publish(*self.stage(df), committed_at=committed_at, source_hwm=source_hwm)

    def last_commit(self) -> dict | None:
        """Newest log entry (version, path, committed_at, source_hwm), or None."""
        return self.entries.last()


def merge_into(spark: SparkSession, base: str, source: DataFrame, key: str, ts: str,
               tiebreak: str | None = None) -> str:
    """Run one incremental merge against a versioned table and commit the result. The mark comes from the last
    log entry; the new one is measured while the version is written."""
    table = VersionedTable(spark, base)
    last = table.last_commit()
    merged = incremental_merge(table.read(), source, key, ts, tiebreak, mark=last["source_hwm"] if last else None)
    obs = Observation()
    staged = table.stage(merged.observe(obs, F.max(F.col(ts).cast("timestamp_ntz")).alias("hwm")))
    return table.publish(*staged, source_hwm=obs.get["hwm"])


# ---------------------------------------------------------------- M2/M4 SCD2

def scd_id(key: str, ts: str) -> Column:
    """Version id: md5 of ``key|updated_at``."""
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), F.col(ts).cast("string")))


# rows of one key that one task sorts, and the share of the rows that the chunk bounds are taken from
CHUNK_ROWS = 2_000_000
CHUNK_SAMPLE = 1 / 64


def chunk_bounds(df: DataFrame, key: str, ts: str, chunk_rows: int = CHUNK_ROWS, sample: float = CHUNK_SAMPLE) -> DataFrame | None:
    """Stamps that cut the rows of hot keys into ranges of about ``chunk_rows``: ``__key, __bounds``; None without hot keys.

    A key is hot when it has more than ``chunk_rows`` rows, estimated from a sample (it decides where the work
    is cut, never a result). Its bounds are quantiles of its own stamps, so they follow the data whatever the
    stamps' spacing; rows of equal key and stamp stay together. There are at most rows / ``chunk_rows`` hot keys;
    the bounds are written once, so every reader sees the same.
    """
    rows = df.select(F.col(key).alias("__key"), F.col(ts).alias("__ts")).where(F.col("__ts").isNotNull())
    rows = rows if sample >= 1 else rows.sample(fraction=sample, seed=0)
    least = chunk_rows * min(sample, 1.0)
    hot = materialize_checkpoint(rows.groupBy("__key").agg(F.count(F.lit(1)).alias("__n")).where(F.col("__n") > least))
    most = hot.agg(F.max("__n")).first()[0]
    if most is None:
        return None
    chunks = max(2, -(-most // max(1, int(least))))
    cuts = F.percentile_approx("__ts", [i / chunks for i in range(1, chunks)], max(10_000, 20 * chunks))
    hot = hot.select(F.col("__key").alias("__hot"))
    return materialize_checkpoint(rows.join(hot, F.col("__key").eqNullSafe(F.col("__hot")), "left_semi")
                                  .groupBy("__key").agg(F.array_distinct(cuts).alias("__bounds")))


def with_chunk(df: DataFrame, key: str, ts: str, bounds: DataFrame | None) -> DataFrame:
    """``df`` with ``__b``, the number of its key's bounds up to the row's stamp (0 for keys that aren't hot)."""
    if bounds is None:
        return df.withColumn("__b", F.lit(0))
    j = df.join(bounds, F.col(key).eqNullSafe(F.col("__key")), "left")
    below = F.size(F.filter("__bounds", lambda b: b <= F.col(ts)))
    return j.withColumn("__b", F.when(F.col("__bounds").isNull(), 0).otherwise(below)).drop("__key", "__bounds")


def _next_in_key(df: DataFrame, key: str, ts: str, bounds: DataFrame | None):
    """Next stamp per key (stamps distinct per key), found inside (key, chunk) windows plus one per-key window over
    the first stamp of each chunk; without hot keys one window does."""
    if bounds is None:
        return df.withColumn("__next", F.lead(ts).over(Window.partitionBy(key).orderBy(ts)))
    b = with_chunk(df, key, ts, bounds)
    w = Window.partitionBy(key, "__b").orderBy(ts)
    b = b.withColumn("__next", F.lead(ts).over(w))
    firsts = b.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__c")).agg(F.min(ts).alias("__first"))
    firsts = (firsts.withColumn("__next_chunk", F.lead("__first").over(Window.partitionBy("__k").orderBy("__c"))).drop("__first"))
    return (b.join(firsts, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__c")), "left")
            .withColumn("__next", F.coalesce("__next", "__next_chunk")).drop("__next_chunk", "__b", "__k", "__c"))


def _prev_values(df: DataFrame, key: str, ts: str, bounds: DataFrame | None, cols: list[str]):
    """Values of ``cols`` in the previous row of the same key (by ``ts``), in chunks like ``_next_in_key``."""
    b = with_chunk(df, key, ts, bounds)
    w = Window.partitionBy(key, "__b").orderBy(ts)
    for c in cols:
        b = b.withColumn(f"__prev_{c}", F.lag(c).over(w))
    b = b.withColumn("__is_first", F.row_number().over(w) == 1)
    if bounds is None:
        return b.withColumn("__has_prev", ~F.col("__is_first")).drop("__is_first", "__b")
    lasts = (b.groupBy(F.col(key).alias("__k"), F.col("__b").alias("__c"))
             .agg(F.max_by(F.struct(*[F.col(c).alias(c) for c in cols]), F.col(ts)).alias("__last")))
    wk = Window.partitionBy("__k").orderBy("__c")
    lasts = lasts.withColumn("__carry", F.lag("__last").over(wk)).drop("__last")
    b = b.join(lasts, F.col(key).eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__c")), "left")
    for c in cols:
        b = b.withColumn(f"__prev_{c}", F.when(F.col("__is_first"), F.col("__carry")[c]).otherwise(F.col(f"__prev_{c}")))
    has_prev = ~F.col("__is_first") | F.col("__carry").isNotNull()
    return b.withColumn("__has_prev", has_prev).drop("__carry", "__is_first", "__b", "__k", "__c")


def scd2_from_log(log: DataFrame, key: str, ts: str, columns: list[str],
                  tiebreak: str | None = None, check_cols: list[str] | None = None,
                  chunk_rows: int = CHUNK_ROWS, sample: float = CHUNK_SAMPLE) -> DataFrame:
    """Whole SCD2 history from an append-only log.

    Timestamp strategy (default): one version per distinct (key, stamp) -- on
    equal stamps the highest ``tiebreak`` wins -- valid from its stamp to the
    next stamp of the key. With ``check_cols`` a row opens a version only when
    one of those columns differs from the previous row of the key (the first
    row always does). Rows without a stamp cannot be placed in time and are
    left out.

    Skew: rows with equal (key, stamp) are first reduced to one by a partial
    aggregate (map-side, before any shuffle), so even a hot group of identical
    stamps costs one row per map task. A key with more than ``chunk_rows`` rows
    is cut into ranges of its own stamps (``chunk_bounds``); the next stamp (and
    the previous values) are found inside (key, chunk) windows, and only one row
    per (key, chunk) is carried across chunks through a per-key window.
    """
    bounds = chunk_bounds(log, key, ts, chunk_rows, sample)
    base = log.where(F.col(ts).isNotNull()).select(key, ts, *columns, *([tiebreak] if tiebreak else []))
    if tiebreak:
        base = latest_per_key(base, [key, ts], tiebreak)
    else:
        base = base.dropDuplicates([key, ts])
    v = base
    if check_cols:
        v = _prev_values(v, key, ts, bounds, check_cols)
        changed = ~F.col("__has_prev")
        for c in check_cols:
            changed = changed | ~F.col(c).eqNullSafe(F.col(f"__prev_{c}"))
        v = v.where(changed).drop("__has_prev", *[f"__prev_{c}" for c in check_cols])
    v = _next_in_key(v, key, ts, bounds)
    return v.select(
        key, *columns, ts,
        scd_id(key, ts).alias("dbt_scd_id"),
        F.col(ts).alias("dbt_updated_at"),
        F.col(ts).alias("dbt_valid_from"),
        F.col("__next").alias("dbt_valid_to"),
    )


def opened_versions(snap: DataFrame, key: str, ts: str, columns: list[str]) -> DataFrame:
    """An open version for every row."""
    return snap.select(key, *columns, ts, scd_id(key, ts).alias("dbt_scd_id"), F.col(ts).alias("dbt_updated_at"),
                       F.col(ts).alias("dbt_valid_from"), F.lit(None).cast(snap.schema[ts].dataType).alias("dbt_valid_to"))


def scd2_step(history: DataFrame | None, snapshot: DataFrame, key: str, ts: str, columns: list[str],
              check_cols: list[str] | None = None, tiebreak: str | None = None) -> DataFrame:
    """One snapshot run against existing history (what a scheduled snapshot job does).

    ``snapshot`` holds the rows of this run (reduced to the latest per key). Timestamp
    strategy: a newer stamp closes the open version (``valid_to`` = new stamp)
    and opens a new one; with ``check_cols`` a new version also needs a changed
    value in one of those columns. Keys absent from the snapshot stay open.
    Only open versions (one per key) meet the snapshot in the join.
    """
    # one row per key: the latest stamp wins if the snapshot holds several (partial aggregate)
    snap = latest_per_key(snapshot.select(key, *columns, ts, *([tiebreak] if tiebreak else [])), key, ts, tiebreak=tiebreak)
    fresh = opened_versions(snap, key, ts, columns)
    if history is None:
        return fresh
    closed = history.where(F.col("dbt_valid_to").isNotNull())
    open_ = history.where(F.col("dbt_valid_to").isNull())
    # keys are compared null-safe, so a NULL key has one open version like any other
    n = snap.select(F.col(key).alias("__new_key"), F.col(ts).alias("__new_ts"),
                    *[F.col(c).alias(f"__new_{c}") for c in (check_cols or [])])
    j = open_.join(n, F.col(key).eqNullSafe(F.col("__new_key")), "left")
    newer = F.col("__new_ts").isNotNull() & (F.col("__new_ts") > F.col("dbt_updated_at"))
    if check_cols:
        changed = F.lit(False)
        for c in check_cols:
            changed = changed | ~F.col(c).eqNullSafe(F.col(f"__new_{c}"))
        newer = newer & changed
    j = j.withColumn("__close", newer)
    still = j.withColumn("dbt_valid_to", F.when(F.col("__close"), F.col("__new_ts"))
                         .otherwise(F.col("dbt_valid_to"))).select(*history.columns, "__close")
    closing, known = (d.select(F.col(key).alias("__key")) for d in (j.where("__close"), open_))
    opened = fresh.join(closing, F.col(key).eqNullSafe(F.col("__key")), "left_semi")
    unseen = fresh.join(known, F.col(key).eqNullSafe(F.col("__key")), "left_anti")
    return (closed.unionByName(still.drop("__close")).unionByName(opened.select(*history.columns))
            .unionByName(unseen.select(*history.columns)))


# ---------------------------------------------------------------- M3 point in time

def as_of(history: DataFrame, instant) -> DataFrame:
    """Versions valid at ``instant``: ``valid_from <= t < valid_to`` (open versions have NULL valid_to)."""
    t = F.lit(instant).cast(history.schema["dbt_valid_from"].dataType)
    return history.where((F.col("dbt_valid_from") <= t) &
                         (F.col("dbt_valid_to").isNull() | (t < F.col("dbt_valid_to"))))


def as_of_join(events: DataFrame, history: DataFrame, key: str, event_ts: str, columns: list[str],
               history_key: str | None = None, chunk_rows: int = CHUNK_ROWS, sample: float = CHUNK_SAMPLE) -> DataFrame:
    """Every event with the ``columns`` of its key's version valid at the event's stamp (null without one).

    Point-in-time join of many instants: events and versions are put in one time line a key, and the last
    version at or before each event is carried along it, so there is no inequality join and no row for a
    pair that does not match. Hot keys' time lines are cut into chunks (``chunk_bounds`` over both inputs) and one
    version a chunk is carried on. A version ends at its ``dbt_valid_to``, which is exclusive. Keys are
    compared null-safe; events without a stamp have no version; repeated events stay.
    """
    hk = history_key or key
    event = F.struct(*[F.col(c) for c in events.columns])
    version = F.struct(*[F.col(c) for c in columns], F.col("dbt_valid_to").alias("__end"))
    line = (events.select(F.col(key).alias("__id"), F.col(event_ts).alias("__at"), F.lit(1).alias("__kind"), event.alias("__event"))
            .unionByName(history.select(F.col(hk).alias("__id"), F.col("dbt_valid_from").alias("__at"), F.lit(0).alias("__kind"),
                                        version.alias("__version")), allowMissingColumns=True))
    bounds = chunk_bounds(line, "__id", "__at", chunk_rows, sample)
    line = with_chunk(line, "__id", "__at", bounds)
    so_far = Window.partitionBy("__id", "__b").orderBy(F.col("__at").asc_nulls_first(), "__kind").rowsBetween(Window.unboundedPreceding, 0)
    found = line.withColumn("__last", F.last("__version", ignorenulls=True).over(so_far))
    if bounds is not None:
        ends = (line.where("__kind = 0").groupBy(F.col("__id").alias("__k"), F.col("__b").alias("__c"))
                .agg(F.max_by("__version", "__at").alias("__end_version")))
        # chunks without a version pass on what came before
        every = line.select(F.col("__id").alias("__k"), F.col("__b").alias("__c")).distinct()
        every = every.alias("e").join(ends.alias("n"), F.col("e.__k").eqNullSafe(F.col("n.__k")) & (F.col("e.__c") == F.col("n.__c")), "left") \
            .select(F.col("e.__k").alias("__k"), F.col("e.__c").alias("__c"), "__end_version")
        before = Window.partitionBy("__k").orderBy("__c").rowsBetween(Window.unboundedPreceding, -1)
        carry = every.select("__k", "__c", F.last("__end_version", ignorenulls=True).over(before).alias("__carry"))
        found = (found.join(carry, F.col("__id").eqNullSafe(F.col("__k")) & (F.col("__b") == F.col("__c")), "left")
                 .withColumn("__last", F.coalesce("__last", "__carry")))
    valid = F.col("__last.__end").isNull() | (F.col("__at") < F.col("__last.__end"))
    return found.where("__kind = 1").select("__event.*", *[F.when(valid, F.col(f"__last.{c}")).alias(c) for c in columns])
