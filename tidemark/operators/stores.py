"""Tables that keep their state between runs: commit log, keyed buckets, history in two parts.

A table is a folder of immutable data files and a log ``_log/<version>.json``. A commit writes new data files
under a name of its own and then creates the next log entry, which names every live file group of the
version. The entry is created once: of two writers that started from the same version one commits and the
other raises, and a writer that dies before the entry leaves only files that no version names
(``ops.unreferenced_files`` lists them).
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.dedup import latest_per_key
from tidemark.session import create_once, list_names, materialize_checkpoint, read_small

BUCKET = "__bucket"
APART = "-1"
# buckets of a keyed store when the caller doesn't say
STORE_BUCKETS = 16


class CommitConflict(RuntimeError):
    """Another writer has committed the version first."""


def now_utc() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


class CommitLog:
    """Numbered entries of one table; each is a JSON object on one line."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.path = spark, f"{base.rstrip('/')}/_log"

    def _file(self, version: int) -> str:
        return f"{self.path}/{version:012d}.json"

    def versions(self) -> list[int]:
        return sorted(int(n[:-5]) for n in list_names(self.spark, self.path) if n.endswith(".json") and not n.startswith("."))

    def entry(self, version: int) -> dict:
        """One entry. An entry that is being written just now, or whose writer died in that moment, raises."""
        text = read_small(self.spark, self._file(version))
        if not text.endswith("\n"):
            raise CommitConflict(f"{self._file(version)} is being written; if its writer is gone, remove it")
        return _decode(json.loads(text))

    def last(self) -> dict | None:
        versions = self.versions()
        return self.entry(versions[-1]) if versions else None

    def publish(self, version: int, **fields) -> dict:
        """Create entry ``version``; raises when it, or a later one, exists."""
        versions = self.versions()
        entry = {"version": version, "committed_at": now_utc(), **fields}
        if versions and versions[-1] >= version or not create_once(self.spark, self._file(version), json.dumps(_encode(entry)) + "\n"):
            raise CommitConflict(f"version {version} is published already: another writer committed first")
        return entry


def _encode(entry: dict) -> dict:
    return {k: v.isoformat() if isinstance(v, _dt.datetime) else v for k, v in entry.items()}


def _decode(entry: dict) -> dict:
    stamps = ("committed_at", "source_hwm")
    return {k: _dt.datetime.fromisoformat(v) if k in stamps and v is not None else v for k, v in entry.items()}


class Buckets:
    """Rows in hash buckets of one column, each bucket a folder of files: ``{bucket: folder}``."""

    def __init__(self, spark: SparkSession, base: str, key: str, count: int):
        self.spark, self.base, self.key, self.count = spark, base.rstrip("/"), key, count

    def column(self) -> Column:
        return F.pmod(F.xxhash64(F.col(self.key)), F.lit(self.count)).cast("int")

    def of(self, df: DataFrame, ts: str | None = None) -> tuple[list[int], _dt.datetime | None]:
        """The buckets that ``df`` has rows in (at most ``count`` numbers), and its newest stamp."""
        newest = F.max(F.col(ts).cast("timestamp_ntz")) if ts else F.lit(None)
        rows = df.groupBy(self.column().alias(BUCKET)).agg(newest.alias("newest")).collect()
        return sorted(r[0] for r in rows), max((r[1] for r in rows if r[1] is not None), default=None)

    def write(self, df: DataFrame, apart: Column | None = None) -> dict[str, str]:
        """Write the rows to a new folder, one file a bucket; returns the folders of the buckets that have rows.
        Rows for which ``apart`` holds go to a folder of their own, under ``APART``."""
        path = f"{self.base}/data-{uuid.uuid4().hex[:12]}"
        folder = self.column() if apart is None else F.when(apart, F.lit(int(APART))).otherwise(self.column())
        df.withColumn(BUCKET, folder).repartition(self.column()).write.partitionBy(BUCKET).parquet(path)
        return {n.split("=")[1]: f"{path}/{n}" for n in list_names(self.spark, path) if n.startswith(f"{BUCKET}=")}

    def read(self, parts: dict[str, str], schema: T.StructType, buckets: list[int] | None = None) -> DataFrame:
        paths = [p for b, p in sorted(parts.items()) if buckets is None or int(b) in set(buckets)]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def replaced(self, parts: dict[str, str], touched: list[int], rows: DataFrame) -> dict[str, str]:
        """``parts`` with the touched buckets written anew; the other buckets keep their files."""
        kept = {b: p for b, p in parts.items() if int(b) not in set(touched)}
        return {**kept, **self.write(rows)}


def _schema(entry: dict, name: str = "schema") -> T.StructType:
    return T.StructType.fromJson(json.loads(entry[name]))


class KeyedStore:
    """Incremental table: one row a key, the newest stamp wins (M1).

    ``merge`` takes the rows newer than the mark that the last commit recorded (the target is not asked for its
    maximum), reads and rewrites only the buckets that hold their keys, and commits a manifest in which all
    other buckets keep their files. Rows with a null key are inserted and never replaced. With buckets of
    about a gigabyte (``buckets``), a commit costs what the increment's buckets hold, whatever the table holds.
    """

    def __init__(self, spark: SparkSession, base: str, key: str, ts: str, buckets: int = STORE_BUCKETS):
        self.spark, self.base, self.key, self.ts, self.buckets = spark, base.rstrip("/"), key, ts, buckets
        self.log = CommitLog(spark, base)

    def _of(self, entry: dict | None) -> Buckets:
        # the count is the table's, fixed by its first commit
        return Buckets(self.spark, self.base, self.key, entry["count"] if entry else self.buckets)

    def mark(self) -> _dt.datetime | None:
        last = self.log.last()
        return last["source_hwm"] if last else None

    def read(self, entry: dict | None = None) -> DataFrame | None:
        entry = entry or self.log.last()
        return self._of(entry).read(entry["parts"], _schema(entry)) if entry else None

    def merge(self, source: DataFrame, columns: list[str] | None = None, tiebreak: str | None = None) -> dict | None:
        """One incremental run; returns the new log entry, or None when nothing is newer than the mark.

        The entry's ``previous`` is the version it started from and ``touched`` the buckets it rewrote.
        """
        last = self.log.last()
        buckets, columns = self._of(last), columns or source.columns
        if last is None:
            obs = Observation()                        # the newest stamp is measured in the write
            rows = latest_per_key(source, self.key, self.ts, tiebreak=tiebreak).select(*columns)
            parts = buckets.write(rows.observe(obs, F.max(F.col(self.ts).cast("timestamp_ntz")).alias("hwm")))
            return self.log.publish(0, previous=None, count=buckets.count, schema=rows.schema.json(), parts=parts,
                                    touched=sorted(map(int, parts)), source_hwm=obs.get["hwm"])
        new = source if last["source_hwm"] is None else source.where(F.col(self.ts) > F.lit(last["source_hwm"]))
        new = materialize_checkpoint(latest_per_key(new, self.key, self.ts, tiebreak=tiebreak).select(*columns))
        touched, newest = buckets.of(new, self.ts)
        if not touched:
            return None
        old = buckets.read(last["parts"], _schema(last), touched)
        rows = old.join(new.select(self.key), self.key, "left_anti").unionByName(new)
        parts = buckets.replaced(last["parts"], touched, rows)
        return self.log.publish(last["version"] + 1, previous=last["version"], count=buckets.count, schema=last["schema"], parts=parts,
                                touched=touched, source_hwm=max(filter(None, (last["source_hwm"], newest)), default=None))

    def changes(self, entry: dict) -> DataFrame:
        """The rows that a commit took out (``sign`` -1) and put in (+1); unchanged rows of rewritten buckets are
        in neither. Reads the touched buckets of the two versions only."""
        buckets, schema = self._of(entry), _schema(entry)
        after = buckets.read(entry["parts"], schema, entry["touched"])
        if entry["previous"] is None:
            return after.withColumn("sign", F.lit(1))
        before = buckets.read(self.log.entry(entry["previous"])["parts"], schema, entry["touched"])
        both = before.withColumn("sign", F.lit(-1)).unionByName(after.withColumn("sign", F.lit(1)))
        # a row in both cancels out; grouping compares nulls as equal
        return (both.groupBy(*[F.col(c) for c in schema.names]).agg(F.sum("sign").cast("int").alias("sign")).where("sign <> 0"))


class HistoryStore:
    """Slowly changing history in two parts (M2): closed versions are only ever appended, open versions (one a key)
    lie in key buckets of which a run rewrites those that hold a changed key. Files of closed versions are never
    read or written again by a run."""

    def __init__(self, spark: SparkSession, base: str, key: str, ts: str, columns: list[str],
                 check_cols: list[str] | None = None, buckets: int = STORE_BUCKETS):
        self.spark, self.base, self.key, self.ts = spark, base.rstrip("/"), key, ts
        self.columns, self.check_cols, self.buckets = columns, check_cols, buckets
        self.log = CommitLog(spark, base)

    def _of(self, entry: dict | None) -> Buckets:
        return Buckets(self.spark, self.base, self.key, entry["count"] if entry else self.buckets)

    def open_versions(self, entry: dict | None = None) -> DataFrame | None:
        entry = entry or self.log.last()
        return self._of(entry).read(entry["parts"], _schema(entry)) if entry else None

    def read(self, entry: dict | None = None) -> DataFrame | None:
        """All versions, closed and open."""
        entry = entry or self.log.last()
        if entry is None:
            return None
        out = self.open_versions(entry)
        return self.spark.read.schema(_schema(entry)).parquet(*entry["closed"]).unionByName(out) if entry["closed"] else out

    def run(self, snapshot: DataFrame, tiebreak: str | None = None) -> dict | None:
        """One snapshot run; returns the new log entry, or None when the snapshot changes nothing.

        The snapshot, latest row a key, first meets the open versions' keys and stamps only (null-safe). What is
        new or newer (with ``check_cols``: and differs there) decides the touched buckets; only those are read
        whole. Keys absent from the snapshot stay open.
        """
        from tidemark.operators.history import opened_versions
        last = self.log.last()
        buckets = self._of(last)
        extra = [tiebreak] if tiebreak else []
        snap = latest_per_key(snapshot.select(self.key, *self.columns, self.ts, *extra), self.key, self.ts, tiebreak=tiebreak).drop(*extra)
        if last is None:
            rows = opened_versions(snap, self.key, self.ts, self.columns)
            parts = buckets.write(rows)
            return self.log.publish(0, previous=None, count=buckets.count, schema=rows.schema.json(), parts=parts,
                                    touched=sorted(map(int, parts)), closed=[])
        schema, check = _schema(last), self.check_cols or []
        known = self.open_versions(last).select(F.col(self.key).alias("__key"), F.col("dbt_updated_at").alias("__at"), F.lit(True).alias("__known"),
                                                *[F.col(c).alias(f"__old_{c}") for c in check])
        differs = F.lit(True)
        if check:
            differs = F.lit(False)
            for c in check:
                differs = differs | ~F.col(c).eqNullSafe(F.col(f"__old_{c}"))
        met = snap.join(known, F.col(self.key).eqNullSafe(F.col("__key")), "left")
        fresh = met.where(F.col("__known").isNull() | ((F.col(self.ts) > F.col("__at")) & differs)).select(*snap.columns)
        fresh = materialize_checkpoint(fresh)
        touched, _ = buckets.of(fresh)
        if not touched:
            return None
        # every fresh row opens a version and closes the open one of its key, if there is one
        ends = fresh.select(F.col(self.key).alias("__key"), F.col(self.ts).alias("__end"))
        stepped = (buckets.read(last["parts"], schema, touched).drop("dbt_valid_to")
                   .join(ends, F.col(self.key).eqNullSafe(F.col("__key")), "left").withColumnRenamed("__end", "dbt_valid_to").select(*schema.names)
                   .unionByName(opened_versions(fresh, self.key, self.ts, self.columns)))
        # one write: the closed versions to a folder of their own, the open ones to their buckets
        written = buckets.write(stepped.select(*schema.names), apart=F.col("dbt_valid_to").isNotNull())
        closed = written.pop(APART, None)
        kept = {b: p for b, p in last["parts"].items() if int(b) not in set(touched)}
        return self.log.publish(last["version"] + 1, previous=last["version"], count=buckets.count, schema=last["schema"], parts={**kept, **written},
                                touched=touched, closed=[*last["closed"], *([closed] if closed else [])])


class DeltaMart:
    """Grouped mart kept up to date by signed changes (T5): ``groups``, distinct count, average and total of ``amount``.

    A refresh merges the rows newer than the mark into the mart's input (a ``KeyedStore``), takes the old rows of
    the changed keys out of the groups and puts the new ones in. The distinct count follows from multiplicities:
    rows a (group, value), in key buckets of the value; a group's count moves when a multiplicity leaves or
    reaches zero. Totals are exact decimals, so what is put in can be taken out. The mart itself, one row a
    group, is written whole. Multiplicities, mart and the input's version commit in one log entry; a refresh
    that died in between starts again from the last entry and the input's changes since.
    """

    AMOUNT = "decimal(28,10)"

    def __init__(self, spark: SparkSession, base: str, key: str, ts: str, groups: list[str], distinct: str, amount: str,
                 buckets: int = STORE_BUCKETS):
        self.spark, self.base, self.groups, self.distinct, self.amount = spark, base.rstrip("/"), groups, distinct, amount
        self.ts, self.key, self.count = ts, key, buckets
        self.input = KeyedStore(spark, f"{self.base}/input", key, ts, buckets)
        self.log = CommitLog(spark, self.base)

    @property
    def input_columns(self) -> list[str]:
        return list(dict.fromkeys([self.key, *self.groups, self.distinct, self.amount, self.ts]))

    def state(self, entry: dict | None = None) -> DataFrame | None:
        entry = entry or self.log.last()
        return self.spark.read.schema(_schema(entry, "mart_schema")).parquet(entry["mart"]) if entry else None

    def read(self) -> DataFrame | None:
        """groups, n_distinct, average (null without amounts), total."""
        s = self.state()
        return None if s is None else s.select(*self.groups, "n_distinct", F.when(F.col("amounts") > 0, F.col("total").cast("double") / F.col("amounts")).alias("average"),
                                               F.when(F.col("amounts") > 0, F.col("total")).alias("total"))

    def refresh(self, source: DataFrame, tiebreak: str | None = None) -> dict | None:
        """One refresh; returns the new entry, or None when nothing changed."""
        self.input.merge(source.select(*dict.fromkeys([*self.input_columns, *([tiebreak] if tiebreak else [])])), self.input_columns, tiebreak)
        last, now = self.log.last(), self.input.log.last()
        done = last["input"] if last else -1
        if now is None or now["version"] == done:
            return None
        changes = None                                 # of every input commit that the mart has not seen
        for v in range(done + 1, now["version"] + 1):
            c = self.input.changes(self.input.log.entry(v))
            changes = c if changes is None else changes.unionByName(c)
        g, d = [F.col(c) for c in self.groups], F.col(self.distinct)
        amount = F.col(self.amount).cast(self.AMOUNT)
        changes = materialize_checkpoint(changes.select(*g, d.alias("__value"), amount.alias("__amount"), "sign"))
        many = Buckets(self.spark, f"{self.base}/many", "__value", last["count"] if last else self.count)
        moved = (changes.where("__value IS NOT NULL").groupBy(*self.groups, "__value").agg(F.sum("sign").alias("move")).where("move <> 0"))
        moved = materialize_checkpoint(moved)
        touched, _ = many.of(moved)
        schema = T.StructType([*[changes.schema[c] for c in self.groups], changes.schema["__value"], T.StructField("n", T.LongType())])
        before = many.read(last["many"] if last else {}, schema, touched)
        both = (before.withColumn("move", F.lit(0).cast("long")).unionByName(moved.withColumn("n", F.lit(0).cast("long")))
                .groupBy(*self.groups, "__value").agg(F.sum("n").alias("n"), F.sum("move").alias("move")))
        both = materialize_checkpoint(both)
        parts = many.replaced(last["many"] if last else {}, touched, both.select(*self.groups, "__value", (F.col("n") + F.col("move")).alias("n")).where("n > 0"))
        zero = F.lit(0).cast("long")
        step = ((F.col("n") + F.col("move")) > 0).cast("long") - (F.col("n") > 0).cast("long")
        none = F.lit(0).cast("decimal(38,10)")
        deltas = both.select(*g, zero.alias("rows"), step.alias("n_distinct"), zero.alias("amounts"), none.alias("total"))
        signed = F.col("sign").cast("long")
        deltas = deltas.unionByName(changes.select(
            *g, signed.alias("rows"), zero.alias("n_distinct"), F.when(F.col("__amount").isNotNull(), signed).otherwise(zero).alias("amounts"),
            (F.coalesce(F.col("__amount"), F.lit(0)) * F.col("sign")).cast("decimal(38,10)").alias("total")))
        if last:
            deltas = deltas.unionByName(self.state(last).select(*deltas.columns))
        mart = (deltas.groupBy(*self.groups).agg(*[F.sum(c).alias(c) for c in ("rows", "n_distinct", "amounts")],
                                                 F.sum("total").cast("decimal(38,10)").alias("total")).where("rows > 0"))
        path = f"{self.base}/mart-{uuid.uuid4().hex[:12]}"
        mart.write.parquet(path)
        return self.log.publish(last["version"] + 1 if last else 0, input=now["version"], count=many.count, many=parts, mart=path,
                                mart_schema=mart.schema.json(), source_hwm=now["source_hwm"], touched=touched)
