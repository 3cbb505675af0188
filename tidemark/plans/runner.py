"""Run the model graph in dependency order and materialise it.

The graph is a static, ordered list -- the order a project's references imply:
sources -> bronze (view) -> dimensions and fact (tables) -> marts (tables) ->
tests. Views stay lazy; tables are written (overwrite) and read back, which
also cuts lineage so downstream models plan against the stored files;
incremental and snapshot models keep their state between runs.
"""

from __future__ import annotations

import datetime as _dt
from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import mask_email_function
from tidemark.operators import history as H
from tidemark.operators import model_tests as T
from tidemark.operators import stores as ST
from tidemark.plans import models as M
from tidemark.sources.tables import SourceRegistry
from tidemark.sources.writers import buckets_for_bytes, materialize, scanned_bytes


@dataclass(frozen=True)
class Model:
    """One node of the graph.

    ``view`` stays lazy; ``table`` is rebuilt whole on every run; ``incremental`` keeps its rows between runs and
    takes what is newer than its mark (``build(frames, mark)``); ``snapshot`` keeps a history of its rows.
    """

    name: str
    kind: str
    build: Callable[..., DataFrame]
    bucket_by: str | None = None                 # co-locate tables joined on this key
    key: str | None = None                       # of incremental and snapshot models
    ts: str | None = None
    columns: tuple[str, ...] = ()


def newer_than(landing: DataFrame, mark: _dt.datetime | None, ts: str = M.STAMP) -> DataFrame:
    """Landing rows newer than the mark: the latest row of a key is newer than the mark exactly if any of its
    rows is, so the filter may stand below the bronze view's top-1, at the scan."""
    return landing if mark is None else landing.where(F.col(ts) > F.lit(mark))


def customer_models(incremental: bool = False) -> list[Model]:
    """The customer star schema, in dependency order.

    With ``incremental`` the fact is kept between runs (only key buckets with changed customers are written) and
    the KYC history is kept as a snapshot; else the fact is rebuilt, bucketed like the customer dimension.
    """
    fact = Model("fact_customer_activity", "table", lambda f: M.fact_customer_activity(f["bronze_customers"]), "customer_id")
    if incremental:
        fact = Model("fact_customer_activity", "incremental",
                     lambda f, mark: M.fact_customer_activity(M.bronze_customers(newer_than(f["raw.customers_raw"], mark))),
                     key="customer_id", ts=M.STAMP, columns=tuple(M.FACT_COLUMNS))
    out = [
        Model("bronze_customers", "view", lambda f: M.bronze_customers(f["raw.customers_raw"])),
        Model("dim_customer", "table", lambda f: M.dim_customer(f["bronze_customers"]), "customer_id"),
        Model("dim_date", "table", lambda f: M.dim_date(f["bronze_customers"])),
        Model("dim_service", "table", lambda f: M.dim_service(f["bronze_customers"])),
        fact,
        Model("mart_balance_by_country", "table",
              lambda f: M.mart_balance_by_country(f["fact_customer_activity"], f["dim_customer"], f["dim_date"])),
        Model("customers_risk_categorized", "table", lambda f: M.customers_risk_categorized(f["fact_customer_activity"])),
    ]
    if incremental:
        out.append(Model("customer_kyc_snapshot", "snapshot", lambda f: f["bronze_customers"], key="customer_id", ts=M.STAMP,
                         columns=("kyc_status", "account_balance")))
    return out


def run_models(spark: SparkSession, registry: SourceRegistry, models: list[Model], base_path: str,
               sources: list[str] = ("raw.customers_raw",), buckets: int | None = None) -> dict[str, DataFrame]:
    """Build every model in order; tables land in ``<base_path>/<name>``.

    Tables with a ``bucket_by`` key are written bucketed on it (same bucket
    count for all, by the bytes of the files that the sources read unless given), so the fact and the customer
    dimension meet in the marts and tests without a shuffle. Catalog names are made unique per run. Incremental
    and snapshot models go on from what the last run with this ``base_path`` left.
    """
    frames = {s: registry.get(s) for s in sources}
    if buckets is None and any(m.bucket_by or m.key for m in models):
        buckets = buckets_for_bytes(sum(scanned_bytes(f) for f in frames.values()))
    run = base_path.rstrip("/").rsplit("/", 1)[-1].replace("-", "_").replace(".", "_")
    for m in models:
        path = f"{base_path}/{m.name}"
        if m.kind == "incremental":
            store = ST.KeyedStore(spark, path, m.key, m.ts, buckets)
            store.merge(m.build(frames, store.mark()), list(m.columns))
            frames[m.name] = materialize(store.read(), "view", m.name)
        elif m.kind == "snapshot":
            history = ST.HistoryStore(spark, path, m.key, m.ts, list(m.columns), buckets=buckets)
            history.run(m.build(frames))
            frames[m.name] = materialize(history.read(), "view", m.name)
        else:
            frames[m.name] = materialize(m.build(frames), m.kind, f"{m.name}__{run}" if m.bucket_by else m.name,
                                         path if m.kind == "table" else None, bucket_by=m.bucket_by, buckets=buckets)
    return frames


ROLE_VARIABLE = "tidemark_role"


def publish_masked(spark: SparkSession, frame: DataFrame, name: str, masked: dict[str, str] | None = None) -> str:
    """Publish a frame as a view whose masked columns depend on the reader's role; returns the view's name.

    ``masked`` maps columns to SQL functions of (value, role); the default masks ``email``. The masking policy
    is a Spark SQL function, the role a session variable that starts as no role, so a reader who says nothing sees
    masked values: ``SET VAR tidemark_role = 'ENGINEER_ROLE'`` before reading.
    """
    spark.sql(mask_email_function("mask_email"))
    if not spark.catalog.tableExists(name):             # a further run must not take the role back
        spark.sql(f"DECLARE OR REPLACE VARIABLE {ROLE_VARIABLE} STRING DEFAULT ''")
    masked = masked or {"email": "mask_email"}
    frame.createOrReplaceTempView(f"{name}__rows")
    columns = ", ".join(f"{masked[c]}(`{c}`, {ROLE_VARIABLE}) AS `{c}`" if c in masked else f"`{c}`" for c in frame.columns)
    spark.sql(f"CREATE OR REPLACE TEMPORARY VIEW {name} AS SELECT {columns} FROM {name}__rows")
    return name


def read_as(spark: SparkSession, name: str, role: str) -> DataFrame:
    """The published view as a role sees it."""
    spark.sql(f"SET VAR {ROLE_VARIABLE} = :role", args={"role": role})
    return spark.sql(f"SELECT * FROM {name}")


def customer_tests(frames: dict[str, DataFrame], limits: DataFrame) -> list[T.DataTest]:
    dc, fact, ds = frames["dim_customer"], frames["fact_customer_activity"], frames["dim_service"]
    bronze = frames["bronze_customers"]
    return [
        T.DataTest("unique_dim_customer_customer_id", "error", lambda: T.unique_violations(dc, "customer_id")),
        T.DataTest("not_null_dim_customer_customer_id", "error", lambda: T.not_null_violations(dc, "customer_id")),
        T.DataTest("between_dim_customer_age", "warn", lambda: T.between_violations(dc, "age", 0, 120)),
        T.DataTest("not_null_fact_customer_id", "error", lambda: T.not_null_violations(fact, "customer_id")),
        T.DataTest("relationships_fact_dim_customer", "error",
                   lambda: T.relationship_orphans(fact, "customer_id", dc, "customer_id")),
        T.DataTest("not_null_fact_account_balance", "error", lambda: T.not_null_violations(fact, "account_balance")),
        T.DataTest("between_fact_risk_score", "warn", lambda: T.between_violations(fact, "risk_score", -50, 200)),
        T.DataTest("unique_dim_service_device_id", "error", lambda: T.unique_violations(ds, "device_id")),
        T.DataTest("not_null_dim_service_device_id", "error", lambda: T.not_null_violations(ds, "device_id")),
        T.DataTest("assert_balance_within_country_limit", "warn", lambda: T.limit_breaches(fact, dc, limits)),
        T.DataTest("assert_fact_not_empty_after_join", "error", lambda: T.row_loss_violations(bronze, fact)),
    ]


def build_and_test(spark: SparkSession, registry: SourceRegistry, base_path: str, limits: DataFrame,
                   fail_on_error: bool = True) -> DataFrame:
    """Models, then tests; raises when an ``error`` test fails (warn tests only report)."""
    frames = run_models(spark, registry, customer_models(), base_path)
    report = T.run_tests(customer_tests(frames, limits))
    report = materialize(report, "table", "test_report", f"{base_path}/_test_report")
    if fail_on_error:
        T.gate(report)
    return report


def refresh_if_stale(table: H.VersionedTable, build: Callable[[], DataFrame], source: DataFrame, ts: str,
                     lag: _dt.timedelta = _dt.timedelta(days=1), now: _dt.datetime | None = None) -> bool:
    """Freshness-driven refresh (a declared target lag instead of a schedule).

    Rebuilds and commits a new version when the table was never built, or when
    the source holds stamps newer than those the current version was built from
    and the current version is at least ``lag`` old (wall clock). Data stamps
    are compared with data stamps, wall-clock times with wall-clock times. One
    scalar aggregate on the source decides it. Returns True when it refreshed.
    """
    now = now or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
    newest = source.agg(F.max(ts)).first()[0]
    last = table.last_commit()
    if last is None:
        table.commit(build(), committed_at=now, source_hwm=newest)
        return True
    fresh_data = newest is not None and (last["source_hwm"] is None or newest > last["source_hwm"])
    if fresh_data and now - last["committed_at"] >= lag:
        table.commit(build(), committed_at=now, source_hwm=newest)
        return True
    return False
