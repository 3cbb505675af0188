"""Plan properties that matter at scale, checked on the physical plans."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedup as D
from tidemark.operators import model_tests as T
from tidemark.plans import queries as Q
from tests.conftest import SF_SMALL


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def _sections(p: str) -> dict[int, str]:
    """Formatted-plan node details by node id (ids count up from the leaves)."""
    out = {}
    for m in re.finditer(r"^\((\d+)\) ([^\n]*)\n(.*?)(?=^\(\d+\) |\Z)", p, re.S | re.M):
        out[int(m.group(1))] = m.group(2) + "\n" + m.group(3)
    return out


def _before_first_exchange(p: str, needle: str) -> bool:
    """Some node containing ``needle`` sits below the lowest exchange (feeds the shuffle)."""
    sec = _sections(p)
    ex = [i for i, t in sec.items() if t.startswith("Exchange")]
    hit = [i for i, t in sec.items() if needle in t]
    return bool(ex and hit and min(hit) < min(ex))


def test_top1_is_partial_before_the_shuffle(spark):
    p = plan(Q.QUERIES["latest_per_key"](spark, SF_SMALL))
    assert _before_first_exchange(p, "partial_max_by")


def test_hot_key_costs_one_row_per_map_task(spark):
    # one key holds a third of the rows
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"),
                                   F.col("id").alias("ts"))
    p = plan(D.latest_per_key(df, "k", "ts"))
    assert _before_first_exchange(p, "partial_max_by")


def test_hot_key_after_a_skewed_join_is_reduced_before_the_new_shuffle(spark):
    """AQE splits the skewed join; the top-1 still runs partially before the exchange AQE adds."""
    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        orders = spark.range(60000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("customer_id"),
            F.col("id").alias("ts"))
        cust = spark.range(5000).select(F.col("id").alias("customer_id"), (F.col("id") % 25).alias("nation"))
        df = D.latest_per_key(orders.join(cust, "customer_id"), "customer_id", "ts")
        rows = df.collect()
        final = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    assert len(rows) == 5000
    assert "skew=true" in final
    tail = final[final.index("skew=true") - 400: final.index("skew=true")]
    assert "partial_max_by" in tail


def test_unique_and_orphans_aggregate_before_shuffle(spark):
    p = plan(Q.QUERIES["test_unique"](spark, SF_SMALL))
    assert "partial_count" in p and _before_first_exchange(p, "partial_count")
    p = plan(Q.QUERIES["test_relationships"](spark, SF_SMALL))
    assert "partial_count" in p and "LeftAnti" in p


def test_projection_reaches_the_scan(spark):
    p = plan(Q.QUERIES["json_extract"](spark, SF_SMALL))
    schema = re.search(r"ReadSchema: (struct<[^\n]*>)", p).group(1)
    assert schema == "struct<event_id:bigint,user_id:bigint,props:string>"


def test_filters_reach_the_scan(spark):
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    p = plan(T.between_violations(ev, "value", 0, 10).select("event_id"))
    assert "PushedFilters" in p
    from tidemark.operators.expectations import passing
    p = plan(passing(ev, Q.EVENT_RULES))
    assert re.search(r"PushedFilters: \[[^\]]*In\(event_type", p)


def test_no_cross_join_of_data(spark):
    for name in ["mart_balance", "limit_breaches", "incremental_merge", "scd2_history", "test_relationships",
                 "dedup_by_key", "expired_versions"]:
        p = plan(Q.QUERIES[name](spark, SF_SMALL))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def test_seed_join_is_broadcast_by_the_planner(spark):
    p = plan(Q.QUERIES["limit_breaches"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_no_python_udf_anywhere(spark):
    for name, fn in Q.QUERIES.items():
        if name in {"ingest_incremental", "medallion_clean", "stream_dedup", "stream_expectations",
                    "stream_expectation_metrics", "load_by_name", "export_snapshot", "clustered_rewrite"}:
            continue
        p = plan(fn(spark, SF_SMALL))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


@pytest.mark.parametrize("name", ["mart_balance", "test_report", "incremental_merge"])
def test_bronze_is_computed_once(spark, name):
    """Models read the checkpointed bronze, not the orders scan again per model."""
    p = plan(Q.QUERIES[name](spark, SF_SMALL))
    assert p.count("orders.parquet") <= 1


def test_bucketed_models_join_without_shuffle(spark, tmp):
    """The runner's fact and customer dimension are bucketed on customer_id: their join has no exchange."""
    from tidemark.plans import runner as R
    from tidemark.plans import standins as S
    from tidemark.sources.tables import SourceRegistry
    reg = SourceRegistry()
    reg.register("raw.customers_raw", lambda: S.customer_exports(spark, SF_SMALL))
    frames = R.run_models(spark, reg, R.customer_models()[:5], tmp)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = frames["fact_customer_activity"].join(frames["dim_customer"], "customer_id")
        p = plan(j)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin" in p and "Exchange" not in p


def test_clustered_write_splits_a_hot_cluster_value(spark, tmp):
    from tidemark.sources.writers import clustered
    df = spark.range(30000).select(F.when(F.col("id") % 3 == 0, F.lit("Peru")).otherwise(
        F.concat(F.lit("c"), (F.col("id") % 50).cast("string"))).alias("country"), F.col("id"))
    parts = clustered(df, ["country"], 8).groupBy(F.spark_partition_id().alias("p")).agg(
        F.count_if(F.col("country") == "Peru").alias("peru")).where("peru > 0").count()
    assert parts >= 2                                  # the hot value is written by several tasks


def test_seed_is_written_by_several_tasks(spark, monkeypatch):
    from tidemark.plans import queries as Q
    rows = spark.range(40).selectExpr("concat('c', id) AS country", "id AS max_balance_limit", "'x' AS regulatory_body").repartition(4)
    monkeypatch.setattr(Q, "limits_standin", lambda *_: rows)
    got = Q.seed_limits(spark, "")
    assert got.count() == 40 and len(got.inputFiles()) == 4


def test_bucket_count_follows_the_bytes_read(spark, tmp):
    import os

    from tidemark.plans import runner as R
    from tidemark.plans import standins as S
    from tidemark.sources.tables import SourceRegistry
    from tidemark.sources.writers import buckets_for_bytes, scanned_bytes
    assert buckets_for_bytes(1) == 16 and buckets_for_bytes(100 << 30) == 100
    joined = S.customer_exports(spark, "/root/testdata/sf0.1")     # a join of three tables
    real = sum(os.path.getsize(f"/root/testdata/sf0.1/{t}.parquet") for t in ("orders", "customer", "nation"))
    assert scanned_bytes(joined) == real and buckets_for_bytes(scanned_bytes(joined)) == 16
    with pytest.raises(ValueError):
        scanned_bytes(spark.range(5))
    reg = SourceRegistry()
    reg.register("raw.customers_raw", lambda: S.customer_exports(spark, SF_SMALL))
    frames = R.run_models(spark, reg, R.customer_models()[:2], tmp)
    assert len({f.rsplit("_", 1)[1] for f in frames["dim_customer"].inputFiles()}) <= 16


def test_too_many_buckets_is_an_error(spark, tmp):
    from tidemark.sources.writers import materialize
    with pytest.raises(ValueError, match="maxBuckets"):
        materialize(spark.range(5), "table", "too_many", tmp, bucket_by="id", buckets=10 ** 7)


def test_money_total_keeps_digits(spark):
    from tidemark.plans.models import _money_sum
    df = spark.createDataFrame([(9007199254740.91,), (0.001,), (0.002,), (123456789012345.0,)], "x double")
    assert str(df.agg(_money_sum("x")).first()[0]) == "132463988267085.9130000000"
