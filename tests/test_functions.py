"""Column functions and small source helpers."""

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.sources.tables import SourceRegistry
from tidemark.sources.writers import materialize


def test_extract_path_struct_variant_and_json(spark):
    df = spark.createDataFrame([('{"a": {"b": "7"}}',)], "j string")
    df = df.select("j", F.from_json("j", "a struct<b:string>").alias("s"), F.parse_json("j").alias("v"))
    got = df.select(C.extract_path(df, "j", "a.b", "double"), C.extract_path(df, "s", "a.b", "double"),
                    C.extract_path(df, "v", "a.b", "double")).first()
    assert tuple(got) == (7.0, 7.0, 7.0)


def test_to_double_is_lenient_under_ansi(spark):
    df = spark.createDataFrame([("1.5",), ("",), ("abc",), (None,)], "s string")
    assert [r[0] for r in df.select(C.to_double("s")).collect()] == [1.5, None, None, None]


def test_coalesce_renamed_and_drift_flag_are_adaptive(spark):
    df = spark.createDataFrame([("a", None), (None, "b")], "customer_name string, customerName string")
    out = C.drift_flag(C.coalesce_renamed(df, "customer_name", "customerName", "gone"), ["customerName", "absent"])
    assert [(r[0], r[2]) for r in out.select("customer_name", "customerName", "had_schema_drift").collect()] == \
        [("a", False), ("b", True)]
    plain = spark.createDataFrame([("a",)], "customer_name string")
    assert C.drift_flag(plain, ["customerName"]).first()["had_schema_drift"] is False
    assert C.drop_present(plain, "nope").columns == ["customer_name"]


def test_month_start_and_iso_dates(spark):
    df = spark.createDataFrame([("2024-02-29T13:00:00",), ("not a date",)], "d string")
    got = [r[0] for r in df.select(C.month_start(C.iso_to_date("d"))).collect()]
    assert str(got[0]) == "2024-02-01" and got[1] is None


def test_source_registry(spark):
    reg = SourceRegistry()
    reg.register("raw.customers_raw", lambda: spark.range(3))
    assert reg.get("RAW.customers_raw").count() == 3
    reg.register_views()
    assert spark.table("customers_raw").count() == 3
    with pytest.raises(KeyError):
        reg.get("raw.missing")


def test_materialize_view_and_table(spark, tmp):
    v = materialize(spark.range(4), "view", "tm_view")
    assert spark.table("tm_view").count() == 4 and v.count() == 4
    t = materialize(spark.range(6), "table", "tm_table", f"{tmp}/t")
    assert t.count() == 6 and spark.read.parquet(f"{tmp}/t").count() == 6
    with pytest.raises(ValueError):
        materialize(spark.range(1), "table", "x")


def test_hash_uniform_is_stable_and_in_range(spark):
    df = spark.range(2000).select(C.hash_uniform(42, "s", "id").alias("u"))
    stats = df.agg(F.min("u"), F.max("u"), F.avg("u")).first()
    assert 0 <= stats[0] and stats[1] < 1 and abs(stats[2] - 0.5) < 0.05
    again = spark.range(2000).repartition(7).select(C.hash_uniform(42, "s", "id").alias("u"))
    assert sorted(r[0] for r in df.collect()) == sorted(r[0] for r in again.collect())


def test_cluster_conf_sizes_from_input():
    from tidemark.session import cluster_conf
    c = cluster_conf(100 * 1024 ** 4, executor_cores=8, executors=1000)
    assert int(c["spark.sql.shuffle.partitions"]) == 100 * 1024 ** 4 // (256 * 1024 ** 2)
    small = cluster_conf(10 * 1024 ** 2, executor_cores=4, executors=2)
    assert int(small["spark.sql.shuffle.partitions"]) == 16          # never below twice the task slots
    assert c["spark.sql.files.maxPartitionBytes"] == str(256 * 1024 ** 2)
