"""Streaming = batch, idempotent reruns, by-name loads, seeds, schema store, runner, fault round trip."""

import datetime as dt
import json
import os

from pyspark.sql import functions as F

from tidemark.operators import faults as G
from tidemark.operators import suite as Q
from tidemark.operators import model_tests as T
from tidemark.plans import queries as QQ
from tidemark.plans import runner as R
from tidemark.session import local_path
from tidemark.sources import json_rescue as J
from tidemark.sources import landing as L
from tidemark.sources import seeds as S
from tidemark.sources.tables import SourceRegistry
from tidemark.streaming import pipeline as P
from tests.conftest import SF_SMALL


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_fault_round_trip(spark):
    """Injected counts per fault class equal what the checks detect."""
    f = QQ.faulted_records(spark, SF_SMALL).cache()
    copies = f.where("copy_id = 1").count()
    uniq = Q.validate(f, [Q.unique("customer_id")]).first()
    assert uniq["unexpected_count"] == 2 * copies
    bad_age = f.where("copy_id = 0 and age not between 18 and 100").count()
    dedup = f.where("copy_id = 0")
    got = {r["expectation"] + str(r["column_name"]): r["unexpected_count"]
           for r in Q.validate(dedup, [Q.between("age", 18, 100), Q.not_null("email")]).collect()}
    assert got["expect_column_values_to_be_betweenage"] == bad_age
    assert got["expect_column_values_to_not_be_nullemail"] == T.not_null_violations(dedup, "email").count()
    f.unpersist()


def test_faults_are_partition_invariant(spark):
    keys = spark.range(500).withColumnRenamed("id", "k")
    a = _rows(G.inject_faults(G.clean_records(keys.repartition(1), "k"), 7))
    b = _rows(G.inject_faults(G.clean_records(keys.repartition(13), "k"), 7))
    assert a == b


def test_json_lines_round_trip(spark):
    recs = G.inject_faults(G.clean_records(spark.range(300).withColumnRenamed("id", "k"), "k"), 3)
    lines = G.to_json_lines(recs)
    parsed = J.rescue_parse(lines, QQ.RAW_SCHEMA)
    assert parsed.where("_corrupt_record is not null").count() == 0
    back = P.unify(parsed).select("customer_id", "customer_name", "account_balance")
    assert _rows(back) == _rows(recs.select("customer_id", "customer_name", "account_balance"))


def test_stream_equals_batch_and_rerun_is_idempotent(spark, tmp):
    paths = P.MedallionPaths(f"{tmp}/raw", f"{tmp}/bronze", f"{tmp}/unified", f"{tmp}/clean", f"{tmp}/metrics",
                             f"{tmp}/_ck")
    cfg = P.CleanConfig(key="customer_id", rules=tuple(QQ.STREAM_RULES))
    for land in QQ._raw_batches(spark, SF_SMALL, paths.raw):
        land()
        P.run_medallion(spark, paths, QQ.RAW_SCHEMA, cfg, pattern="*.txt")
    first = _rows(P.read_sink(spark, paths.clean).select("customer_id", "customer_name", "email"))
    P.run_medallion(spark, paths, QQ.RAW_SCHEMA, cfg, pattern="*.txt")      # nothing new
    again = _rows(P.read_sink(spark, paths.clean).select("customer_id", "customer_name", "email"))
    batch = _rows(QQ.clean_records(spark, SF_SMALL).select("customer_id", "customer_name", "email"))
    assert first == again == batch
    m = P.read_sink(spark, paths.metrics)
    assert set(r[0] for r in m.select("rule_name").distinct().collect()) == {r.name for r in QQ.STREAM_RULES}


def test_stream_fail_rule_stops_batch_and_writes_nothing(spark, tmp):
    os.makedirs(local_path(f"{tmp}/raw"), exist_ok=True)
    with open(local_path(f"{tmp}/raw/a.json"), "w") as fh:
        fh.write(json.dumps({"customer_name": "x", "email": "a@b.c"}) + "\n")
    paths = P.MedallionPaths(f"{tmp}/raw", f"{tmp}/bronze", f"{tmp}/unified", f"{tmp}/clean", f"{tmp}/m", f"{tmp}/_ck")
    cfg = P.CleanConfig(key="customer_id", rules=tuple(QQ.STREAM_RULES))
    try:
        P.run_medallion(spark, paths, QQ.RAW_SCHEMA, cfg)
        raised = False
    except Exception as e:  # noqa: BLE001
        raised = "valid_customer_id" in str(e)
    assert raised
    assert not os.path.exists(local_path(f"{tmp}/clean"))


def test_load_by_name_ignores_control_files(spark, tmp):
    a = spark.createDataFrame([(1, "x", 2.0)], "customer_id long, name string, bal double")
    a.select(F.col("bal").alias("BAL"), F.col("customer_id").alias("Customer_ID")).write.parquet(f"{tmp}/stage/e1")
    a.write.parquet(f"{tmp}/stage/e2")
    os.makedirs(local_path(f"{tmp}/stage/e3"), exist_ok=True)
    for junk in ("_SUCCESS", "_started_123", "_committed_123", "notes.txt"):
        with open(local_path(f"{tmp}/stage/e3/{junk}"), "w") as fh:
            fh.write("not parquet")
    got = _rows(L.read_exports(spark, f"{tmp}/stage", a.schema))
    assert sorted(got, key=repr) == sorted([(1, None, 2.0), (1, "x", 2.0)], key=repr)
    L.load_new_exports(spark, f"{tmp}/stage", f"{tmp}/landing", f"{tmp}/_ck", a.schema)
    L.load_new_exports(spark, f"{tmp}/stage", f"{tmp}/landing", f"{tmp}/_ck", a.schema)
    assert spark.read.parquet(f"{tmp}/landing").count() == 2


def test_seed_and_fixture_loaders(spark, tmp):
    S.write_country_limits_csv(spark, f"{tmp}/seed")
    seed = S.load_seed(spark, f"{tmp}/seed")
    assert seed.count() == 7 and dict((r[0], r[1]) for r in seed.collect())["Spain"] == 100000
    import pytest
    with pytest.raises(ValueError):
        S.load_fixture(spark, f"{tmp}/x.xml")


def test_schema_store(spark, tmp):
    loc = f"{tmp}/_schema"
    assert J.load_schema(spark, loc) is None
    s = J.resolve_schema(spark, loc, default=QQ.RAW_SCHEMA)
    assert s == QQ.RAW_SCHEMA and J.load_schema(spark, loc) == QQ.RAW_SCHEMA


def test_runner_builds_models_and_gates(spark, tmp):
    reg = SourceRegistry()
    from tidemark.plans import standins as ST
    reg.register("raw.customers_raw", lambda: ST.customer_exports(spark, SF_SMALL))
    limits = QQ.limits_standin(spark, SF_SMALL)
    report = R.build_and_test(spark, reg, tmp, limits, fail_on_error=True)
    status = {r["test_name"]: r["status"] for r in report.collect()}
    assert status["unique_dim_customer_customer_id"] == "pass"
    assert status["assert_balance_within_country_limit"] == "warn"
    assert spark.read.parquet(f"{tmp}/mart_balance_by_country").count() > 0


def test_refresh_if_stale(spark, tmp):
    from tidemark.operators.history import VersionedTable
    src = spark.createDataFrame([(dt.datetime(1998, 1, 1),)], "ts timestamp_ntz")
    tbl = VersionedTable(spark, tmp)
    build = lambda: src
    assert R.refresh_if_stale(tbl, build, src, "ts", now=dt.datetime(2024, 1, 2))        # first build
    assert not R.refresh_if_stale(tbl, build, src, "ts", now=dt.datetime(2024, 1, 9))    # no newer data
    src2 = spark.createDataFrame([(dt.datetime(1998, 1, 6),)], "ts timestamp_ntz")
    assert not R.refresh_if_stale(tbl, build, src2, "ts", now=dt.datetime(2024, 1, 2, 12))  # inside the lag
    assert R.refresh_if_stale(tbl, build, src2, "ts", now=dt.datetime(2024, 1, 4))
    assert tbl.last_commit()["source_hwm"] == dt.datetime(1998, 1, 6)


def test_mart_partition_invariance(spark):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    res = []
    for n in ("1", "4", "16"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        res.append(_rows(QQ.QUERIES["mart_balance"](spark, SF_SMALL)))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert res[0] == res[1] == res[2]


def test_schema_inference_on_drifted_json(spark, tmp):
    """One-off inference sees nested structs, renamed and extra keys, and a mixed-type balance."""
    lines = [json.dumps({"customer_id": 1, "account_balance": 1.5,
                         "metadata": {"device": "ios", "preferences": {"notifications": True, "language": "es"},
                                      "risk_score": 10.0}}),
             json.dumps({"customer_id": 2, "account_balance": "2.5", "customerName": "B"}),
             json.dumps({"customer_id": 3, "experimental_flag": True})]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{tmp}/raw")
    s = J.infer_schema(spark, f"{tmp}/raw")
    names = {f.name: f.dataType.simpleString() for f in s.fields}
    assert names["account_balance"] == "string"            # mixed number / string -> string
    assert names["customerName"] == "string" and names["experimental_flag"] == "boolean"
    assert names["metadata"].startswith("struct<device:string,preferences:struct<language:string")
    stored = J.resolve_schema(spark, f"{tmp}/_schema", sample_path=f"{tmp}/raw")
    assert stored == s and J.load_schema(spark, f"{tmp}/_schema") == s
    # with the inferred schema the renamed field is a column, and the unify step folds it back
    parsed = J.rescue_parse(spark.read.text(f"{tmp}/raw"), s)
    u = {r["customer_id"]: r for r in P.unify(parsed).collect()}
    assert u[2]["customer_name"] == "B" and u[2]["account_balance"] == 2.5 and u[2]["had_schema_drift"] is True
    assert u[1]["had_schema_drift"] is False


def test_stream_dedup_first_batch_wins(spark, tmp):
    import pytest  # noqa: F401
    for mode in ("native", "ordered"):
        src, out = f"{tmp}/{mode}/src", f"{tmp}/{mode}/out"
        schema = "k long, ts long, v string"
        spark.createDataFrame([(1, 5, "a"), (2, 1, "b")], schema).write.parquet(f"{src}/b1")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        P.dedup_stream(spark, stream, out, f"{tmp}/{mode}/_ck", "k", order_by="ts", state=mode)
        spark.createDataFrame([(1, 0, "late"), (3, 2, "c")], schema).write.parquet(f"{src}/b2")
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        P.dedup_stream(spark, stream, out, f"{tmp}/{mode}/_ck", "k", order_by="ts", state=mode)
        got = {r["k"]: r["v"] for r in P.read_sink(spark, out).collect()}
        assert got == {1: "a", 2: "b", 3: "c"}, mode


def test_non_object_json_lines_are_quarantined(spark):
    df = spark.createDataFrame([("5",), ("[1, 2]",), ('"x"',), ('{"customer_id": 1}',)], "value string")
    out = J.rescue_parse(df, QQ.RAW_SCHEMA)
    assert sorted(r[0] for r in out.where("_corrupt_record is not null").select("_corrupt_record").collect()) == \
        sorted(['"x"', "5", "[1, 2]"])


def test_merge_inserts_null_key_rows(spark):
    from tidemark.operators.history import incremental_merge
    target = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), "a")], "k long, ts timestamp_ntz, v string")
    src = spark.createDataFrame([(None, dt.datetime(2024, 1, 2), "n"), (1, dt.datetime(2024, 1, 3), "b")],
                                target.schema)
    got = sorted(map(tuple, incremental_merge(target, src, "k", "ts").collect()), key=repr)
    assert got == sorted([(None, dt.datetime(2024, 1, 2), "n"), (1, dt.datetime(2024, 1, 3), "b")], key=repr)


def test_stream_dedup_within_watermark(spark, tmp):
    schema = "k long, ts timestamp_ntz, v string"
    src, out = f"{tmp}/src", f"{tmp}/out"
    t0 = dt.datetime(2024, 1, 1)
    spark.createDataFrame([(1, t0, "a"), (2, t0, "b")], schema).write.parquet(f"{src}/b1")

    def run():
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(src)
        P.dedup_stream(spark, stream, out, f"{tmp}/_ck", "k", state="watermark", event_time="ts", delay="1 hour")
    run()
    spark.createDataFrame([(1, t0 + dt.timedelta(minutes=5), "dup"), (3, t0, "c")], schema).write.parquet(f"{src}/b2")
    run()
    got = sorted((r["k"], r["v"]) for r in spark.read.parquet(out).collect())
    assert got == [(1, "a"), (2, "b"), (3, "c")]
