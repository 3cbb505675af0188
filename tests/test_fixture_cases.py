"""Hand-written cases, one row per fault (FIXTURES.md section 2), through the real operators."""

import json

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.operators import expectations as X
from tidemark.operators import model_tests as T
from tidemark.plans.queries import CLEAN_RULES, RAW_SCHEMA
from tidemark.sources.json_rescue import rescue_parse
from tidemark.streaming.pipeline import unify

META = {"device": "ios", "preferences": {"notifications": True, "language": "es"},
        "last_login_ip": "1.2.3.4", "risk_score": 50.0}


def rec(i, **over):
    r = {"customer_id": i, "customer_name": f"Customer_{i}", "age": 30, "country": "Peru",
         "email": f"user{i}@gmail.com", "registration_date": "2022-03-04T00:00:00", "account_type": "savings",
         "account_balance": 100.5, "kyc_status": "verified", "metadata": json.loads(json.dumps(META))}
    for k, v in over.items():
        if v is KeyError:
            r.pop(k, None)
        else:
            r[k] = v
    return r


CASES = {
    1: rec(1),
    2: rec(2, customer_name=None),
    3: rec(3, email=None),
    4: rec(4, age=None),
    5: rec(5, country=None),
    7: rec(7, email="user7gmail.com"),
    8: rec(8, email="user8@"),
    9: rec(9, email=" user9@gmail.com "),
    10: rec(10, email="user10@@gmail.com"),
    11: {**rec(11, customer_name=KeyError), "customerName": "Customer_11"},
    12: {**rec(12, customer_name=KeyError), "customerName": None},
    13: {**rec(13), "experimental_flag": True},
    14: rec(14, account_balance="123.45"),
    15: rec(15, account_balance=""),
    16: rec(16, account_balance=-500.0),
    19: {**rec(19), "metadata": {**META, "risk_score": 150.0}},
    24: rec(24, kyc_status="unknown"),
}


@pytest.fixture(scope="module")
def parsed(spark):
    lines = [json.dumps(v) for _, v in sorted(CASES.items())] + ["{not json"]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    return rescue_parse(df, RAW_SCHEMA)


@pytest.fixture(scope="module")
def unified(parsed):
    u = unify(parsed.where(F.col("_corrupt_record").isNull()))
    return {r["customer_id"]: r for r in u.collect()}


def test_malformed_line_is_quarantined_not_lost(parsed):
    bad = parsed.where(F.col("_corrupt_record").isNotNull()).collect()
    assert len(bad) == 1 and bad[0]["_corrupt_record"] == "{not json"
    assert parsed.count() == len(CASES) + 1


def test_clean_row_has_no_drift(unified):
    assert unified[1]["had_schema_drift"] is False
    assert unified[1]["customer_name"] == "Customer_1"


def test_rename_folded_back_and_flagged(unified):
    assert unified[11]["customer_name"] == "Customer_11"
    assert unified[11]["had_schema_drift"] is True


def test_renamed_null_is_not_drift(unified):
    # trap 11: a renamed field holding NULL leaves no evidence and the row is dropped later
    assert unified[12]["customer_name"] is None
    assert unified[12]["had_schema_drift"] is False


def test_extra_field_flagged_and_dropped(unified):
    assert unified[13]["had_schema_drift"] is True
    assert "experimental_flag" not in unified[13].asDict()


def test_string_balance_repaired_with_evidence(unified):
    assert unified[14]["account_balance"] == 123.45
    assert unified[14]["had_schema_drift"] is True
    assert json.loads(unified[14]["_rescued_data"]) == {"account_balance": "123.45"}
    assert unified[15]["account_balance"] is None and unified[15]["had_schema_drift"] is True


def test_negative_balance_is_not_drift(unified):
    assert unified[16]["account_balance"] == -500.0 and unified[16]["had_schema_drift"] is False


def test_drop_and_warn_rules(spark, parsed):
    u = unify(parsed.where(F.col("_corrupt_record").isNull())).withColumn("risk_score", F.col("metadata.risk_score"))
    kept, metrics = X.apply_expectations(u, CLEAN_RULES)
    ids = {r[0] for r in kept.select("customer_id").collect()}
    assert {2, 3, 12}.isdisjoint(ids) and {1, 4, 5, 11, 13, 14, 24} <= ids
    m = {r["rule_name"]: r for r in metrics.collect()}
    assert m["valid_email"]["violations"] == 1
    assert m["valid_customer_name"]["violations"] == 2
    assert m["valid_age"]["unknown_records"] == 1          # NULL age: neither passed nor failed
    assert m["valid_risk_score"]["failed_records"] == 1


def test_fail_rule_raises(spark):
    df = spark.createDataFrame([(None, "a", "b@c.d")], "customer_id long, customer_name string, email string")
    with pytest.raises(X.ExpectationFailed) as e:
        X.apply_expectations(df, CLEAN_RULES[:3])
    assert "valid_customer_id" in str(e.value)


def test_risk_bucket_boundaries(spark):
    df = spark.createDataFrame([(x,) for x in [0.0, 39.99, 40.0, 69.99, 70.0, 100.0, -10.0, None]], "s double")
    got = [r[0] for r in df.select(C.risk_bucket("s")).collect()]
    assert got == ["low_risk", "low_risk", "medium_risk", "medium_risk", "high_risk", "high_risk", "low_risk",
                   "low_risk"]


def test_validity_boundaries(spark):
    df = spark.createDataFrame([(18, 0.0), (100, 100.0), (17, -0.01), (101, float("nan")), (None, None)],
                               "age long, risk_score double")
    got = [(r[0], r[1]) for r in df.select(*C.validity_flags()).collect()]
    assert got == [(True, True), (True, True), (False, False), (False, False), (None, None)]


def test_mask_email(spark):
    df = spark.createDataFrame([("abc@x.com",), ("abcx.com",), ("abc@",), (" a@x.com ",), ("a@@x.com",), (None,)],
                               "e string")
    analyst = [r[0] for r in df.select(C.mask_email("e", "ANALYST_ROLE")).collect()]
    assert analyst == ["***@x.com", "***", "***@", "***@x.com ", "***@x.com", None]
    lenient = [r[0] for r in df.select(C.mask_email("e", "ANALYST_ROLE", strict=False)).collect()]
    assert lenient[1] == "abcx.com"
    assert [r[0] for r in df.select(C.mask_email("e", "engineer_role")).collect()][0] == "abc@x.com"


def test_limit_reached_is_not_breach(spark):
    fact = spark.createDataFrame([(1, 50000.0), (2, 50000.01), (3, 10.0)], "customer_id long, account_balance double")
    dim = spark.createDataFrame([(1, "Peru"), (2, "Peru"), (3, None)], "customer_id long, country string")
    lim = spark.createDataFrame([("Peru", 50000)], "country string, max_balance_limit long")
    assert [r[0] for r in T.limit_breaches(fact, dim, lim).collect()] == [2]


@pytest.mark.parametrize("fact_rows,fails", [(89, True), (90, False)])
def test_row_loss_threshold(spark, fact_rows, fails):
    bronze = spark.range(100).withColumnRenamed("id", "customer_id")
    fact = spark.range(fact_rows).withColumnRenamed("id", "customer_id")
    assert T.row_loss_check(bronze, fact).first()["failed"] is fails
    assert (T.row_loss_violations(bronze, fact).count() == 1) is fails


def test_relationships_excludes_null_child_keys(spark):
    child = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    assert [tuple(r) for r in T.relationship_orphans(child, "k", parent, "k").collect()] == [(2, 2)]


def test_surrogate_key_null_token(spark):
    df = spark.createDataFrame([("ios", None)], "a string, b string")
    got = df.select(C.surrogate_key("a", "b")).first()[0]
    import hashlib
    assert got == hashlib.md5(b"ios-_dbt_utils_surrogate_key_null_").hexdigest()


def test_date_dim_sunday_zero_and_month_name(spark):
    df = spark.createDataFrame([("2024-01-07T00:00:00",)], "d string")
    r = df.select(*C.date_dim_columns(C.iso_to_date("d"))).first()
    assert (r["day_of_week"], r["month_name"], r["year"], r["month"], r["day"]) == (0, "Jan", 2024, 1, 7)


def test_enforce_into_is_one_pass_and_atomic(spark, tmp):
    from tidemark.operators.history import VersionedTable
    good = spark.createDataFrame([(1, "a", "x@y.z"), (2, None, "q@r.s")],
                                 "customer_id long, customer_name string, email string")
    table = VersionedTable(spark, tmp)
    path, metrics = X.enforce_into(table, good, CLEAN_RULES[:3])
    assert [r[0] for r in spark.read.parquet(path).collect()] == [1]
    assert {r["rule_name"]: r["violations"] for r in metrics.collect()}["valid_customer_name"] == 1
    bad = spark.createDataFrame([(None, "a", "x@y.z")], good.schema)
    with pytest.raises(X.ExpectationFailed):
        X.enforce_into(table, bad, CLEAN_RULES[:3])
    assert table.current_path() == path          # the failed version was never published


def test_invalid_ages_against_both_ranges(spark):
    """Case 6: all five fail 18-100; only -5, 150, 999 fail the warn range 0-120."""
    df = spark.createDataFrame([(a,) for a in [-5, 0, 150, 999, 15, None]], "age long")
    assert sorted(r[0] for r in T.between_violations(df, "age", 18, 100).collect()) == [-5, 0, 15, 150, 999]
    assert sorted(r[0] for r in T.between_violations(df, "age", 0, 120).collect()) == [-5, 150, 999]


def test_invalid_risk_scores(spark):
    """Case 19: all fail 0-100; only 999 fails -50-200; buckets low, high, high."""
    df = spark.createDataFrame([(x,) for x in [-10.0, 150.0, 999.0]], "risk_score double")
    assert T.between_violations(df, "risk_score", 0, 100).count() == 3
    assert [r[0] for r in T.between_violations(df, "risk_score", -50, 200).collect()] == [999.0]
    assert [r[0] for r in df.select(C.risk_bucket("risk_score")).collect()] == ["low_risk", "high_risk", "high_risk"]


def test_risk_procedure_message_and_export_count(spark, tmp):
    import datetime as dt
    from tidemark.plans.models import categorize_customer_risk
    from tidemark.sources.writers import export_snapshot
    fact = spark.createDataFrame([(1, 10.0, 75.0), (2, 5.0, None)], "customer_id long, account_balance double, "
                                 "risk_score double")
    assert categorize_customer_risk(fact, f"{tmp}/risk") == "Categorized 2 customers into risk buckets."
    assert {r[3] for r in spark.read.parquet(f"{tmp}/risk").collect()} == {"high_risk", "low_risk"}
    counts = {}
    path = export_snapshot(fact, f"{tmp}/exp", dt.datetime(2024, 1, 1, 5, 0, 0), counts=counts)
    assert counts == {"rows": 2} and path.endswith("customers_cleaned_20240101_000000")
    assert {str(r[0]) for r in spark.read.parquet(path).select("exported_at_utc_minus_5").collect()} == \
        {"2024-01-01 00:00:00"}


def test_rescue_loses_nothing(spark):
    """Fractions, overflows, failed nested casts and unknown nested keys end up in the rescued column."""
    import json

    from pyspark.sql.types import StructType

    from tidemark.sources.json_rescue import rescue_parse
    schema = StructType.fromDDL("customer_id long, age int, metadata struct<device: string, risk_score: double, deep: struct<a: int>>")
    lines = ['{"customer_id": 1, "age": 18.7}', '{"customer_id": 1e30}', '{"customer_id": 3, "metadata": {"risk_score": "abc", "device": "x"}}',
             '{"customer_id": 4, "metadata": {"newkey": [1], "deep": {"a": 5000000000, "b.c": 1}}, "metadata.newkey": 2}',
             '{"customer_id": 5, "metadata": "text"}', '{"customer_id": 9007199254740993, "age": 30, "metadata": {"device": "w", "risk_score": 1, "deep": null}}',
             '[1]', 'no json', '{"age": "41"}']
    got = rescue_parse(spark.createDataFrame([(x,) for x in lines], "value string"), schema).collect()
    rescued = [r["_rescued_data"] and json.loads(r["_rescued_data"]) for r in got]
    assert rescued == [{"age": 18.7}, {"customer_id": 1e30}, {"metadata.risk_score": "abc"},
                       {"metadata.newkey": [1], "metadata.deep.a": 5000000000, "metadata.deep.['b.c']": 1, "['metadata.newkey']": 2},
                       {"metadata": "text"}, None, None, None, {"age": "41"}]
    assert [r["_corrupt_record"] is not None for r in got] == [False] * 6 + [True, True, False]
    assert got[5]["customer_id"] == 9007199254740993 and got[5]["metadata"]["device"] == "w" and got[2]["metadata"]["device"] == "x"
    assert got[8]["age"] == 41 and got[4]["metadata"] is None


def test_ingest_without_schema_resumes_from_the_stored_one(spark, tmp):
    from tidemark.streaming.pipeline import ingest_json

    def land(lines, name):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(f"{tmp}/raw/{name}")

    def run():
        ingest_json(spark, f"{tmp}/raw/*", f"{tmp}/bronze", f"{tmp}/ck", pattern="*.txt", max_files=1)
    land(['{"customer_id": 1, "metadata": {"device": "x"}}'], "a")
    run()
    land(['{"customer_id": 2, "extra": true, "metadata": {"device": "y", "more": 1}}', '{"customer_id": "3"}'], "b")
    run()
    got = spark.read.parquet(f"{tmp}/bronze")
    assert "extra" not in got.columns                    # the first run's schema holds
    assert sorted((r["customer_id"], r["_rescued_data"]) for r in got.collect()) == [
        (1, None), (2, '{"extra":true,"metadata.more":1}'), (3, '{"customer_id":"3"}')]
