"""Incremental merge, SCD2 (whole-log and stepwise), as-of, versioned tables, retention."""

import datetime as dt

from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.operators import ops as O

TS = "exported_at_utc_minus_5"
SCHEMA = f"customer_id long, kyc_status string, account_balance double, {TS} timestamp_ntz, export_id long"


def t(d):
    return dt.datetime(2024, 1, d)


def test_merge_first_run_takes_all_latest(spark):
    src = spark.createDataFrame([(1, "pending", 1.0, t(1), 1), (1, "verified", 2.0, t(2), 2),
                                 (2, "verified", 3.0, t(1), 3)], SCHEMA)
    out = {r[0]: r for r in H.incremental_merge(None, src, "customer_id", TS, "export_id").collect()}
    assert out[1]["kyc_status"] == "verified" and len(out) == 2


def test_merge_strict_high_water_mark(spark):
    target = spark.createDataFrame([(1, "pending", 1.0, t(5), 1)], SCHEMA)
    src = spark.createDataFrame([(1, "verified", 9.0, t(5), 2),      # equal stamp: skipped
                                 (2, "verified", 3.0, t(4), 3),      # older than the mark: skipped
                                 (3, "rejected", 4.0, t(6), 4)], SCHEMA)
    out = {r[0]: r for r in H.incremental_merge(target, src.select(*target.columns), "customer_id", TS,
                                                "export_id").collect()}
    assert out[1]["kyc_status"] == "pending" and 2 not in out and out[3]["kyc_status"] == "rejected"


def test_merge_into_versions_is_idempotent(spark, tmp):
    src = spark.createDataFrame([(1, "pending", 1.0, t(1), 1), (2, "verified", 2.0, t(2), 2)], SCHEMA)
    p1 = H.merge_into(spark, tmp, src, "customer_id", TS, "export_id")
    p2 = H.merge_into(spark, tmp, src, "customer_id", TS, "export_id")
    assert p1 != p2
    a = sorted(map(tuple, spark.read.parquet(p1).collect()))
    b = sorted(map(tuple, spark.read.parquet(p2).collect()))
    assert a == b
    assert H.VersionedTable(spark, tmp).current_path() == p2


def _brute_history(log_rows):
    """Reference semantics computed in plain Python."""
    by_key = {}
    for k, kyc, bal, ts, eid in log_rows:
        if ts is None:
            continue
        cur = by_key.setdefault(k, {})
        if ts not in cur or eid > cur[ts][2]:
            cur[ts] = (kyc, bal, eid)
    out = set()
    for k, versions in by_key.items():
        stamps = sorted(versions)
        for i, s in enumerate(stamps):
            nxt = stamps[i + 1] if i + 1 < len(stamps) else None
            out.add((k, versions[s][0], s, nxt))
    return out


def test_scd2_from_log_matches_brute_force_with_hot_key(spark):
    rows = []
    eid = 0
    base = dt.datetime(2024, 1, 1)
    for i in range(400):                   # a hot key spanning many day buckets, with equal stamps
        eid += 1
        rows.append((7, ["pending", "verified"][i % 2], float(i), base + dt.timedelta(hours=5 * (i // 2)), eid))
    for k in range(20):
        for j in range(3):
            eid += 1
            rows.append((k + 100, "verified", 1.0, base + dt.timedelta(days=j * 3), eid))
    rows.append((5, "pending", 1.0, None, 999))
    log = spark.createDataFrame(rows, SCHEMA)
    got = {(r["customer_id"], r["kyc_status"], r["dbt_valid_from"], r["dbt_valid_to"])
           for r in H.scd2_from_log(log, "customer_id", TS, ["kyc_status", "account_balance"], "export_id").collect()}
    assert got == _brute_history(rows)


def test_scd2_step_timestamp_strategy(spark):
    s1 = spark.createDataFrame([(1, "pending", 1.0, t(1)), (2, "verified", 1.0, t(1))],
                               f"customer_id long, kyc_status string, account_balance double, {TS} timestamp_ntz")
    h1 = H.scd2_step(None, s1, "customer_id", TS, ["kyc_status", "account_balance"])
    s2 = spark.createDataFrame([(1, "verified", 1.0, t(2)), (3, "pending", 1.0, t(2))], s1.schema)
    h2 = H.scd2_step(h1, s2, "customer_id", TS, ["kyc_status", "account_balance"])
    rows = sorted((r["customer_id"], r["kyc_status"], r["dbt_valid_from"], r["dbt_valid_to"]) for r in h2.collect())
    assert rows == [(1, "pending", t(1), t(2)), (1, "verified", t(2), None), (2, "verified", t(1), None),
                    (3, "pending", t(2), None)]
    # a rerun with the same snapshot changes nothing
    h3 = H.scd2_step(h2, s2, "customer_id", TS, ["kyc_status", "account_balance"])
    assert sorted(map(tuple, h3.collect())) == sorted(map(tuple, h2.collect()))
    # point-in-time lookup
    assert {r["kyc_status"] for r in H.as_of(h2, t(1)).where("customer_id = 1").collect()} == {"pending"}


def test_scd2_step_check_cols(spark):
    s1 = spark.createDataFrame([(1, "pending", t(1))], f"customer_id long, kyc_status string, {TS} timestamp_ntz")
    h1 = H.scd2_step(None, s1, "customer_id", TS, ["kyc_status"])
    s2 = spark.createDataFrame([(1, "pending", t(2))], s1.schema)
    h2 = H.scd2_step(h1, s2, "customer_id", TS, ["kyc_status"], check_cols=["kyc_status"])
    assert h2.count() == 1


def test_expired_versions_keeps_newest(spark):
    log = spark.createDataFrame([("a", 1, dt.datetime(2024, 1, 1)), ("a", 2, dt.datetime(2024, 1, 9)),
                                 ("b", 3, dt.datetime(2024, 1, 1))],
                                "table_name string, version long, committed_at timestamp_ntz")
    got = {r["version"]: r["expired"] for r in O.expired_versions(log, 168).collect()}
    assert got == {1: True, 2: False, 3: False}


def test_history_window_is_partition_invariant(spark):
    log = spark.range(2000).select(
        (F.col("id") % 3).alias("customer_id"), F.lit("x").alias("kyc_status"), F.lit(1.0).alias("account_balance"),
        (F.lit(dt.datetime(2024, 1, 1)) + F.make_interval(hours=F.col("id").cast("int"))).cast("timestamp_ntz")
        .alias(TS), F.col("id").alias("export_id"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    res = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        res.append(sorted(map(tuple, H.scd2_from_log(log, "customer_id", TS, ["kyc_status"], "export_id").collect())))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert res[0] == res[1]
    w = Window.partitionBy("customer_id").orderBy(TS)
    simple = log.select("customer_id", TS, F.lead(TS).over(w).alias("n"))
    assert sorted((r[0], r[1], r[2]) for r in simple.collect()) == sorted((r[0], r[2], r[6]) for r in res[0])


def test_null_stamp_order(spark):
    df = spark.createDataFrame([(1, None, 10), (1, t(2), 11), (2, None, 12)],
                               f"customer_id long, {TS} timestamp_ntz, export_id long")
    from tidemark.operators.dedup import first_per_key, latest_per_key
    default = {r[0]: r[2] for r in latest_per_key(df, "customer_id", TS, "export_id").collect()}
    assert default == {1: 11, 2: 12}                       # an unstamped row never wins over a stamped one
    host = {r[0]: r[2] for r in latest_per_key(df, "customer_id", TS, "export_id", nulls_first=True).collect()}
    assert host == {1: 10, 2: 12}                          # NULL as largest
    first = {r[0]: r[2] for r in first_per_key(df, "customer_id", TS, "export_id").collect()}
    assert first == {1: 11, 2: 12}


def test_scd2_from_log_check_cols_matches_brute_force(spark):
    base = dt.datetime(2024, 1, 1)
    rows, eid = [], 0
    statuses = ["pending", "pending", "verified", "verified", "verified", "pending", "rejected", "rejected"]
    for i in range(200):                                   # hot key over many day buckets
        eid += 1
        rows.append((7, statuses[i % len(statuses)], 1.0, base + dt.timedelta(hours=7 * i), eid))
    for k in range(10):
        for j, s in enumerate(["pending", "pending", "verified"]):
            eid += 1
            rows.append((100 + k, s, 1.0, base + dt.timedelta(days=2 * j), eid))
    log = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r["customer_id"], r["kyc_status"], r["dbt_valid_from"], r["dbt_valid_to"]) for r in
                 H.scd2_from_log(log, "customer_id", TS, ["kyc_status"], "export_id", check_cols=["kyc_status"]).collect())
    expect = []
    for k in sorted({r[0] for r in rows}):
        kr = sorted((r for r in rows if r[0] == k), key=lambda r: r[3])
        kept = [r for i, r in enumerate(kr) if i == 0 or r[1] != kr[i - 1][1]]
        for i, r in enumerate(kept):
            expect.append((k, r[1], r[3], kept[i + 1][3] if i + 1 < len(kept) else None))
    assert got == sorted(expect)


def test_generate_dirty_json_is_seeded_and_uniquely_named(spark, tmp):
    import datetime as _dt
    from tidemark.operators.faults import generate_dirty_json
    p1 = generate_dirty_json(spark, tmp, rows=300, seed=5, stamp=_dt.datetime(2024, 1, 1, 0, 0, 0))
    p2 = generate_dirty_json(spark, tmp, rows=300, seed=5, stamp=_dt.datetime(2024, 1, 1, 0, 0, 1))
    assert p1.endswith("raw_customers_20240101T000000.json") and p1 != p2
    a = sorted(r[0] for r in spark.read.text(p1).collect())
    b = sorted(r[0] for r in spark.read.text(p2).collect())
    assert a == b and len(a) >= 300
