"""Tables that keep state between runs: commits, copy-on-write, two-part history, signed deltas, key index, schema store."""

import collections
import datetime as dt
import json
import os
import random
import threading

import pytest
from pyspark.sql import functions as F

from tidemark.operators import history as H
from tidemark.operators import ops as O
from tidemark.operators import stores as ST
from tidemark.plans import runner as R
from tidemark.plans import standins as S
from tidemark.session import create_once, local_path
from tidemark.sources import json_rescue as J
from tidemark.sources.tables import SourceRegistry
from tidemark.streaming import pipeline as P
from tests.conftest import SF_SMALL

SCHEMA = "k long, v string, amount double, ts timestamp_ntz"


def day(d):
    return dt.datetime(2024, 1, 1) + dt.timedelta(days=d)


def files(folder):
    """Every data file below a folder with its time of writing."""
    out = {}
    for top, _, names in os.walk(local_path(folder)):
        out.update({os.path.join(top, n): os.stat(os.path.join(top, n)).st_mtime_ns for n in names if n.endswith(".parquet")})
    return out


def together(*jobs):
    """Run jobs at the same time; what each returned or raised."""
    out, start = [None] * len(jobs), threading.Barrier(len(jobs))

    def run(i, job):
        start.wait()
        try:
            out[i] = job()
        except Exception as e:
            out[i] = e
    threads = [threading.Thread(target=run, args=x) for x in enumerate(jobs)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    return out


# ---------------------------------------------------------------- commits

def test_one_of_many_writers_creates_the_entry(spark, tmp):
    for i in range(20):
        got = together(*[lambda j=j: create_once(spark, f"{tmp}/_log/{i}", f"{j}\n") for j in range(4)])
        assert sorted(got) == [False, False, False, True]


def test_racing_writers_of_one_version(spark, tmp):
    first, second = H.VersionedTable(spark, tmp), H.VersionedTable(spark, tmp)
    first.commit(spark.range(1))
    staged = [first.stage(spark.range(2)), second.stage(spark.range(3))]
    assert staged[0][0] == staged[1][0] == 1
    got = together(lambda: first.publish(*staged[0]), lambda: second.publish(*staged[1]))
    assert sum(isinstance(x, ST.CommitConflict) for x in got) == 1
    won = next(i for i, x in enumerate(got) if not isinstance(x, Exception))
    assert first.read().count() == won + 2 and first.log().count() == 2
    with pytest.raises(ST.CommitConflict):
        first.publish(0, "late")


def test_a_store_does_not_lose_a_racing_merge(spark, tmp):
    rows = lambda *r: spark.createDataFrame(list(r), SCHEMA)
    store = ST.KeyedStore(spark, tmp, "k", "ts")
    store.merge(rows((1, "a", 1.0, day(0))))
    merge = lambda v: ST.KeyedStore(spark, tmp, "k", "ts").merge(rows((1, v, 2.0, day(1))))
    got = together(lambda: merge("b"), lambda: merge("c"))
    # either the second started after the first's commit and found nothing newer, or it raised
    assert sum(isinstance(x, dict) for x in got) == 1 and all(x is None or isinstance(x, (dict, ST.CommitConflict)) for x in got)
    assert store.log.versions() == [0, 1]


def test_an_entry_being_written_is_no_version(spark, tmp):
    log = ST.CommitLog(spark, tmp)
    log.publish(0, path="x")
    with open(local_path(f"{log.path}/{1:012d}.json"), "w"):
        pass
    with pytest.raises(ST.CommitConflict):
        log.last()


# ---------------------------------------------------------------- keyed store

def test_merge_rewrites_only_buckets_of_changed_keys(spark, tmp):
    store = ST.KeyedStore(spark, tmp, "k", "ts", buckets=32)
    base = [(k, "old", float(k), day(k % 5)) for k in range(500)]
    one = store.merge(spark.createDataFrame(base, SCHEMA))
    before = files(tmp)
    new = [(7, "new", 1.0, day(9)), (7, "late", 1.0, day(8)), (300, "new", 2.0, day(9)), (9000, "added", 3.0, day(6)),
           (8, "equal to the mark", 0.0, day(4)), (9, "older", 0.0, day(1))]
    two = store.merge(spark.createDataFrame(new, SCHEMA))
    buckets = ST.Buckets(spark, tmp, "k", 32)
    touched, _ = buckets.of(spark.createDataFrame([(7,), (300,), (9000,)], "k long"))
    assert two["touched"] == touched and len(touched) <= 3 and two["source_hwm"] == day(9)
    assert {b for b in one["parts"] if one["parts"][b] != two["parts"].get(b)} <= set(map(str, touched))
    after = files(tmp)
    assert all(after[f] == t for f, t in before.items()) and len(after) - len(before) == len(touched)
    want = {k: (k, "old", float(k), day(k % 5)) for k in range(500)} | {7: (7, "new", 1.0, day(9)), 300: (300, "new", 2.0, day(9)), 9000: (9000, "added", 3.0, day(6))}
    assert sorted(map(tuple, store.read().collect())) == sorted(want.values())
    assert store.merge(spark.createDataFrame(new, SCHEMA)) is None          # nothing newer than the mark
    signs = collections.Counter((r["k"], r["v"], r["sign"]) for r in store.changes(two).collect())
    assert signs == {(7, "old", -1): 1, (7, "new", 1): 1, (300, "old", -1): 1, (300, "new", 1): 1, (9000, "added", 1): 1}


def test_merge_of_null_keys_and_empty_tables(spark, tmp):
    store = ST.KeyedStore(spark, tmp, "k", "ts", buckets=4)
    store.merge(spark.createDataFrame([], SCHEMA))
    assert store.read().count() == 0 and store.mark() is None
    store.merge(spark.createDataFrame([(None, "a", 1.0, day(0)), (1, "b", 1.0, day(0))], SCHEMA))
    store.merge(spark.createDataFrame([(None, "c", 1.0, day(1))], SCHEMA))
    assert sorted(r["v"] for r in store.read().collect()) == ["a", "b", "c"]    # a null key is never replaced


# ---------------------------------------------------------------- history in two parts

@pytest.mark.parametrize("check", [None, ["v"]])
def test_history_store_equals_steps_and_keeps_closed_files(spark, tmp, check):
    r = random.Random(3)
    store = ST.HistoryStore(spark, tmp, "k", "ts", ["v", "amount"], check_cols=check, buckets=8)
    plain, closed = None, {}
    for run in range(4):
        rows = [(r.choice([None, *range(12)]), r.choice("ab"), float(run), day(10 * run + r.randint(0, 9))) for _ in range(8)]
        rows = list({x[0]: x for x in rows}.values())                       # one row a key and run
        snap = spark.createDataFrame(rows, SCHEMA)
        entry = store.run(snap)
        plain = [tuple(x) for x in H.scd2_step(None if plain is None else spark.createDataFrame(plain, schema), snap, "k", "ts", ["v", "amount"], check_cols=check)
                 .select(*store.read().columns).collect()]
        schema = store.read().schema
        assert collections.Counter(map(tuple, store.read().collect())) == collections.Counter(plain)
        if entry:
            assert entry["closed"][:len(closed)] == list(closed)
            for path, had in closed.items():
                assert files(path) == had                                   # never written again
            closed = {p: files(p) for p in entry["closed"]}
            assert all(x["dbt_valid_to"] is None for x in store.open_versions().collect())
    assert store.run(snap) is None                                          # the same snapshot changes nothing


# ---------------------------------------------------------------- signed deltas

def test_delta_mart_equals_a_full_rebuild(spark, tmp):
    r = random.Random(5)
    schema = "id long, country string, month int, customer long, amount double, ts timestamp_ntz"
    mart = ST.DeltaMart(spark, tmp, "id", "ts", ["country", "month"], "customer", "amount", buckets=4)
    current = {}
    for run in range(4):
        rows = [(i, r.choice(["pe", "ec", None]), r.randint(1, 2), r.choice([None, *range(6)]), r.choice([None, 0.1, -2.25, 1e9 + 0.01]), day(run))
                for i in r.sample(range(40), 15)]
        df = spark.createDataFrame(rows, schema)
        current |= {x[0]: x for x in rows}
        if run == 2:                                                        # a refresh that died after its input's commit
            mart.input.merge(df.limit(0).unionByName(df), mart.input_columns)
        assert mart.refresh(df) is not None
        want = (spark.createDataFrame(list(current.values()), schema).groupBy("country", "month")
                .agg(F.count_distinct("customer").alias("n"), F.sum(F.col("amount").cast("decimal(28,10)")).alias("t"), F.avg("amount").alias("a")))
        got = {(x["country"], x["month"]): x for x in mart.read().collect()}
        want = {(x["country"], x["month"]): x for x in want.collect()}
        assert got.keys() == want.keys()
        for g, x in want.items():
            assert got[g]["n_distinct"] == x["n"] and got[g]["total"] == x["t"]
            assert got[g]["average"] == pytest.approx(x["a"]) if x["a"] is not None else got[g]["average"] is None
    assert mart.refresh(df) is None


def test_delta_mart_drops_groups_that_empty(spark, tmp):
    schema = "id long, g string, amount double, ts timestamp_ntz"
    mart = ST.DeltaMart(spark, tmp, "id", "ts", ["g"], "id", "amount", buckets=2)
    mart.refresh(spark.createDataFrame([(1, "a", 1.0, day(0)), (2, "b", 2.0, day(0))], schema))
    entry = mart.refresh(spark.createDataFrame([(1, "b", 5.0, day(1))], schema))
    assert [tuple(x)[:2] for x in mart.read().collect()] == [("b", 2)] and entry["touched"] != []


# ---------------------------------------------------------------- segmented scan, as-of join

def hot_log(spark, n=900):
    """One key with a third of the rows at daily stamps."""
    rows = [(7 if i % 3 == 0 else 100 + i, ["p", "q", "q"][i // 3 % 3], float(i), day(i // 3)) for i in range(n)]
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def test_hot_key_meets_several_tasks(spark):
    _, log = hot_log(spark)
    bounds = H.chunk_bounds(log, "k", "ts", chunk_rows=50, sample=1.0)
    assert [r["__key"] for r in bounds.collect()] == [7]
    sizes = [r["count"] for r in H.with_chunk(log, "k", "ts", bounds).where("k = 7").groupBy("__b").count().collect()]
    assert sum(sizes) == 300 and len(sizes) >= 6 and max(sizes) <= 60
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": "16"}
    old = {k: spark.conf.get(k) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        done = H.with_chunk(log, "k", "ts", bounds).withColumn("n", F.lead("ts").over(H.Window.partitionBy("k", "__b").orderBy("ts")))
        assert done.where("k = 7").select(F.spark_partition_id()).distinct().count() >= 3
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert H.chunk_bounds(log, "k", "ts", chunk_rows=1000, sample=1.0) is None


@pytest.mark.parametrize("check", [None, ["v"]])
def test_chunks_do_not_change_the_history(spark, check):
    _, log = hot_log(spark)
    whole = H.scd2_from_log(log, "k", "ts", ["v"], check_cols=check)
    cut = H.scd2_from_log(log, "k", "ts", ["v"], check_cols=check, chunk_rows=20, sample=1.0)
    assert sorted(map(repr, whole.collect())) == sorted(map(repr, cut.collect()))


@pytest.mark.parametrize("chunk_rows", [10, 10 ** 6])
def test_as_of_join_is_that_of_a_plain_search(spark, chunk_rows):
    rows, log = hot_log(spark, 300)
    history = H.scd2_from_log(log.where("ts <> TIMESTAMP_NTZ '2024-01-11 00:00:00'"), "k", "ts", ["v"])
    # a version that ends before the next begins
    history = history.withColumn("dbt_valid_to", F.when(F.col("ts") == F.lit(day(20)), F.lit(day(20) + dt.timedelta(hours=5))).otherwise(F.col("dbt_valid_to")))
    versions = [(x["k"], x["dbt_valid_from"], x["dbt_valid_to"], x["v"]) for x in history.collect()]
    r = random.Random(1)
    events = [(i, r.choice([7, 7, 7, 101, 5000, None]), r.choice([None, day(-1), *[day(r.randint(0, 105)) + dt.timedelta(hours=r.choice([0, 3, 6])) for _ in range(9)]]))
              for i in range(200)] + [(0, 7, day(3))] * 2
    got = H.as_of_join(spark.createDataFrame(events, "id long, k long, at timestamp_ntz"), history, "k", "at", ["v", "dbt_valid_from"],
                       chunk_rows=chunk_rows, sample=1.0)
    assert got.columns == ["id", "k", "at", "v", "dbt_valid_from"]

    def plain(k, at):
        found = [(f, v) for key, f, to, v in versions if key == k and at is not None and f <= at and (to is None or at < to)]
        return (found[0][1], found[0][0]) if found else (None, None)
    assert collections.Counter(map(tuple, got.collect())) == collections.Counter((i, k, at, *plain(k, at)) for i, k, at in events)


# ---------------------------------------------------------------- key index

def test_key_index_over_batches(spark, tmp, monkeypatch):
    monkeypatch.setattr(P, "KEY_FILES", 3)
    index = P.KeyIndex(spark, f"{tmp}/keys", "k", buckets=4)
    seen = set()
    r = random.Random(2)
    for batch_id in range(7):
        keys = {r.choice([None, *range(30)]) for _ in range(10)}
        batch = spark.createDataFrame([(k,) for k in keys], "k long")
        new = {x["k"] for x in index.unseen(batch, batch_id).collect()}
        assert new == keys - seen
        index.add(spark.createDataFrame([(k,) for k in new], "k long"), batch_id)
        index.add(batch, batch_id)                                          # a retry adds nothing
        assert {x["k"] for x in index.unseen(batch, batch_id).collect()} == new     # and sees what it saw
        seen |= keys
        assert max((len(p) for p in index.log.last()["parts"].values()), default=0) < 3
    # a batch reads the buckets of its own keys only
    one = spark.createDataFrame([(3,)], "k long")
    mine, _ = index.buckets.of(one)
    assert all(f"{ST.BUCKET}={mine[0]}" in f for f in index.unseen(one, 99).inputFiles())


def test_ordered_streams_never_read_their_sink(spark, tmp):
    schema = "k long, ts long"
    for i, rows in enumerate([[(1, 5), (1, 3), (2, 9)], [(1, 1), (3, 4)], [(2, 0), (3, 0), (4, 0)]]):
        spark.createDataFrame(rows, schema).write.mode("append").parquet(f"{tmp}/in")
        P.dedup_stream(spark, spark.readStream.schema(schema).parquet(f"{tmp}/in"), f"{tmp}/out{i}", f"{tmp}/ck", "k", order_by="ts")
    # each run wrote to a sink of its own, so only the index can have known the earlier keys
    assert [sorted(map(tuple, P.read_sink(spark, f"{tmp}/out{i}").collect())) for i in range(3)] == [[(1, 3), (2, 9)], [(3, 4)], [(4, 0)]]


# ---------------------------------------------------------------- schema store

def test_schema_grows_with_new_files(spark, tmp):
    def land(i, *lines):
        spark.createDataFrame([(x if isinstance(x, str) else json.dumps(x),) for x in lines], "value string").coalesce(1).write.text(f"{tmp}/raw/part{i}")

    def ingest():
        P.ingest_json(spark, f"{tmp}/raw/*", f"{tmp}/bronze", f"{tmp}/ck", pattern="*.txt", evolve=True)
    land(1, {"a": 1, "m": {"x": 1.5}}, {"a": 2, "s": "t"}, "broken {", "[1]")
    ingest()
    store = J.SchemaStore(spark, f"{tmp}/ck_schema")
    assert store.schema().simpleString() == "struct<a:bigint,m:struct<x:double>,s:string>"
    land(2, {"a": 2.5, "m": {"x": 2, "y": True}, "n": None}, {"a": "text", "s": 5})
    ingest()
    assert store.schema().simpleString() == "struct<a:bigint,m:struct<x:double,y:boolean>,s:string,n:string>"
    notes = {(x["version"], x["field"], x["change"], x["kept"]) for x in store.changes().collect() if x["version"] == 1}
    assert notes == {(1, "a", "kept", "bigint"), (1, "m.y", "added", None), (1, "n", "added", None)}
    got = spark.read.schema("a long, m struct<x: double, y: boolean>, s string, _rescued_data string, _corrupt_record string").parquet(f"{tmp}/bronze")
    rows = {(x["a"], x["s"], x["m"] and (x["m"]["x"], x["m"]["y"]), x["_rescued_data"], x["_corrupt_record"]) for x in got.collect()}
    assert rows == {(1, None, (1.5, None), None, None), (2, "t", None, None, None), (None, None, None, None, "broken {"), (None, None, None, None, "[1]"),
                    (2, None, (2.0, True), '{"a":2.5}', None), (None, "5", None, '{"a":"text"}', None)}
    ingest()
    assert store.log.versions() == [0, 1]                                   # nothing new, nothing changed


# ---------------------------------------------------------------- graph, publication, files

def test_incremental_graph_rewrites_touched_buckets(spark, tmp):
    landing = S.customer_exports(spark, SF_SMALL)
    newest = landing.agg(F.max(R.M.STAMP)).first()[0]
    reg = SourceRegistry()
    reg.register("raw.customers_raw", lambda: landing)
    one = R.run_models(spark, reg, R.customer_models(incremental=True), tmp)
    n, mart = one["fact_customer_activity"].count(), one["mart_balance_by_country"].count()
    before = files(f"{tmp}/fact_customer_activity")
    again = landing.where("customer_id IN (5, 8)").withColumn(R.M.STAMP, F.lit(newest + dt.timedelta(days=1))).withColumn("account_balance", F.lit(-1.0))
    more = landing.unionByName(again)
    reg.register("raw.customers_raw", lambda: more)
    two = R.run_models(spark, reg, R.customer_models(incremental=True), tmp)
    fact = ST.KeyedStore(spark, f"{tmp}/fact_customer_activity", "customer_id", R.M.STAMP).log.last()
    changed = again.select("customer_id").distinct().count()
    assert len(fact["touched"]) <= changed and len(files(f"{tmp}/fact_customer_activity")) == len(before) + len(fact["touched"])
    assert two["fact_customer_activity"].count() == n and two["fact_customer_activity"].where("account_balance = -1").count() == changed
    assert two["mart_balance_by_country"].count() >= mart - 2
    kyc = two["customer_kyc_snapshot"]
    assert kyc.where("dbt_valid_to IS NOT NULL").count() == changed and kyc.where("dbt_valid_to IS NULL").count() == n


def test_published_dimension_is_masked_until_a_role_is_set(spark):
    dim = spark.createDataFrame([(1, "ab@x.org"), (2, "no at"), (3, None)], "customer_id long, email string")
    name = R.publish_masked(spark, dim, "dim_test_published")
    spark.sql(f"SET VAR {R.ROLE_VARIABLE} = DEFAULT")
    masked = [(1, "***@x.org"), (2, "***"), (3, None)]
    assert sorted(map(tuple, spark.table(name).collect())) == masked
    engineer, analyst = R.read_as(spark, name, "engineer_role"), R.read_as(spark, name, "ANALYST_ROLE")
    assert sorted(map(tuple, analyst.collect())) == masked
    assert sorted(map(tuple, engineer.collect())) == [(1, "ab@x.org"), (2, "no at"), (3, None)]
    R.read_as(spark, name, "")
    R.publish_masked(spark, dim, "dim_test_published")
    assert sorted(map(tuple, spark.table(name).collect())) == masked


def test_files_no_version_names(spark, tmp):
    store = ST.KeyedStore(spark, tmp, "k", "ts", buckets=2)
    one = store.merge(spark.createDataFrame([(i, "a", 1.0, day(0)) for i in range(20)], SCHEMA))
    two = store.merge(spark.createDataFrame([(1, "b", 1.0, day(1))], SCHEMA))
    ST.Buckets(spark, tmp, "k", 2).write(spark.range(4).withColumnRenamed("id", "k"))       # a writer that died before its commit
    found = collections.Counter(r["live"] for r in O.unreferenced_files(spark, tmp, [two]).collect())
    assert found == {True: 2, False: 1 + 2}
    found = collections.Counter(r["live"] for r in O.unreferenced_files(spark, tmp, [one, two]).collect())
    assert found == {True: 3, False: 2}
