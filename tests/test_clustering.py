"""Space-filling clustering: ranks, layout and files touched against plain versions."""

import glob
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from tidemark.plans import queries as Q
from tidemark.sources import clustering as CL
from tidemark.sources import writers as W


def plain_bounds(values, slices):
    counts, before, out = Counter(v for v in values if v is not None), 0, {}
    total = sum(counts.values())
    for v in sorted(counts):
        out.setdefault(before * slices // total, v)
        before += counts[v]
    return [out[s] for s in sorted(out)]


@pytest.mark.parametrize("kind", ["long", "string"])
def test_ranks_equal_a_plain_version(spark, kind):
    rnd = random.Random(3)
    values = [None if rnd.random() < 0.05 else "Peru" if kind == "string" and rnd.random() < 0.4 else rnd.randrange(3000) for _ in range(4000)]
    values = [v if v is None or kind == "long" else str(v) for v in values]
    df = spark.createDataFrame([(v,) for v in values], f"`a.b` {kind}").repartition(7)
    bounds = CL.rank_bounds(df, "a.b", 6)
    want = plain_bounds(values, 64)
    assert bounds.first()["bounds"] == want
    got = CL.with_rank(df.crossJoin(F.broadcast(bounds)), F.col("`a.b`"), "bounds", "r", 6).select("`a.b`", "r")
    for v, r in got.distinct().collect():
        assert r == (0 if v is None else sum(b <= v for b in want) - 1)


def test_interleaving_takes_a_bit_of_each_in_turn(spark):
    df = spark.createDataFrame([(0b101, 0b011), (0, 0), (255, 255), (255, 0)], "a long, b long")
    got = [r[0] for r in df.select(CL.interleave([F.col("a"), F.col("b")])).collect()]
    assert got == [0b100111, 0, 65535, 0b1010101010101010]
    with pytest.raises(ValueError, match="do not fit"):
        CL.interleave([F.col("a")] * 8)


def plain_touched(path, column):
    files = [pq.read_table(f, columns=[column])[column].drop_null().to_pylist() for f in glob.glob(f"{path}/*.parquet")]
    spans = [(min(f), max(f)) for f in files if f]
    values = {v for f in files for v in f}
    return sum(a <= v <= b for v in values for a, b in spans), sum(len(set(f)) for f in files), len(values), len(spans)


def test_files_touched_equals_the_files_own_statistics(spark, tmp):
    lines = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    paths = {"linear": W.clustered_write(lines, f"{tmp}/linear", Q.LINE_CLUSTER, 32),
             "interleaved": CL.interleaved_write(lines, f"{tmp}/interleaved", Q.LINE_CLUSTER, 32)}
    touched = {}
    for layout, path in paths.items():
        for r in CL.files_touched(spark.read.parquet(path), Q.LINE_CLUSTER).collect():
            assert (r["touched"], r["needed"], r["filter_values"], r["files"]) == plain_touched(path.removeprefix("file:"), r["column_name"])
            touched[layout, r["column_name"]] = r["touched"]
    # the first column alone decides a linear layout; interleaved, the other columns skip files too
    for c in Q.LINE_CLUSTER[1:]:
        assert touched["interleaved", c] < 0.75 * touched["linear", c]


def test_interleaved_rows_are_whole_and_a_hot_value_is_split(spark, tmp):
    rows = [(i, "Peru" if i % 3 == 0 else f"c{i % 40}", None if i % 7 == 0 else i % 5, i) for i in range(6000)]
    df = spark.createDataFrame(rows, "id long, country string, status int, __key long")
    path = CL.interleaved_write(df, f"{tmp}/hot", ["country", "status"], 12)
    back = spark.read.parquet(path)
    assert sorted(map(tuple, back.collect()), key=lambda r: r[0]) == rows
    assert back.where("country = 'Peru' AND status = 1").select(F.input_file_name()).distinct().count() >= 1
    assert back.where("country = 'Peru'").select(F.input_file_name()).distinct().count() >= 3


def test_empty_table_and_column_of_nulls(spark, tmp):
    none = spark.createDataFrame([], "a long, b string")
    assert CL.interleaved(none, ["a", "b"], 4).count() == 0
    nulls = spark.createDataFrame([(None, "x"), (None, None)], "a long, b string")
    path = CL.interleaved_write(nulls, f"{tmp}/nulls", ["a", "b"], 2)
    assert sorted(map(str, spark.read.parquet(path).collect())) == sorted(map(str, nulls.collect()))
    got = {r["column_name"]: (r["filter_values"], r["touched"]) for r in CL.files_touched(spark.read.parquet(path), ["a", "b"]).collect()}
    assert got == {"a": (0, 0), "b": (1, 1)}
