"""Files and bytes of tables against the file system's own."""

import glob
import os

import pyarrow.parquet as pq

import __spark_entry__ as E
from conftest import SF_SMALL
from tidemark.operators import ops as O
from tidemark.plans import queries as Q


def sizes(path):
    files = [path] if os.path.isfile(path) else glob.glob(f"{path}/**/*.parquet", recursive=True)
    return [os.path.getsize(f) for f in files]


def test_storage_of_the_driver_tables(spark):
    got = {r["table_name"]: r for r in Q.table_storage(spark, SF_SMALL).collect()}
    assert sorted(got) == sorted(O.DRIVER_TABLES)
    for name, r in got.items():
        path = f"{SF_SMALL}/{name}.parquet"
        own, read = sizes(path), pq.read_table(path)
        assert (r["file_count"], r["total_bytes"], r["largest_file_bytes"]) == (len(own), sum(own), max(own))
        assert (r["row_count"], r["column_count"]) == (read.num_rows, read.num_columns)
        assert abs(r["bytes_a_row"] - sum(own) / read.num_rows) < 1e-9


def test_storage_of_folders(spark, tmp):
    """Partitioned folders are listed to the bottom; other files don't count; no file gives zeros."""
    spark.range(500).selectExpr("id", "id % 3 AS part").repartition(4).write.partitionBy("part").parquet(f"{tmp}/many")
    spark.range(9).write.csv(f"{tmp}/none")
    got = {r["table_name"]: tuple(r)[1:] for r in O.table_storage(spark, {"many": f"{tmp}/many", "none": f"{tmp}/none"}).collect()}
    own = sizes(f"{tmp}/many".removeprefix("file:"))
    assert len(own) == 12 and got == {"many": (12, sum(own), max(own)), "none": (0, 0, 0)}


def test_storage_reads_no_content(spark):
    plan = O.table_storage(spark, {"lineitem": f"{SF_SMALL}/lineitem.parquet"})._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


def test_file_queries_are_registered_without_sql():
    assert set(Q.FILE_QUERIES) == {"clustering_files", "table_storage"}
    assert not set(Q.FILE_QUERIES) & set(Q.QUERIES) and not set(Q.FILE_QUERIES) & set(E.oracle_sql())
    assert all(E.queries()[n] is f for n, f in Q.FILE_QUERIES.items())
