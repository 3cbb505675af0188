"""Model tests: queries returning violating rows, with severity and a build gate (Q15-Q21).

Each test builder returns a DataFrame of violations (empty = pass). Tests that
group (unique, relationships) pre-aggregate per key before any join, so a key
holding a third of the rows is one row after the map-side partial aggregate.
"""

from __future__ import annotations

from dataclasses import dataclass
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F



def unique_violations(df: DataFrame, columns: str | list[str]) -> DataFrame:
    """Key values seen more than once (rows with a NULL key part ignored): key columns + ``n_records``.

    Partial aggregation counts per key before the shuffle, so a hot key costs
    one row per map task."""
    cols = [columns] if isinstance(columns, str) else list(columns)
    nn = F.lit(True)
    for c in cols:
        nn = nn & F.col(c).isNotNull()
    return (df.where(nn).groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
            .where("n_records > 1"))


def not_null_violations(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def between_violations(df: DataFrame, column: str, min_value=None, max_value=None) -> DataFrame:
    """Rows where ``min <= col <= max`` is not TRUE-or-NULL (``not(expr = true)`` with NULL passing)."""
    cond = F.lit(True)
    if min_value is not None:
        cond = cond & (F.col(column) >= min_value)
    if max_value is not None:
        cond = cond & (F.col(column) <= max_value)
    return df.where(~cond)


def relationship_orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child keys without a parent row: ``from_field, n_records`` (child NULL keys excluded).

    The child side is reduced to one row per key before the anti join, so the
    join shuffles distinct keys only and cannot be skewed by a hot child key.
    """
    keys = (child.where(F.col(child_key).isNotNull()).groupBy(F.col(child_key).alias("from_field"))
            .agg(F.count(F.lit(1)).alias("n_records")))
    parents = parent.select(F.col(parent_key).alias("from_field")).where("from_field is not null")
    return keys.join(parents, "from_field", "left_anti")


def limit_breaches(fact: DataFrame, dim_customer: DataFrame, limits: DataFrame) -> DataFrame:
    """Balances above the country limit (NULL country never matches; reaching the limit is allowed)."""
    j = (fact.select("customer_id", "account_balance")
         .join(dim_customer.select("customer_id", "country"), "customer_id")
         .join(limits.select("country", "max_balance_limit"), "country"))
    return j.where(F.col("account_balance") > F.col("max_balance_limit")).select(
        "customer_id", "account_balance", "country", "max_balance_limit")


def row_loss_check(bronze: DataFrame, fact: DataFrame, key: str = "customer_id", ratio: float = 0.9) -> DataFrame:
    """One row: distinct bronze keys, fact rows, and whether the fact lost too many rows."""
    b = bronze.agg(F.count_distinct(key).alias("bronze_distinct_customers"))
    f = fact.agg(F.count(F.lit(1)).alias("fact_rows"))
    j = b.crossJoin(f)                     # one row x one row
    return j.withColumn("failed", F.col("fact_rows") < F.col("bronze_distinct_customers") * ratio)


def row_loss_violations(bronze: DataFrame, fact: DataFrame, key: str = "customer_id", ratio: float = 0.9) -> DataFrame:
    return row_loss_check(bronze, fact, key, ratio).where("failed").drop("failed")


@dataclass(frozen=True)
class DataTest:
    name: str
    severity: str                          # "error" | "warn"
    build: Callable[[], DataFrame]


class TestsFailed(RuntimeError):
    pass


def run_tests(tests: list[DataTest]) -> DataFrame:
    """Report ``test_name, severity, failures, status`` for all tests in one job (union of counts)."""
    parts = [t.build().agg(F.count(F.lit(1)).alias("failures"))
             .select(F.lit(t.name).alias("test_name"), F.lit(t.severity).alias("severity"), "failures")
             for t in tests]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    status = (F.when(F.col("failures") == 0, F.lit("pass"))
              .when(F.col("severity") == "error", F.lit("fail")).otherwise(F.lit("warn")))
    return out.withColumn("status", status)


def gate(report: DataFrame) -> None:
    """Raise when any ``error`` test fails; ``warn`` tests only report."""
    failing = [r["test_name"] for r in report.where("status = 'fail'").select("test_name").collect()]
    if failing:
        raise TestsFailed("failing tests: " + ", ".join(sorted(failing)))
