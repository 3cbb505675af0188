"""Row-level expectations with fail / drop / warn actions (Q1-Q3).

All rules of a table are measured in one aggregate pass (partial aggregation,
one row per task shuffled). Counting is three-valued: a predicate that is
NULL is neither passed nor failed for a warn rule, and is a violation for drop
and fail rules (only TRUE passes).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

ACTIONS = ("fail", "drop", "warn")


@dataclass(frozen=True)
class Expectation:
    name: str
    predicate: str          # SQL boolean expression over the table's columns
    action: str = "warn"

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}")

    @property
    def column(self) -> Column:
        return F.expr(self.predicate)


def expect(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "warn")


def expect_or_drop(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "drop")


def expect_or_fail(name: str, predicate: str) -> Expectation:
    return Expectation(name, predicate, "fail")


class ExpectationFailed(RuntimeError):
    def __init__(self, failures: dict[str, int]):
        self.failures = failures
        super().__init__("expectation(s) failed: " + ", ".join(f"{k} ({v} rows)" for k, v in failures.items()))


METRIC_SCHEMA = ("rule_name string, action string, passed_records bigint, failed_records bigint, "
                 "unknown_records bigint, violations bigint")


def _metric_columns(rules: list[Expectation]) -> list[Column]:
    cols = []
    for i, r in enumerate(rules):
        p = r.column
        cols += [F.count_if(p).alias(f"p{i}"), F.count_if(~p).alias(f"f{i}"), F.count_if(p.isNull()).alias(f"u{i}")]
    return cols


def _metric_rows(agg: DataFrame, rules: list[Expectation]) -> DataFrame:
    structs = []
    for i, r in enumerate(rules):
        viol = F.col(f"f{i}") + (F.col(f"u{i}") if r.action in ("drop", "fail") else F.lit(0))
        structs.append(F.struct(F.lit(r.name).alias("rule_name"), F.lit(r.action).alias("action"),
                                F.col(f"p{i}").alias("passed_records"), F.col(f"f{i}").alias("failed_records"),
                                F.col(f"u{i}").alias("unknown_records"), viol.cast("bigint").alias("violations")))
    return agg.select(F.inline(F.array(*structs)))


def expectation_metrics(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """One row per rule with passed / failed / unknown counts, in a single pass over ``df``."""
    return _metric_rows(df.agg(*_metric_columns(rules)), rules)


def passing(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Rows kept by the drop rules (a predicate must be TRUE to keep the row).

    A filter already discards rows whose predicate is NULL, so the predicates
    are used as they are -- which keeps them translatable into Parquet
    pushed filters."""
    for r in rules:
        if r.action == "drop":
            df = df.where(r.column)
    return df


def check_fail_rules(df: DataFrame, rules: list[Expectation]) -> dict[str, int]:
    """Count violations of the fail rules (one aggregate); returns the failing ones."""
    fails = [r for r in rules if r.action == "fail"]
    if not fails:
        return {}
    row = df.agg(*[F.count_if(~F.coalesce(r.column, F.lit(False))).alias(f"v{i}")
                   for i, r in enumerate(fails)]).first()
    return {r.name: row[f"v{i}"] for i, r in enumerate(fails) if row[f"v{i}"]}


def apply_expectations(df: DataFrame, rules: list[Expectation], raise_on_fail: bool = True):
    """Enforce rules on a batch: raise on fail rules, drop rows for drop rules.

    Returns ``(kept, metrics)``. Nothing is written when a fail rule fires, so a
    rerun after fixing the input processes the batch once.
    """
    if raise_on_fail:
        failures = check_fail_rules(df, rules)
        if failures:
            raise ExpectationFailed(failures)
    return passing(df, rules), expectation_metrics(df, rules)


def observed_write(df: DataFrame, rules: list[Expectation], write) -> DataFrame:
    """Write the rows kept by the drop rules with ``write(kept_df)`` and return the rule metrics,
    measured by ``observe`` in the same pass as the write (the metrics see every input row: the
    observation sits below the drop filters)."""
    obs = Observation("tidemark_expectations")
    kept = passing(df.observe(obs, *_metric_columns(rules)), rules)
    write(kept)
    values = obs.get
    spark = df.sparkSession
    rows = []
    for i, r in enumerate(rules):
        p, f, u = values[f"p{i}"], values[f"f{i}"], values[f"u{i}"]
        rows.append((r.name, r.action, p, f, u, f + (u if r.action in ("drop", "fail") else 0)))
    return spark.createDataFrame(rows, METRIC_SCHEMA)


def enforce_into(table, df: DataFrame, rules: list[Expectation]):
    """Batch enforcement in ONE pass over the input into a ``VersionedTable``.

    The kept rows are staged as the next version while the metrics are
    observed; the version is published only when no fail rule fired, so a
    failed run is never visible and a rerun starts clean. Returns
    ``(path, metrics)``; raises ``ExpectationFailed`` after staging otherwise.
    """
    staged = {}

    def write(kept):
        staged["version"], staged["path"] = table.stage(kept)
    metrics = observed_write(df, rules, write)
    failures = {r["rule_name"]: r["violations"] for r in metrics.collect()
                if r["action"] == "fail" and r["violations"]}
    if failures:
        raise ExpectationFailed(failures)
    return table.publish(staged["version"], staged["path"]), metrics


def fail_report(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Outcome of the fail rules as a table (rule, violations, outcome) without raising."""
    fails = [r for r in rules if r.action == "fail"]
    agg = df.agg(*[F.count_if(~F.coalesce(r.column, F.lit(False))).alias(f"v{i}") for i, r in enumerate(fails)])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(r.name).alias("rule_name"), F.col(f"v{i}").alias("violations"),
                 F.when(F.col(f"v{i}") > 0, F.lit("fail")).otherwise(F.lit("pass")).alias("outcome"))
        for i, r in enumerate(fails)])))
