"""Expectation suites over a DataFrame (Q4-Q14): one result row per rule, never raises.

Compilation: schema rules (column set, column type) are answered from the
schema with no job; all row and statistic rules become columns of ONE
aggregate; each uniqueness rule is one partial-aggregated group-by whose
result is summed to a single row. The one-row frames are joined into one
result row and unpivoted, so a suite costs one scan plus one group-by per
uniqueness rule, whatever the number of rules.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import materialize_checkpoint

RESULT_SCHEMA = ("rule_id int, expectation string, column_name string, success boolean, "
                 "element_count bigint, unexpected_count bigint, observed_value double")


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str | None = None
    args: dict = field(default_factory=dict)


def columns_match_set(columns: list[str], exact_match: bool = False) -> Rule:
    return Rule("expect_table_columns_to_match_set", None, {"columns": list(columns), "exact": exact_match})


def row_count_between(min_value=None, max_value=None) -> Rule:
    return Rule("expect_table_row_count_to_be_between", None, {"min": min_value, "max": max_value})


def not_null(column: str) -> Rule:
    return Rule("expect_column_values_to_not_be_null", column)


def unique(column: str) -> Rule:
    return Rule("expect_column_values_to_be_unique", column)


def between(column: str, min_value=None, max_value=None) -> Rule:
    return Rule("expect_column_values_to_be_between", column, {"min": min_value, "max": max_value})


def in_set(column: str, values: list) -> Rule:
    return Rule("expect_column_values_to_be_in_set", column, {"values": list(values)})


def match_regex(column: str, regex: str) -> Rule:
    return Rule("expect_column_values_to_match_regex", column, {"regex": regex})


def mean_between(column: str, min_value=None, max_value=None) -> Rule:
    return Rule("expect_column_mean_to_be_between", column, {"min": min_value, "max": max_value})


def stdev_between(column: str, min_value=None, max_value=None) -> Rule:
    return Rule("expect_column_stdev_to_be_between", column, {"min": min_value, "max": max_value})


def of_type(column: str, type_name: str) -> Rule:
    return Rule("expect_column_values_to_be_of_type", column, {"type": type_name})


def _in_range(c: Column, lo, hi) -> Column:
    cond = F.lit(True)
    if lo is not None:
        cond = cond & (c >= F.lit(lo))
    if hi is not None:
        cond = cond & (c <= F.lit(hi))
    return cond


def _unexpected(rule: Rule) -> Column | None:
    """Violation predicate of a row rule, NULL values ignored (except for not_null)."""
    c = F.col(rule.column)
    if rule.kind == "expect_column_values_to_not_be_null":
        return c.isNull()
    if rule.kind == "expect_column_values_to_be_between":
        # NaN compares as largest; count it as out of range
        bad = ~_in_range(c, rule.args["min"], rule.args["max"]) | F.isnan(c)
        return c.isNotNull() & bad
    if rule.kind == "expect_column_values_to_be_in_set":
        return c.isNotNull() & ~c.isin(*rule.args["values"])
    if rule.kind == "expect_column_values_to_match_regex":
        return c.isNotNull() & ~c.rlike(rule.args["regex"])
    return None


def _type_name(df: DataFrame, column: str) -> str | None:
    if column not in df.columns:
        return None
    return type(df.schema[column].dataType).__name__


NAMES = ["rule_id", "expectation", "column_name", "success", "element_count", "unexpected_count",
         "observed_value"]


def _row(*parts: Column) -> Column:
    return F.struct(*[p.alias(n) for p, n in zip(parts, NAMES)])


def validate(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Run a suite; returns one row per rule in ``RESULT_SCHEMA`` (rule ids start at 1).

    A suite with a uniqueness rule reads its input twice (rows, and counts by key): the columns that the rules
    name are stored once for that, so the input itself is computed once.
    """
    aggs: list[Column] = [F.count(F.lit(1)).alias("__n")]
    rows: list[Column] = []
    uniques: list[tuple[int, str]] = []
    for i, r in enumerate(rules, start=1):
        rid, kind, col = F.lit(i), F.lit(r.kind), F.lit(r.column).cast("string")
        n = F.col("__n")
        if r.kind == "expect_table_columns_to_match_set":
            expected = set(r.args["columns"])
            missing = len(expected - set(df.columns))
            extra = len(set(df.columns) - expected) if r.args["exact"] else 0
            ok = missing == 0 and extra == 0
            rows.append(_row(rid, kind, col, F.lit(ok), n, F.lit(missing + extra).cast("bigint"),
                                 F.lit(float(missing + extra))))
        elif r.kind == "expect_column_values_to_be_of_type":
            ok = _type_name(df, r.column) == r.args["type"]
            rows.append(_row(rid, kind, col, F.lit(ok), n, F.lit(0 if ok else 1).cast("bigint"),
                                 F.lit(1.0 if ok else 0.0)))
        elif r.kind == "expect_table_row_count_to_be_between":
            ok = _in_range(n, r.args["min"], r.args["max"])
            rows.append(_row(rid, kind, col, ok, n, F.lit(0).cast("bigint"), n.cast("double")))
        elif r.kind == "expect_column_values_to_be_unique":
            uniques.append((i, r.column))
            rows.append(_row(rid, kind, col, F.col(f"__u{i}") == 0, n, F.col(f"__u{i}"),
                                 F.col(f"__u{i}").cast("double")))
        elif r.kind in ("expect_column_mean_to_be_between", "expect_column_stdev_to_be_between"):
            fn = F.avg if r.kind.endswith("mean_to_be_between") else F.stddev_samp
            aggs.append(fn(F.col(r.column).cast("double")).alias(f"__s{i}"))
            s = F.col(f"__s{i}")
            ok = F.coalesce(_in_range(s, r.args["min"], r.args["max"]), F.lit(False))
            rows.append(_row(rid, kind, col, ok, n, F.lit(0).cast("bigint"), s))
        else:
            bad = _unexpected(r)
            if bad is None:
                raise ValueError(f"unknown rule kind {r.kind}")
            aggs.append(F.count_if(bad).alias(f"__v{i}"))
            v = F.col(f"__v{i}")
            rows.append(_row(rid, kind, col, v == 0, n, v, v.cast("double")))
    rows_of = df
    if uniques:
        rows_of = materialize_checkpoint(df.select(*sorted({r.column for r in rules if r.column in df.columns})))
    result = rows_of.agg(*aggs)
    for i, c in uniques:
        dup = (rows_of.where(F.col(c).isNotNull()).groupBy(c).count().where("count > 1")
               .agg(F.coalesce(F.sum("count"), F.lit(0)).cast("bigint").alias(f"__u{i}")))
        result = result.crossJoin(dup)          # one row x one row
    out = result.select(F.inline(F.array(*rows)))
    return out.select(F.col("rule_id").cast("int"), "expectation", "column_name",
                      F.col("success").cast("boolean"), F.col("element_count").cast("bigint"),
                      F.col("unexpected_count").cast("bigint"), F.col("observed_value").cast("double"))


def verdict(result: DataFrame) -> DataFrame:
    """One row: the AND of all rule outcomes, the rules run and the rules failed."""
    return result.agg(F.bool_and("success").alias("success"), F.count(F.lit(1)).alias("rules"),
                      F.count_if(~F.col("success")).alias("failed"))


def overall_success(result: DataFrame) -> bool:
    return bool(verdict(result).first()["success"])
