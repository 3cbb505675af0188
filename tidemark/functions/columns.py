"""Scalar column functions: drift repair, casts, JSON paths, dates, keys, masking, bucketing."""

from __future__ import annotations

import functools
import operator
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

__all__ = [
    "coalesce_renamed", "drift_flag", "drop_present", "to_double", "extract_path",
    "risk_bucket", "validity_flags", "export_stamp", "stamp_token", "mask_email",
    "surrogate_key", "date_dim_columns", "iso_to_date", "month_start", "hash_uniform",
    "SURROGATE_NULL_TOKEN", "PRIVILEGED_ROLES",
]

# Placeholder for NULL parts of a surrogate key, so keys match
# those produced by the warehouse macro; roles that see e-mails unmasked.
SURROGATE_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
PRIVILEGED_ROLES = ("ACCOUNTADMIN", "ENGINEER_ROLE")


# ---------------------------------------------------------------- drift

def coalesce_renamed(df: DataFrame, target: str, *old_names: str, rescued: str = "_rescued_data") -> DataFrame:
    """Fold renamed copies of a column back into ``target`` (first non-null wins).

    Adaptive: a renamed name is read from its own column when the frame has one,
    else from the rescued-data JSON when present (a fixed schema rescues unknown
    keys), else skipped. ``target`` is created when only a renamed copy exists.
    """
    parts = [F.col(target)] if target in df.columns else []
    for n in old_names:
        if n in df.columns:
            parts.append(F.col(n))
        elif rescued in df.columns:
            parts.append(F.get_json_object(F.col(rescued), "$." + n))
    if not parts:
        return df
    return df.withColumn(target, F.coalesce(*parts) if len(parts) > 1 else parts[0])


def drift_flag(df: DataFrame, markers: list[str], name: str = "had_schema_drift") -> DataFrame:
    """``name`` = any marker column present in the frame is non-null (False when none exist)."""
    conds = [F.col(m).isNotNull() for m in markers if m in df.columns]
    return df.withColumn(name, functools.reduce(operator.or_, conds, F.lit(False)))


def drop_present(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*[n for n in names if n in df.columns])


def to_double(c: str | Column) -> Column:
    """Lenient numeric cast: malformed or empty strings give NULL instead of failing (ANSI mode)."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("double")


def extract_path(df: DataFrame, column: str, path: str, dtype: str) -> Column:
    """Value at ``a.b.c`` inside a struct, VARIANT or JSON-string column, cast to ``dtype``."""
    dt = df.schema[column].dataType
    if isinstance(dt, T.StructType):
        c = F.col(column)
        for part in path.split("."):
            c = c.getField(part)
        return c.try_cast(dtype)
    if isinstance(dt, T.VariantType):
        return F.try_variant_get(F.col(column), "$." + path, dtype)
    return F.get_json_object(F.col(column), "$." + path).try_cast(dtype)


# ---------------------------------------------------------------- rules as columns

def risk_bucket(score: str | Column, high: float = 70, medium: float = 40) -> Column:
    """``high_risk`` at or above ``high``, ``medium_risk`` at or above ``medium``,
    ``low_risk`` otherwise -- NULL and negative scores included."""
    s = F.col(score) if isinstance(score, str) else score
    return (F.when(s >= high, F.lit("high_risk"))
            .when(s >= medium, F.lit("medium_risk"))
            .otherwise(F.lit("low_risk")))


def validity_flags(age: str | Column = "age", risk: str | Column = "risk_score",
                   age_range=(18, 100), risk_range=(0, 100)) -> list[Column]:
    """``is_valid_age`` and ``is_valid_risk_score``; NULL input stays NULL, NaN is invalid."""
    a = F.col(age) if isinstance(age, str) else age
    r = F.col(risk) if isinstance(risk, str) else risk
    ra = r.between(*risk_range) & ~F.isnan(r)
    return [a.between(*age_range).alias("is_valid_age"),
            F.when(r.isNotNull(), ra).alias("is_valid_risk_score")]


def export_stamp(instant: datetime | str | None = None, zone: str = "Etc/GMT+5",
                 session_zone: str = "UTC") -> Column:
    """Batch stamp as wall-clock time in ``zone`` (``Etc/GMT+5`` is UTC-5), type timestamp_ntz.

    ``instant`` is a UTC wall-clock time (string or naive datetime); pass it to
    make reruns reproducible. ``None`` uses ``current_timestamp()``, read as
    wall clock in ``session_zone`` (pass the session's
    ``spark.sql.session.timeZone``). The result does not depend on the session
    time zone.
    """
    if instant is None:
        return F.convert_timezone(F.lit(session_zone), F.lit(zone), F.current_timestamp().cast("timestamp_ntz"))
    text = instant if isinstance(instant, str) else instant.strftime("%Y-%m-%d %H:%M:%S")
    return F.convert_timezone(F.lit("UTC"), F.lit(zone), F.lit(text).cast("timestamp_ntz"))


def stamp_token(stamp: Column) -> Column:
    """``yyyyMMdd_HHmmss`` path token of a stamp."""
    return F.date_format(stamp, "yyyyMMdd_HHmmss")


def mask_email(value: str | Column, role: str, privileged=PRIVILEGED_ROLES, strict: bool = True) -> Column:
    """Role-based masking: privileged roles see the value; others see ``***@domain``.

    A value without ``@`` is masked entirely; ``strict=False`` leaves it as is
    (warehouse policy behaviour).
    """
    v = F.col(value) if isinstance(value, str) else value
    masked = F.regexp_replace(v, r"^.*(?=@)", "***")
    if strict:
        masked = F.when(v.contains("@"), masked).otherwise(F.when(v.isNotNull(), F.lit("***")))
    if role.upper() in {r.upper() for r in privileged}:
        return v
    return masked


def mask_email_function(name: str, privileged=PRIVILEGED_ROLES) -> str:
    """DDL of the masking policy as a SQL function of a value and a role, equal to ``mask_email``."""
    roles = ", ".join(f"'{r.upper()}'" for r in privileged)
    return (f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(value STRING, role STRING) RETURNS STRING RETURN "
            f"CASE WHEN upper(role) IN ({roles}) THEN value WHEN contains(value, '@') THEN regexp_replace(value, '^.*(?=@)', '***') "
            "WHEN value IS NOT NULL THEN '***' END")


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the parts cast to string, NULL replaced by a token, joined with ``-``."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(SURROGATE_NULL_TOKEN))
             for c in cols]
    return F.md5(F.concat_ws("-", *parts))


# ---------------------------------------------------------------- dates

def iso_to_date(c: str | Column) -> Column:
    """ISO-8601 date or date-time string to DATE; unparsable gives NULL."""
    return (F.col(c) if isinstance(c, str) else c).try_cast("date")


def date_dim_columns(d: Column) -> list[Column]:
    """Calendar attributes of a DATE: ids, parts, Sunday-based weekday (0-6), 3-letter month."""
    return [
        d.alias("date_id"),
        d.alias("full_date"),
        F.year(d).alias("year"),
        F.month(d).alias("month"),
        F.dayofmonth(d).alias("day"),
        (F.dayofweek(d) - 1).alias("day_of_week"),
        F.date_format(d, "MMM").alias("month_name"),
    ]


def month_start(c: str | Column) -> Column:
    """First day of the month as DATE (``date_trunc`` returns a timestamp)."""
    return F.date_trunc("month", F.col(c) if isinstance(c, str) else c).cast("date")


# ---------------------------------------------------------------- reproducible randomness

def hash_uniform(seed: int | str, salt: str, *keys: str | Column) -> Column:
    """Uniform [0, 1) from md5(seed|salt|keys): same value on any partitioning and any engine
    that has md5 (first 32 bits of the digest / 2^32)."""
    parts = [F.lit(str(seed)), F.lit(salt)] + [(F.col(k) if isinstance(k, str) else k).cast("string") for k in keys]
    h = F.substring(F.md5(F.concat_ws("|", *parts)), 1, 8)
    return F.conv(h, 16, 10).cast("bigint") / F.lit(4294967296.0)
