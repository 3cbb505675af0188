"""The star-schema model graph: bronze view -> dimensions, fact -> marts.

Each model is a function of DataFrames; nothing is materialised unless the
runner (``tidemark.plans.runner``) is asked to write it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import (date_dim_columns, extract_path, iso_to_date, month_start,
                                        risk_bucket, surrogate_key, validity_flags)
from tidemark.operators.dedup import latest_per_key

STAMP = "exported_at_utc_minus_5"

# metadata paths flattened by the bronze view: (output column, path, type)
METADATA_PATHS = [
    ("device", "device", "string"),
    ("language_preference", "preferences.language", "string"),
    ("notifications_enabled", "preferences.notifications", "boolean"),
    ("last_login_ip", "last_login_ip", "string"),
    ("risk_score", "risk_score", "double"),
]

DIM_CUSTOMER_COLUMNS = ["customer_id", "customer_name", "age", "country", "kyc_status", "email",
                        "is_valid_age", "had_schema_drift"]
FACT_COLUMNS = ["customer_id", "account_balance", "risk_score", "is_valid_risk_score",
                "registration_date", STAMP]


def flatten_metadata(landing: DataFrame, column: str = "metadata") -> DataFrame:
    """Flatten the nested payload (struct, VARIANT or JSON string) into typed columns."""
    if column not in landing.columns:
        return landing
    cols = [extract_path(landing, column, path, dtype).alias(name) for name, path, dtype in METADATA_PATHS]
    return landing.select(*[c for c in landing.columns if c != column], *cols)


def bronze_customers(landing: DataFrame, tiebreak: str | None = "export_id",
                     nulls_first: bool = False) -> DataFrame:
    """Latest export per customer from the append-only landing table.

    The nested payload is flattened, and the validity flags are computed when
    the landing table does not carry them (age 18-100, risk score 0-100, NULL
    stays NULL).
    """
    flat = flatten_metadata(landing)
    if "is_valid_age" not in flat.columns and {"age", "risk_score"} <= set(flat.columns):
        flat = flat.select("*", *validity_flags("age", "risk_score"))
    return latest_per_key(flat, "customer_id", STAMP,
                          tiebreak=tiebreak if tiebreak in landing.columns else None,
                          nulls_first=nulls_first)


def dim_customer(bronze: DataFrame) -> DataFrame:
    """Row-level DISTINCT over the customer attributes (as the reference: not keyed).

    The DISTINCT combines map-side; no user repartition stands before it, so AQE
    may still split or coalesce what it reads.
    """
    return bronze.select(*DIM_CUSTOMER_COLUMNS).distinct()


def dim_date(bronze: DataFrame, column: str = "registration_date") -> DataFrame:
    """Calendar rows for every distinct parseable date of ``column``."""
    d = iso_to_date(F.col(column))
    return (bronze.where(F.col(column).isNotNull()).select(d.alias("__d")).where("__d is not null")
            .select(*date_dim_columns(F.col("__d"))).distinct())


def dim_service(records: DataFrame) -> DataFrame:
    """Device x language dimension with an md5 surrogate key."""
    return (records.where(F.col("device").isNotNull())
            .select(surrogate_key("device", "language_preference").alias("device_id"),
                    F.col("device").alias("device_type"), "language_preference")
            .distinct())


def fact_customer_activity(bronze: DataFrame) -> DataFrame:
    return bronze.select(*FACT_COLUMNS)


def _money_sum(c: str) -> F.Column:
    # exact and order-independent to ten digits behind the point; an amount that doesn't fit is an error, not a null.
    # Rounding to cents is left to whoever shows the total
    return F.sum(F.col(c).cast("decimal(28,10)")).cast("decimal(38,10)")


def mart_balance_by_country(fact: DataFrame, dim_cust: DataFrame, dim_dt: DataFrame) -> DataFrame:
    """Gold mart per (country, year, month) of registration.

    fact and dim_customer meet on ``customer_id``; tables that the runner wrote
    bucketed on it join without an exchange, other frames are shuffled. The date
    dimension join is on a computed key; AQE turns it into a broadcast join once
    the (small, per-day) dimension stage has been measured, and keeps the shuffle
    join otherwise.
    """
    f = fact.select("customer_id", "account_balance", "risk_score",
                    iso_to_date("registration_date").alias("__reg"))
    d = dim_cust.select("customer_id", "country", "kyc_status")
    dt = dim_dt.select("date_id", "year", "month")
    j = f.join(d, "customer_id").join(dt, F.col("__reg") == F.col("date_id"))
    return j.groupBy("country", "year", "month").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.avg("account_balance").alias("avg_balance"),
        _money_sum("account_balance").alias("total_balance"),
        F.avg("risk_score").alias("avg_risk_score"),
        F.count_if(F.col("kyc_status") == "pending").alias("pending_kyc_count"),
        F.count_if(F.col("kyc_status") == "rejected").alias("rejected_kyc_count"),
    )


def mart_monthly(fact: DataFrame, dim_cust: DataFrame, date_column: str = "registration_date") -> DataFrame:
    """Month-truncated mart (the freshness-refreshed variant): per country and month start."""
    f = fact.select("customer_id", "account_balance", month_start(iso_to_date(date_column)).alias("month"))
    j = f.join(dim_cust.select("customer_id", "country"), "customer_id")
    return j.groupBy("country", "month").agg(
        F.count_distinct("customer_id").alias("total_customers"),
        F.avg("account_balance").alias("avg_balance"),
        _money_sum("account_balance").alias("total_balance"),
    )


def customers_risk_categorized(fact: DataFrame) -> DataFrame:
    """Risk procedure: bucket every fact row (table in, table out)."""
    return fact.select("customer_id", "account_balance", "risk_score",
                       risk_bucket("risk_score").alias("risk_category"))


def categorize_customer_risk(fact: DataFrame, path: str) -> str:
    """The risk procedure as a job: table in, bucketed table out (overwrite), and a message with the
    row count -- counted while writing, not by a second scan."""
    from pyspark.sql import Observation
    obs = Observation("risk_rows")
    customers_risk_categorized(fact).observe(obs, F.count(F.lit(1)).alias("rows")) \
        .write.mode("overwrite").parquet(path)
    return f"Categorized {obs.get['rows']} customers into risk buckets."
