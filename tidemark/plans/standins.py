"""Reference-shaped inputs derived from the driver's TPC-H-like tables.

The toolkit's models work on customer records (one row per customer export).
The driver tables are mapped onto that shape so every model, test and mart runs
over the whole tables and grows with them:

* one order = one export of its customer: ``customer_id`` = ``o_custkey``,
  export stamp and registration date = ``o_orderdate``, ``export_id`` =
  ``o_orderkey`` (tie-break among equal stamps), KYC status from
  ``o_orderstatus`` (P pending, F verified, O rejected), risk score =
  ``floor(o_totalprice / 50) / 100`` (two decimals, some above 100); device and language from the order key;
* per-customer attributes: name, balance (``c_acctbal``, has negatives),
  country (``n_name``); age, e-mail (with the four malformed kinds) and account
  type are derived from the customer key by fixed modulo rules, so both engines
  compute identical values.

The SQL twins of these frames live in ``tidemark.plans.oracle``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.columns import validity_flags
from tidemark.operators.dedup import latest_per_key
from tidemark.sources.tables import read_table

# Fixed values of the stand-in mapping.
KYC_BY_ORDER_STATUS = {"P": "pending", "F": "verified", "O": "rejected"}
DEVICES = ["android", "ios", "web", "unknown"]
LANGUAGES = ["es", "en", "pt"]
ACCOUNT_TYPES = ["checking", "savings", "credit"]
EMAIL_DOMAIN = "example.com"


def _pick(key: Column, values: list[str]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.pmod(key, F.lit(len(values))) + 1).cast("int"))


def _email(custkey: Column, name: Column) -> Column:
    local = F.lower(F.regexp_replace(name, "#", "."))
    kind = custkey % 40
    return (F.when(kind == 1, F.concat(local, F.lit(EMAIL_DOMAIN)))                    # no @
            .when(kind == 2, F.concat(local, F.lit("@")))                              # no domain
            .when(kind == 3, F.concat(F.lit(" "), local, F.lit("@" + EMAIL_DOMAIN + " ")))  # spaces
            .when(kind == 4, F.concat(local, F.lit("@@" + EMAIL_DOMAIN)))              # double @
            .otherwise(F.concat(local, F.lit("@" + EMAIL_DOMAIN))))


def customer_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer with the per-customer fields of a record."""
    c = read_table(spark, sf_dir, "customer")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    # nation is the fixed 25-row TPC-H dimension; the planner broadcasts it from
    # its file size, no hint needed.
    j = c.join(n, c.c_nationkey == n.n_nationkey, "left")
    return j.select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        ((F.col("c_custkey") % 130) - 5).cast("bigint").alias("age"),
        F.col("n_name").alias("country"),
        _email(F.col("c_custkey"), F.col("c_name")).alias("email"),
        _pick(F.col("c_custkey"), ACCOUNT_TYPES).alias("account_type"),
        F.col("c_acctbal").alias("account_balance"),
    )


def order_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per order: the per-export fields of a record."""
    o = read_table(spark, sf_dir, "orders")
    kyc = F.create_map(*[F.lit(x) for kv in KYC_BY_ORDER_STATUS.items() for x in kv])
    return o.select(
        F.col("o_custkey").alias("customer_id"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss").alias("registration_date"),
        kyc[F.col("o_orderstatus")].alias("kyc_status"),
        _pick(F.col("o_orderkey"), DEVICES).alias("device"),
        _pick(F.col("o_orderkey"), LANGUAGES).alias("language_preference"),
        (F.floor(F.col("o_totalprice") / 50) / 100.0).alias("risk_score"),
        F.col("o_orderdate").alias("exported_at_utc_minus_5"),
        F.col("o_orderkey").alias("export_id"),
    )


BRONZE_COLUMNS = [
    "customer_id", "customer_name", "age", "country", "email", "registration_date",
    "account_type", "account_balance", "kyc_status", "device", "language_preference",
    "risk_score", "had_schema_drift", "is_valid_age", "is_valid_risk_score",
    "exported_at_utc_minus_5", "export_id",
]


def _finish(df: DataFrame) -> DataFrame:
    return df.select(
        *[c for c in BRONZE_COLUMNS if c not in ("had_schema_drift", "is_valid_age", "is_valid_risk_score")],
        F.lit(False).alias("had_schema_drift"),
        *validity_flags("age", "risk_score"),
    ).select(*BRONZE_COLUMNS)


def customer_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing table: every export (one row per order); an order without a customer keeps its row."""
    return _finish(order_exports(spark, sf_dir).join(customer_attributes(spark, sf_dir), "customer_id", "left"))


def bronze_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest export per customer, equal to ``latest_per_key(customer_exports(...))``.

    Customer attributes are constant per key, so the top-1 is taken on the
    orders alone (map-side partial top-1 before the shuffle) and the join then
    sees one row per customer on both sides: no hot key can reach the join.
    """
    latest = latest_per_key(order_exports(spark, sf_dir), "customer_id",
                            "exported_at_utc_minus_5", tiebreak="export_id")
    return _finish(latest.join(customer_attributes(spark, sf_dir), "customer_id", "left"))


def raw_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One raw customer record a customer with orders (the fault injector's columns): the latest export with
    the customer's attributes; notifications and address come from the order and customer keys."""
    b = bronze_standin(spark, sf_dir)
    k, c = F.col("export_id"), F.col("customer_id")
    octets = [k % 255 + 1, F.floor(k / 255) % 256, c % 256, F.floor(c / 256) % 256]
    return b.select(
        "customer_id", "customer_name", "age", "country", "email", "registration_date", "account_type", "account_balance",
        "kyc_status", "device", (k % 2 == 0).alias("notifications"), F.col("language_preference").alias("language"),
        F.concat_ws(".", *[o.cast("bigint").cast("string") for o in octets]).alias("last_login_ip"), "risk_score")


def service_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as (device, language) observations for the service dimension."""
    d = read_table(spark, sf_dir, "documents")
    return d.select(F.col("source").alias("device"), F.col("lang").alias("language_preference"))
