"""Distributed, seedable injection of dirty data.

Every random draw is ``hash_uniform(seed, salt, key, copy)``: a pure function of
the row, so results are identical on any partitioning, after a lost executor
is recomputed, and in any engine with md5. No driver loop, no shuffle except
the optional output shuffle (W3).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.columns import hash_uniform

# Fixed values of the clean record factory and the fault catalogue.
COUNTRIES = ["Peru", "Chile", "Colombia", "Mexico", "Argentina", "Brazil", "Spain"]
DEVICES = ["android", "ios", "web", "unknown"]
LANGUAGES = ["es", "en", "pt"]
ACCOUNT_TYPES = ["checking", "savings", "credit"]
EMAIL_DOMAINS = ["gmail.com", "hotmail.com", "yahoo.com"]
NULLABLE_FIELDS = ["customer_name", "age", "country", "email"]
INVALID_AGES = [-5, 0, 150, 999, 15]
EMAIL_FAULTS = ["no_at", "no_domain", "spaces", "double_at"]
DRIFT_KINDS = ["rename_field", "extra_field", "type_change"]
INVALID_BALANCES = [-500.0, -99999.99, 999999999.99]
KYC_VIOLATION_STATUSES = ["pending", "rejected"]
INVALID_RISK_SCORES = [-10.0, 150.0, 999.0]
REGISTRATION_START = "2022-01-01"
REGISTRATION_DAYS = 1200
KYC_WEIGHTS = (0.10, 0.85, 0.05)   # pending, verified, rejected


@dataclass(frozen=True)
class FaultRates:
    null: float = 0.05
    duplicate: float = 0.03
    invalid_age: float = 0.03
    malformed_email: float = 0.03
    schema_drift: float = 0.02
    invalid_balance: float = 0.03
    kyc_violation: float = 0.04
    invalid_risk_score: float = 0.03


RECORD_COLUMNS = ["customer_id", "customer_name", "age", "country", "email", "registration_date",
                  "account_type", "account_balance", "balance_is_text", "kyc_status", "device",
                  "notifications", "language", "last_login_ip", "risk_score", "drift_kind", "copy_id"]
CLEAN_COLUMNS = [c for c in RECORD_COLUMNS if c not in ("balance_is_text", "drift_kind", "copy_id")]


def _choice(u: Column, values: list) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.floor(u * len(values)) + 1).cast("int"))


def _letters(seed: int, salt: str, key: Column) -> Column:
    """Eight lowercase letters drawn from md5(seed|salt|key)."""
    return F.translate(F.substring(F.md5(F.concat_ws("|", F.lit(str(seed)), F.lit(salt), key.cast("string"))), 1, 8),
                       "0123456789abcdef", "abcdefghijklmnop")


def clean_records(keys: DataFrame, key: str, seed: int = 42) -> DataFrame:
    """One clean customer record per input key (e.g. ``spark.range(n)`` or a customer table)."""
    def u(salt):
        return hash_uniform(seed, salt, F.col("__k"))
    local = _letters(seed, "email", F.col("__k"))
    reg = F.date_add(F.lit(REGISTRATION_START).cast("date"), F.floor(u("reg") * (REGISTRATION_DAYS + 1)).cast("int"))
    kyc = (F.when(u("kyc") < KYC_WEIGHTS[0], F.lit("pending"))
           .when(u("kyc") < KYC_WEIGHTS[0] + KYC_WEIGHTS[1], F.lit("verified"))
           .otherwise(F.lit("rejected")))
    ip = F.concat_ws(".", *[(F.floor(u(f"ip{i}") * (255 if i == 1 else 256)) + (1 if i == 1 else 0)).cast("string")
                           for i in range(1, 5)])
    return keys.select(F.col(key).cast("bigint").alias("__k")).select(
        F.col("__k").alias("customer_id"),
        F.concat(F.lit("Customer_"), F.col("__k").cast("string")).alias("customer_name"),
        (F.floor(u("age") * 58) + 18).cast("bigint").alias("age"),
        _choice(u("country"), COUNTRIES).alias("country"),
        F.concat_ws("@", local, _choice(u("domain"), EMAIL_DOMAINS)).alias("email"),
        F.date_format(reg, "yyyy-MM-dd'T'00:00:00").alias("registration_date"),
        _choice(u("acct"), ACCOUNT_TYPES).alias("account_type"),
        (F.floor(u("bal") * 5000001) / 100.0).alias("account_balance"),
        kyc.alias("kyc_status"),
        _choice(u("device"), DEVICES).alias("device"),
        (u("notif") < 0.5).alias("notifications"),
        _choice(u("lang"), LANGUAGES).alias("language"),
        ip.alias("last_login_ip"),
        (F.floor(u("risk") * 10001) / 100.0).alias("risk_score"),
    ).select(*CLEAN_COLUMNS)


def inject_faults(records: DataFrame, seed: int = 42, rates: FaultRates = FaultRates()) -> DataFrame:
    """G1-G8 applied in order (later faults overwrite earlier ones as in the reference);
    G8 adds exact copies with ``copy_id = 1``."""
    def u(salt):
        return hash_uniform(seed, salt, F.col("customer_id"))
    df = records
    # G1 null one field
    hit = u("null") < rates.null
    which = _choice(u("null_field"), NULLABLE_FIELDS)
    for f in NULLABLE_FIELDS:
        df = df.withColumn(f, F.when(hit & (which == f), F.lit(None).cast(df.schema[f].dataType)).otherwise(F.col(f)))
    # G2 invalid age (overwrites a NULL age)
    df = df.withColumn("age", F.when(u("bad_age") < rates.invalid_age,
                                     _choice(u("bad_age_pick"), INVALID_AGES).cast("bigint")).otherwise(F.col("age")))
    # G3 malformed e-mail (overwrites a NULL e-mail)
    kind = _choice(u("bad_email_pick"), EMAIL_FAULTS)
    local, domain = _letters(seed, "bad_email_local", F.col("customer_id")), _choice(u("bad_email_domain"), EMAIL_DOMAINS)
    bad = (F.when(kind == "no_at", F.concat(local, domain))
           .when(kind == "no_domain", F.concat(local, F.lit("@")))
           .when(kind == "spaces", F.concat(F.lit(" "), local, F.lit("@"), domain, F.lit(" ")))
           .otherwise(F.concat(local, F.lit("@@"), domain)))
    df = df.withColumn("email", F.when(u("bad_email") < rates.malformed_email, bad).otherwise(F.col("email")))
    # G4 schema drift
    drift = F.when(u("drift") < rates.schema_drift, _choice(u("drift_pick"), DRIFT_KINDS))
    df = df.withColumn("drift_kind", drift)
    # G5 invalid balance, G6 KYC violation (both replace a text balance with a number)
    g5 = u("bad_bal") < rates.invalid_balance
    g6 = u("kyc_viol") < rates.kyc_violation
    df = df.withColumn("account_balance", F.when(g5, _choice(u("bad_bal_pick"), INVALID_BALANCES))
                       .otherwise(F.col("account_balance")))
    df = (df.withColumn("kyc_status", F.when(g6, _choice(u("kyc_pick"), KYC_VIOLATION_STATUSES))
                        .otherwise(F.col("kyc_status")))
            .withColumn("account_balance", F.when(g6, F.floor(u("kyc_bal") * 1990001) / 100.0 + 100)
                        .otherwise(F.col("account_balance"))))
    df = df.withColumn("balance_is_text", F.coalesce(F.col("drift_kind") == "type_change", F.lit(False)) & ~g5 & ~g6)
    # G7 invalid risk score
    df = df.withColumn("risk_score", F.when(u("bad_risk") < rates.invalid_risk_score,
                                            _choice(u("bad_risk_pick"), INVALID_RISK_SCORES))
                       .otherwise(F.col("risk_score")))
    # G8 exact duplicates: each row is emitted once, or twice when drawn (one pass, no union)
    copies = F.when(u("dup") < rates.duplicate, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    df = df.withColumn("copy_id", F.explode(copies))
    return df.select(*RECORD_COLUMNS)


def shuffled(df: DataFrame, seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Reproducible random order: rows hash-partitioned on a seeded row hash and sorted by it
    inside each partition (no range sampling, no global sort)."""
    h = F.xxhash64(F.lit(seed), *[F.col(c) for c in ("customer_id", "copy_id")])
    n = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, h).sortWithinPartitions(h)


def to_json_lines(df: DataFrame) -> DataFrame:
    """Render records as the generator's JSON lines (column ``value``).

    Drift is rendered as in the source system: a renamed ``customerName`` key,
    an extra ``experimental_flag`` key, or ``account_balance`` as a JSON string.
    NULL fields are omitted.
    """
    rename = F.col("drift_kind") == "rename_field"
    text = F.col("balance_is_text")
    meta = F.struct(F.col("device").alias("device"),
                    F.struct(F.col("notifications").alias("notifications"),
                             F.col("language").alias("language")).alias("preferences"),
                    F.col("last_login_ip").alias("last_login_ip"),
                    F.col("risk_score").alias("risk_score"))
    s = F.struct(
        F.col("customer_id").alias("customer_id"),
        F.when(~F.coalesce(rename, F.lit(False)), F.col("customer_name")).alias("customer_name"),
        F.col("age").alias("age"), F.col("country").alias("country"), F.col("email").alias("email"),
        F.col("registration_date").alias("registration_date"), F.col("account_type").alias("account_type"),
        F.when(~text, F.col("account_balance")).alias("account_balance"),
        F.when(text, F.col("account_balance").cast("string")).alias("account_balance__text"),
        F.col("kyc_status").alias("kyc_status"), meta.alias("metadata"),
        F.when(rename, F.col("customer_name")).alias("customerName"),
        F.when(F.col("drift_kind") == "extra_field", F.lit(True)).alias("experimental_flag"),
    )
    return df.select(F.regexp_replace(F.to_json(s), '"account_balance__text":', '"account_balance":').alias("value"))


def generate_dirty_json(spark, out_dir: str, rows: int = 5000, seed: int = 42, rates: FaultRates = FaultRates(),
                        prefix: str = "raw_customers", stamp=None) -> str:
    """``rows`` base records (ids 1..rows) with every fault injected, shuffled, written as JSON
    lines under a unique ``<prefix>_<yyyyMMddTHHmmss>`` name (UTC-5 wall clock) so that an
    incremental reader never mistakes a new batch for one it has seen."""
    import datetime as _dt
    now = stamp or _dt.datetime.now(_dt.timezone(_dt.timedelta(hours=-5)))
    path = f"{out_dir.rstrip('/')}/{prefix}_{now.strftime('%Y%m%dT%H%M%S')}.json"
    keys = spark.range(1, rows + 1).withColumnRenamed("id", "k")
    recs = inject_faults(clean_records(keys, "k", seed), seed, rates)
    to_json_lines(shuffled(recs, seed)).write.mode("errorifexists").text(path)
    return path
