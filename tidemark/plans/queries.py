"""The registered queries: one function ``(spark, sf_dir) -> DataFrame`` per operator.

Each runs the library operator over the whole driver tables (through the
stand-in mapping where the operator expects customer records) and projects a
comparable result: averages rounded to 6 digits, money as DECIMAL(38,2).
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as TY

from tidemark.functions import columns as C
from tidemark.operators import dedup as D
from tidemark.operators import expectations as X
from tidemark.operators import faults as G
from tidemark.operators import history as H
from tidemark.operators import model_tests as T
from tidemark.operators import ops as O
from tidemark.operators import stores as ST
from tidemark.operators import suite as Q
from tidemark.operators.history import VersionedTable
from tidemark.plans import models as M
from tidemark.plans import runner as R
from tidemark.plans import standins as S
from tidemark.session import materialize_checkpoint, work_path
from tidemark.sources import clustering as CL
from tidemark.sources import landing as L
from tidemark.sources import seeds as SD
from tidemark.sources import writers as W
from tidemark.sources.json_rescue import SchemaStore, rescue_parse
from tidemark.sources.tables import SourceRegistry, read_table
from tidemark.streaming import pipeline as P

QUERIES = {}
# queries that report files, which SQL cannot see: they have no oracle and are tested against the files' own values
FILE_QUERIES = {}

SEED = 42
AS_OF_INSTANT = "1998-06-30 00:00:00"


def fixed6(c: str) -> F.Column:
    """Average rounded to 6 decimals the same way in every engine (round the scaled double)."""
    return F.round(F.col(c) * 1e6) / 1e6


def cents(c: str) -> F.Column:
    """An exact total shown in cents."""
    return F.col(c).cast("decimal(38,2)").alias(c)


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def file_query(fn):
    FILE_QUERIES[fn.__name__] = fn
    return fn


def _models(spark: SparkSession, sf_dir: str, shared: bool = True):
    """Bronze and the models derived from it. With ``shared`` (several models meet in one plan)
    bronze is written once, as the model graph materialises it, and the dimensions and fact read
    the stored copy instead of re-running the per-key top-1 per model; a query that uses a single
    model keeps it lazy (a write would only add work)."""
    bronze = S.bronze_standin(spark, sf_dir)
    if shared:
        bronze = materialize_checkpoint(bronze)
    return bronze, M.dim_customer(bronze), M.dim_date(bronze), M.fact_customer_activity(bronze)


# ------------------------------------------------------------------ reference rule sets

# Row expectations of the clean table (fail / drop / warn).
CLEAN_RULES = [
    X.expect_or_fail("valid_customer_id", "customer_id IS NOT NULL"),
    X.expect_or_drop("valid_customer_name", "customer_name IS NOT NULL"),
    X.expect_or_drop("valid_email", "email IS NOT NULL"),
    X.expect("valid_age", "age BETWEEN 18 AND 100"),
    X.expect("valid_risk_score", "risk_score BETWEEN 0 AND 100"),
]

# The 18 columns the validation suite expects, the value sets and the e-mail pattern.
SUITE_COLUMNS = ["customer_id", "customer_name", "age", "country", "email", "registration_date",
                 "account_type", "account_balance", "kyc_status", "device", "language_preference",
                 "notifications_enabled", "last_login_ip", "risk_score", "had_schema_drift",
                 "is_valid_age", "is_valid_risk_score", "exported_at_utc_minus_5"]
EMAIL_REGEX = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"

SUITE_TABLE_RULES = [
    Q.columns_match_set(SUITE_COLUMNS, exact_match=False),
    Q.row_count_between(1, 100000),
    Q.of_type("customer_id", "LongType"),
    Q.of_type("account_balance", "DoubleType"),
]
SUITE_ROW_RULES = [
    Q.not_null("customer_id"),
    Q.not_null("email"),
    Q.between("age", 18, 100),
    Q.between("risk_score", 0, 100),
    Q.between("account_balance", 0, None),
    Q.in_set("account_type", ["checking", "savings", "credit"]),
    Q.in_set("kyc_status", ["pending", "verified", "rejected"]),
    Q.match_regex("email", EMAIL_REGEX),
]
SUITE_STAT_RULES = [
    Q.mean_between("age", 18, 80),
    Q.stdev_between("account_balance", 1, None),
]
SUITE_ALL = (SUITE_TABLE_RULES[:1] + SUITE_TABLE_RULES[1:2] + SUITE_ROW_RULES[:2] + [Q.unique("customer_id")]
             + SUITE_ROW_RULES[2:] + SUITE_STAT_RULES + SUITE_TABLE_RULES[2:])


def faulted_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer records from the given tables, then faults G1-G8."""
    return G.inject_faults(S.raw_records(spark, sf_dir), SEED)


def clean_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table: faulted records deduplicated per customer (first copy wins), drop rules applied."""
    dedup = D.first_per_key(faulted_records(spark, sf_dir), "customer_id", "copy_id")
    return X.passing(dedup, CLEAN_RULES)


def limits_standin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Country limits for the stand-in countries, derived from the nation table."""
    n = read_table(spark, sf_dir, "nation")
    return n.select(F.col("n_name").alias("country"),
                    (F.col("n_nationkey").cast("bigint") * 250 + 5000).alias("max_balance_limit"),
                    F.concat(F.lit("REG_"), F.col("n_regionkey").cast("string")).alias("regulatory_body"))


# ------------------------------------------------------------------ W1 / A5

@query
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order per customer (ties on the stamp broken by the highest order key)."""
    return D.latest_per_key(read_table(spark, sf_dir, "orders"), "o_custkey", "o_orderdate", tiebreak="o_orderkey")


@query
def dedup_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5: first event per user (earliest stamp, lowest event id on ties)."""
    return D.first_per_key(read_table(spark, sf_dir, "events"), "user_id", "ts", tiebreak="event_id")


# ------------------------------------------------------------------ models and marts

@query
def mart_balance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold mart per country, year, month."""
    _, dc, dd, fact = _models(spark, sf_dir)
    m = M.mart_balance_by_country(fact, dc, dd)
    return m.select("country", "year", "month", "total_customers",
                    fixed6("avg_balance").alias("avg_balance"), cents("total_balance"),
                    fixed6("avg_risk_score").alias("avg_risk_score"),
                    "pending_kyc_count", "rejected_kyc_count")


@query
def mart_monthly(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Month-truncated mart per country."""
    _, dc, _, fact = _models(spark, sf_dir)
    m = M.mart_monthly(fact, dc)
    return m.select("country", "month", "total_customers", fixed6("avg_balance").alias("avg_balance"),
                    cents("total_balance"))


@query
def dim_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: customer dimension (row-level DISTINCT)."""
    return _models(spark, sf_dir, shared=False)[1]


@query
def dim_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Date dimension from the registration dates."""
    return _models(spark, sf_dir, shared=False)[2]


@query
def dim_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4/F8: device x language dimension with md5 surrogate key."""
    return M.dim_service(S.service_records(spark, sf_dir))


@query
def fact_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P10: fact table projection of the bronze view."""
    return _models(spark, sf_dir, shared=False)[3]


@query
def risk_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Risk procedure over the fact table."""
    return M.customers_risk_categorized(_models(spark, sf_dir, shared=False)[3])


@query
def validity_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity flags of the bronze records."""
    b = _models(spark, sf_dir, shared=False)[0]
    return b.select("customer_id", "age", "risk_score", "is_valid_age", "is_valid_risk_score")


@query
def json_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed value from a JSON payload path."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", "user_id", C.extract_path(ev, "props", "k", "double").alias("risk_score"))


@query
def mask_email(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E-mail as an analyst sees it, and as an engineer sees it."""
    dc = _models(spark, sf_dir, shared=False)[1]
    return dc.select("customer_id", C.mask_email("email", role="ANALYST_ROLE").alias("email_analyst"),
                     C.mask_email("email", role="ENGINEER_ROLE").alias("email_engineer"))


@query
def limit_breaches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Balances above their country's limit."""
    _, dc, _, fact = _models(spark, sf_dir)
    return T.limit_breaches(fact, dc, limits_standin(spark, sf_dir))


# ------------------------------------------------------------------ model tests

@query
def test_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repeated (order, line number) pairs."""
    return T.unique_violations(read_table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def test_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15/Q16: records without an e-mail (before the drop rule)."""
    return T.not_null_violations(faulted_records(spark, sf_dir), "email").select("customer_id", "copy_id", "email")


@query
def test_between(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q17: customer ages outside 0..120 (NULL passes)."""
    dc = _models(spark, sf_dir, shared=False)[1]
    return T.between_violations(dc, "age", 0, 120).select("customer_id", "age")


@query
def test_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without a label row."""
    return T.relationship_orphans(read_table(spark, sf_dir, "documents"), "doc_id",
                                  read_table(spark, sf_dir, "labels"), "doc_id")


@query
def test_row_loss(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct landing customers vs fact rows (failed when below 90 %)."""
    landing = S.customer_exports(spark, sf_dir)
    fact = _models(spark, sf_dir)[3]
    return T.row_loss_check(landing, fact)


def model_tests(spark: SparkSession, sf_dir: str) -> list[T.DataTest]:
    _, dc, _, fact = _models(spark, sf_dir)
    frames = {"dim_customer": dc, "fact_customer_activity": fact, "dim_service": M.dim_service(S.service_records(spark, sf_dir)),
              "bronze_customers": S.customer_exports(spark, sf_dir)}
    return R.customer_tests(frames, limits_standin(spark, sf_dir))


@query
def test_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q21: all model tests with severity and status (the build gate reads it)."""
    return T.run_tests(model_tests(spark, sf_dir))


# ------------------------------------------------------------------ expectations

@query
def inject_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seeded faults over every customer key."""
    return G.inject_faults(G.clean_records(read_table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey", SEED), SEED)


@query
def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2: the clean table after dedup and the drop rules."""
    return clean_records(spark, sf_dir).select("customer_id", "customer_name", "email", "age", "risk_score")


@query
def expect_warn_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q3: passed / failed / unknown counts of every rule, one pass."""
    dedup = D.first_per_key(faulted_records(spark, sf_dir), "customer_id", "copy_id")
    return X.expectation_metrics(dedup, CLEAN_RULES)


@query
def expect_fail_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1: outcome of the fail rule on the deduplicated records (reported, not raised)."""
    dedup = D.first_per_key(faulted_records(spark, sf_dir), "customer_id", "copy_id")
    return X.fail_report(dedup, CLEAN_RULES)


# ------------------------------------------------------------------ suite

@query
def suite_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schema and volume rules."""
    return Q.validate(clean_records(spark, sf_dir), SUITE_TABLE_RULES)


@query
def suite_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q6/Q8/Q9/Q10: row rules on the clean table."""
    return Q.validate(clean_records(spark, sf_dir), SUITE_ROW_RULES)


@query
def suite_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q7: uniqueness before dedup (finds the injected copies)."""
    return Q.validate(faulted_records(spark, sf_dir), [Q.unique("customer_id")])


@query
def suite_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and sample standard deviation rules."""
    r = Q.validate(clean_records(spark, sf_dir), SUITE_STAT_RULES)
    return r.withColumn("observed_value", fixed6("observed_value"))


@query
def suite_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14: the full 15-rule suite in one aggregate pass plus one group-by."""
    r = Q.validate(clean_records(spark, sf_dir), SUITE_ALL)
    return r.withColumn("observed_value", fixed6("observed_value"))


# ------------------------------------------------------------------ drift repair on rendered JSON

def parsed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulted records rendered as JSON lines (S14) and parsed back in rescue mode (S3)."""
    lines = G.to_json_lines(faulted_records(spark, sf_dir))
    return rescue_parse(lines, RAW_SCHEMA)


RAW_SCHEMA = TY.StructType([
    TY.StructField("customer_id", TY.LongType()), TY.StructField("customer_name", TY.StringType()),
    TY.StructField("age", TY.LongType()), TY.StructField("country", TY.StringType()),
    TY.StructField("email", TY.StringType()), TY.StructField("registration_date", TY.StringType()),
    TY.StructField("account_type", TY.StringType()), TY.StructField("account_balance", TY.DoubleType()),
    TY.StructField("kyc_status", TY.StringType()),
    TY.StructField("metadata", TY.StructType([
        TY.StructField("device", TY.StringType()),
        TY.StructField("preferences", TY.StructType([TY.StructField("notifications", TY.BooleanType()),
                                                     TY.StructField("language", TY.StringType())])),
        TY.StructField("last_login_ip", TY.StringType()), TY.StructField("risk_score", TY.DoubleType())])),
])


@query
def rescue_unknown_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: keys outside the schema and type-drifted values kept in ``_rescued_data``."""
    return parsed_lines(spark, sf_dir).select("customer_id", "_rescued_data")


@query
def resolve_rename(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Renamed field folded back, balance cast repaired."""
    return P.unify(parsed_lines(spark, sf_dir)).select("customer_id", "customer_name", "account_balance")


@query
def drift_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Drift evidence flag per record."""
    return P.unify(parsed_lines(spark, sf_dir)).select("customer_id", "had_schema_drift")


# ------------------------------------------------------------------ history

def _landing(spark, sf_dir):
    return S.customer_exports(spark, sf_dir)


def _cut(landing: DataFrame):
    """A stamp three years before the last export's year: what lies before it is the first run."""
    return landing.agg(F.date_trunc("year", F.max(M.STAMP)) - F.expr("INTERVAL 3 YEARS")).first()[0]


@query
def incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fact built up to a cut date, then merged with everything newer than its recorded mark; only key
    buckets with changed customers are rewritten."""
    landing = _landing(spark, sf_dir)
    store = ST.KeyedStore(spark, work_path(spark, "fact_store"), "customer_id", M.STAMP)
    store.merge(landing.where(F.col(M.STAMP) <= F.lit(_cut(landing))), M.FACT_COLUMNS, "export_id")
    store.merge(landing, M.FACT_COLUMNS, "export_id")
    return store.read()


def _history(spark, sf_dir):
    return H.scd2_from_log(_landing(spark, sf_dir), "customer_id", M.STAMP,
                           ["kyc_status", "account_balance"], tiebreak="export_id")


@query
def scd2_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2/M4: KYC history, one version per distinct export stamp."""
    return _history(spark, sf_dir)


@query
def scd2_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 (check strategy): KYC history with a new version only when the KYC status changes."""
    return H.scd2_from_log(_landing(spark, sf_dir), "customer_id", M.STAMP, ["kyc_status"],
                           tiebreak="export_id", check_cols=["kyc_status"])



@query
def scd2_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M2 stepwise: one snapshot run a year of the data, up to its last; each run sees the latest export per
    customer made since the run before, appends the versions it closes and rewrites the open ones' buckets it touches."""
    landing = _landing(spark, sf_dir)
    history = ST.HistoryStore(spark, work_path(spark, "kyc_history"), "customer_id", M.STAMP, ["kyc_status", "account_balance"])
    years = landing.agg(F.min(F.year(M.STAMP)), F.max(F.year(M.STAMP))).first()
    for year in range(years[0], years[1] + 1):
        # a run sees what came in since the run before: keys without a new export stay as they are
        first, last = (F.lit(f"{y}-01-01").cast("timestamp_ntz") for y in (year, year + 1))
        history.run(landing.where((F.col(M.STAMP) >= first) & (F.col(M.STAMP) < last)), tiebreak="export_id")
    return history.read()


@query
def scd2_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3: the KYC state of every customer at a fixed instant."""
    return H.as_of(_history(spark, sf_dir), AS_OF_INSTANT)


@query
def as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M3 of many instants: every shipped line with its customer's KYC state at the ship date."""
    lines = (read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_shipdate")
             .join(read_table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id")), "l_orderkey"))
    return H.as_of_join(lines, _history(spark, sf_dir), "customer_id", "l_shipdate", ["kyc_status", "account_balance", "dbt_valid_from"])


# ------------------------------------------------------------------ ops

@query
def table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row and column counts of every driver table."""
    return O.table_profile({t: read_table(spark, sf_dir, t) for t in O.DRIVER_TABLES})


@query
def expired_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: version log (events as commits per table) with the 168-hour retention verdict."""
    ev = read_table(spark, sf_dir, "events")
    log = ev.select(F.col("event_type").alias("table_name"), F.col("event_id").alias("version"),
                    F.col("ts").alias("committed_at"))
    return O.expired_versions(log, retention_hours=168)


@query
def load_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O2: failed loads per file in 15-minute alert windows (load history from events)."""
    ev = read_table(spark, sf_dir, "events")
    hist = ev.select(F.concat(F.lit("file_"), F.col("user_id").cast("string")).alias("file_name"),
                     F.when(F.col("event_type") == "error", F.lit("LOAD_FAILED")).otherwise(F.lit("LOADED"))
                     .alias("status"), F.col("ts").alias("last_load_time"))
    return O.load_failures(hist, minutes=15)


# ------------------------------------------------------------------ streaming and sinks
# These run real jobs into fresh folders below the session's checkpoint dir
# (spark.checkpoint.dir) and return a batch read of what they produced.



# Row rules of the streaming clean table: risk score still nested in metadata.
STREAM_RULES = CLEAN_RULES[:4] + [X.expect("valid_risk_score", "metadata.risk_score BETWEEN 0 AND 100")]
EXPORT_INSTANT = _dt.datetime(2024, 1, 1, 5, 0, 0)       # UTC; 00:00:00 at UTC-5

EVENT_RULES = [
    X.expect_or_fail("has_user", "user_id IS NOT NULL"),
    X.expect_or_drop("known_type", "event_type IN ('click', 'view', 'purchase', 'signup')"),
    X.expect("positive_value", "value > 0"),
]


def _raw_batches(spark: SparkSession, sf_dir: str, raw_dir: str):
    """Two landed files per run: first copies, then the injected duplicates (JSON lines, shuffled)."""
    recs = faulted_records(spark, sf_dir)
    for copy in (0, 1):
        lines = G.to_json_lines(G.shuffled(recs.where(F.col("copy_id") == copy), SEED))
        yield lambda lines=lines: lines.write.mode("append").text(raw_dir)


@query
def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings, two incremental runs; each file is read once, drift rescued."""
    base = work_path(spark, "ingest")
    raw, bronze = f"{base}/raw", f"{base}/bronze"
    for land in _raw_batches(spark, sf_dir, raw):
        land()
        P.ingest_json(spark, raw, bronze, f"{base}/_checkpoints/bronze", RAW_SCHEMA, pattern="*.txt")
    b = spark.read.parquet(bronze)
    return b.select("customer_id", "customer_name", "age", "country", "email", "account_balance", "_rescued_data")


@query
def medallion_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze -> unified -> clean after each of two landings."""
    base = work_path(spark, "medallion")
    paths = P.MedallionPaths(f"{base}/raw", f"{base}/bronze", f"{base}/unified", f"{base}/clean",
                             f"{base}/metrics", f"{base}/_checkpoints")
    cfg = P.CleanConfig(key="customer_id", rules=tuple(STREAM_RULES), cluster_by=("country", "kyc_status"))
    for land in _raw_batches(spark, sf_dir, paths.raw):
        land()
        P.run_medallion(spark, paths, RAW_SCHEMA, cfg, pattern="*.txt")
    c = P.read_sink(spark, paths.clean)
    return c.select("customer_id", "customer_name", "email", "age", "account_balance", "had_schema_drift")


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming first-row-per-user over events that land in four slices of time, one run after each; seen users
    are kept in a key index, the sink is never read."""
    base = work_path(spark, "stream_dedup")
    events = read_table(spark, sf_dir, "events")
    cuts = events.agg(F.percentile_approx("ts", [0.25, 0.5, 0.75])).first()[0] or []
    slices = [F.lit(0), *[(F.col("ts") > F.lit(c)).cast("int") for c in cuts]]
    at = F.coalesce(sum(slices[1:], slices[0]), F.lit(0))
    for i in range(len(cuts) + 1):
        events.where(at == i).write.mode("append").parquet(f"{base}/raw")
        stream = spark.readStream.schema(events.schema).option("maxBytesPerTrigger", P.MAX_BYTES).parquet(f"{base}/raw")
        P.dedup_stream(spark, stream, f"{base}/out", f"{base}/_checkpoint", "user_id", order_by=["ts", "event_id"])
    return P.read_sink(spark, f"{base}/out")


def _event_expectations(spark: SparkSession, sf_dir: str) -> str:
    base = work_path(spark, "stream_expect")
    schema = read_table(spark, sf_dir, "events").schema
    stream = (spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
              .option("maxBytesPerTrigger", P.MAX_BYTES).parquet(sf_dir))
    P.expectations_stream(stream, f"{base}/out", f"{base}/metrics", f"{base}/_checkpoint", EVENT_RULES)
    return base


@query
def stream_expectations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """fail/drop/warn rules on a stream of events; rows kept by the drop rule."""
    return P.read_sink(spark, f"{_event_expectations(spark, sf_dir)}/out")


@query
def stream_expectation_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-rule counts of the streamed events, summed over micro-batches."""
    m = P.read_sink(spark, f"{_event_expectations(spark, sf_dir)}/metrics")
    return m.groupBy("rule_name", "action").agg(*[F.sum(c).cast("bigint").alias(c) for c in
                                                  ("passed_records", "failed_records", "unknown_records",
                                                   "violations")])


@query
def load_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two exports (upper-case reordered columns; a missing column) plus control and
    text files in the stage; auto-load by name into the landing table, run twice."""
    base = work_path(spark, "load")
    stage, landing = f"{base}/stage", f"{base}/landing"
    clean = clean_records(spark, sf_dir)
    cols = clean.columns
    clean.select(*[F.col(c).alias(c.upper()) for c in reversed(cols)]) \
        .write.parquet(f"{stage}/customers_cleaned_20240101_000000")
    clean.drop("last_login_ip").write.parquet(f"{stage}/customers_cleaned_20240102_000000")
    clean.select(F.to_json(F.struct("customer_id")).alias("value")).write.text(f"{stage}/notes")
    for _ in range(2):                      # the second run finds no new file
        L.load_new_exports(spark, stage, landing, f"{base}/_checkpoint", clean.schema)
    return spark.read.parquet(landing)


@query
def export_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Full snapshot export with the UTC-5 batch stamp, read back."""
    path = W.export_snapshot(clean_records(spark, sf_dir), work_path(spark, "export"), EXPORT_INSTANT)
    return spark.read.parquet(path)


@query
def clustered_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table rewritten clustered by (country, kyc_status), read back."""
    path = W.clustered_write(clean_records(spark, sf_dir), work_path(spark, "clustered"), ["country", "kyc_status"])
    return spark.read.parquet(path)


LINE_CLUSTER = ["l_shipdate", "l_partkey"]


@query
def interleaved_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines rewritten by interleaved ranks of (ship date, part), read back."""
    lines = read_table(spark, sf_dir, "lineitem")
    return spark.read.parquet(CL.interleaved_write(lines, work_path(spark, "interleaved"), LINE_CLUSTER, W.files_for(lines)))


@file_query
def clustering_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files that an equality filter on each cluster column opens, by layout of the same lines."""
    lines = read_table(spark, sf_dir, "lineitem")
    base, n = work_path(spark, "layouts"), W.files_for(lines)
    lines.repartition(n, "l_orderkey", "l_linenumber").write.parquet(f"{base}/spread")
    paths = {"by row hash": f"{base}/spread",
             "one column after the other": W.clustered_write(lines, f"{base}/linear", LINE_CLUSTER, n),
             "interleaved ranks": CL.interleaved_write(lines, f"{base}/interleaved", LINE_CLUSTER, n)}
    out = None
    for layout, path in paths.items():
        part = CL.files_touched(spark.read.parquet(path), LINE_CLUSTER).withColumn("layout", F.lit(layout))
        out = part if out is None else out.unionByName(part)
    return out


# ------------------------------------------------------------------ seeds, runner, refresh, fixtures


LIMITS_SCHEMA = "country string, max_balance_limit long, regulatory_body string"


@query
def seed_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The country-limit seed written as CSV with a header and loaded back typed."""
    path = f"{work_path(spark, 'seed')}/country_compliance_limits"
    limits_standin(spark, sf_dir).write.option("header", True).csv(path)
    return SD.load_seed(spark, path, LIMITS_SCHEMA)


@query
def model_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The model graph run from a named source over the full landing table
    (generic bronze view over every export), tables materialised, gold mart read back."""
    reg = SourceRegistry()
    reg.register("raw.customers_raw", lambda: S.customer_exports(spark, sf_dir))
    frames = R.run_models(spark, reg, R.customer_models(), work_path(spark, "models"))
    m = frames["mart_balance_by_country"]
    return m.select("country", "year", "month", "total_customers",
                    fixed6("avg_balance").alias("avg_balance"), cents("total_balance"),
                    fixed6("avg_risk_score").alias("avg_risk_score"),
                    "pending_kyc_count", "rejected_kyc_count")


@query
def mart_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: freshness-driven monthly mart; the second call finds no newer data and keeps the version."""
    table = VersionedTable(spark, work_path(spark, "mart_monthly"))

    def build():
        _, dc, _, f = _models(spark, sf_dir)
        m = M.mart_monthly(f, dc)
        return m.select("country", "month", "total_customers", fixed6("avg_balance").alias("avg_balance"),
                        cents("total_balance"))
    src = S.order_exports(spark, sf_dir)
    R.refresh_if_stale(table, build, src, M.STAMP)
    R.refresh_if_stale(table, build, src, M.STAMP)
    return table.read()


@query
def fixture_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The clean table written as a CSV fixture and loaded back by suffix with its schema."""
    clean = clean_records(spark, sf_dir)
    path = f"{work_path(spark, 'fixture')}/clean_customers.csv"
    (clean.write.option("header", True).option("ignoreLeadingWhiteSpace", False)
     .option("ignoreTrailingWhiteSpace", False).csv(path))
    return SD.load_fixture(spark, path, clean.schema)


# ------------------------------------------------------------------ the whole lifecycle, end to end

@query
def end_to_end_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections 3.1 + 3.2 chained: JSON landings -> bronze -> unified -> clean (streams) -> snapshot
    export -> by-name load into the landing table -> bronze view (nested payload flattened) ->
    dimensions and fact (tables) -> gold mart."""
    base = work_path(spark, "lifecycle")
    paths = P.MedallionPaths(f"{base}/raw", f"{base}/bronze", f"{base}/unified", f"{base}/clean",
                             f"{base}/metrics", f"{base}/_checkpoints")
    cfg = P.CleanConfig(key="customer_id", rules=tuple(STREAM_RULES), cluster_by=("country", "kyc_status"))
    for land in _raw_batches(spark, sf_dir, paths.raw):
        land()
        P.run_medallion(spark, paths, RAW_SCHEMA, cfg, pattern="*.txt")
    clean = P.read_sink(spark, paths.clean).drop("_source_file", "_rescued_data")
    exported = W.export_snapshot(clean, f"{base}/stage", EXPORT_INSTANT)
    schema = spark.read.parquet(exported).schema
    L.load_new_exports(spark, f"{base}/stage", f"{base}/landing", f"{base}/_checkpoints/load", schema)
    reg = SourceRegistry()
    reg.register("raw.customers_raw", lambda: spark.read.parquet(f"{base}/landing"))
    frames = R.run_models(spark, reg, R.customer_models(), f"{base}/models")
    m = frames["mart_balance_by_country"]
    return m.select("country", "year", "month", "total_customers",
                    fixed6("avg_balance").alias("avg_balance"), cents("total_balance"),
                    fixed6("avg_risk_score").alias("avg_risk_score"),
                    "pending_kyc_count", "rejected_kyc_count")


# The 11 columns and the e-mail pattern of the documentation suite.
DOCS_SUITE_COLUMNS = ["customer_id", "customer_name", "age", "country", "email", "registration_date",
                      "account_type", "account_balance", "kyc_status", "device", "risk_score"]
DOCS_EMAIL_REGEX = r"^[\w\.-]+@[\w\.-]+\.\w+$"
SUITE_DOCS = [
    Q.columns_match_set(DOCS_SUITE_COLUMNS, exact_match=False),
    Q.row_count_between(1, None),
    Q.not_null("customer_id"),
    Q.unique("customer_id"),
    Q.between("age", 18, 100),
    Q.between("account_balance", 0, None),
    Q.in_set("kyc_status", ["pending", "verified", "rejected"]),
    Q.in_set("account_type", ["checking", "savings", "credit"]),
    Q.match_regex("email", DOCS_EMAIL_REGEX),
    Q.mean_between("age", 18, 100),
    Q.stdev_between("age", 1, None),
]


@query
def suite_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q4-Q12: the 11-rule documentation suite (second e-mail pattern) over the clean table."""
    r = Q.validate(clean_records(spark, sf_dir), SUITE_DOCS)
    return r.withColumn("observed_value", fixed6("observed_value"))


# ------------------------------------------------------------------ further evidence

@query
def cast_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P5: numbers out of drifted text: empty, no number, padded, plain."""
    k = F.col("o_orderkey")
    text = (F.when(k % 4 == 0, F.lit("")).when(k % 4 == 1, F.concat(F.lit("abc"), k.cast("string")))
            .when(k % 4 == 2, F.concat(k.cast("string"), F.lit(".5"))).otherwise(k.cast("string")))
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", text.alias("text"))
    return o.select("o_orderkey", "text", C.to_double("text").alias("value"))


@query
def suite_verdict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q14: the overall verdict of the whole suite."""
    return Q.verdict(Q.validate(clean_records(spark, sf_dir), SUITE_ALL))


@query
def risk_procedure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The risk procedure as a job: its table read back, its message beside every row."""
    path = work_path(spark, "risk")
    message = M.categorize_customer_risk(_models(spark, sf_dir, shared=False)[3], path)
    return spark.read.parquet(path).withColumn("message", F.lit(message))


@query
def build_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q21: models built, tested, and the gate's decision (an error-severity failure stops the build)."""
    reg = SourceRegistry()
    reg.register("raw.customers_raw", lambda: S.customer_exports(spark, sf_dir))
    report = R.build_and_test(spark, reg, work_path(spark, "gate"), limits_standin(spark, sf_dir), fail_on_error=False)
    failed = F.count_if(F.col("status") == "fail")
    return report.agg(F.count(F.lit(1)).alias("tests"), failed.alias("failed"), F.count_if(F.col("status") == "warn").alias("warned"),
                      (failed == 0).alias("passed"))


@query
def column_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns and types of every driver table, with rows and nulls counted."""
    return O.column_profile({t: read_table(spark, sf_dir, t) for t in O.DRIVER_TABLES})


@file_query
def table_storage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns, files and bytes of every driver table, with the bytes a row takes. SQL sees no files."""
    profile = O.table_profile({t: read_table(spark, sf_dir, t) for t in O.DRIVER_TABLES})
    storage = O.table_storage(spark, {t: f"{sf_dir.rstrip('/')}/{t}.parquet" for t in O.DRIVER_TABLES})
    return (profile.join(storage, "table_name")
            .withColumn("bytes_a_row", F.when(F.col("row_count") > 0, F.col("total_bytes") / F.col("row_count"))))


# ------------------------------------------------------------------ state between runs

@query
def model_build_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The graph with its incremental fact and its KYC snapshot, run over the exports up to a cut and again
    over all: the fact of the second state, with the number of KYC versions and the last one's start."""
    landing = S.customer_exports(spark, sf_dir)
    base, cut = work_path(spark, "models_incremental"), _cut(landing)
    for rows in (landing.where(F.col(M.STAMP) <= F.lit(cut)), landing):
        reg = SourceRegistry()
        reg.register("raw.customers_raw", lambda rows=rows: rows)
        frames = R.run_models(spark, reg, R.customer_models(incremental=True), base)
    kyc = frames["customer_kyc_snapshot"].groupBy("customer_id").agg(F.count(F.lit(1)).alias("kyc_versions"), F.max("dbt_valid_from").alias("kyc_since"))
    return frames["fact_customer_activity"].join(kyc, "customer_id")


@query
def mart_delta_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """T5: the monthly mart kept by signed changes: built up to a cut, then refreshed with what is newer."""
    landing = S.customer_exports(spark, sf_dir).withColumn("month", C.month_start(C.iso_to_date("registration_date")))
    mart = ST.DeltaMart(spark, work_path(spark, "delta_mart"), "customer_id", M.STAMP, ["country", "month"], "customer_id", "account_balance")
    mart.refresh(landing.where(F.col(M.STAMP) <= F.lit(_cut(landing))), "export_id")
    mart.refresh(landing, "export_id")
    return mart.read().select("country", "month", F.col("n_distinct").alias("total_customers"), fixed6("average").alias("avg_balance"),
                              F.col("total").cast("decimal(38,2)").alias("total_balance"))


@query
def unreferenced_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """O1: after two commits of the fact store with the last one retained: rows in files that it names, and in
    files that no retained version names."""
    landing = _landing(spark, sf_dir)
    store = ST.KeyedStore(spark, work_path(spark, "fact_files"), "customer_id", M.STAMP)
    store.merge(landing.where(F.col(M.STAMP) <= F.lit(_cut(landing))), M.FACT_COLUMNS, "export_id")
    # every customer comes again, so every bucket is rewritten
    store.merge(landing.withColumn(M.STAMP, F.col(M.STAMP) + F.expr("INTERVAL 20 YEARS")), M.FACT_COLUMNS, "export_id")
    files = O.unreferenced_files(spark, store.base, [store.log.last()])
    rows = (spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").schema("customer_id long").parquet(store.base)
            .groupBy(F.regexp_replace(F.col("_metadata.file_path"), "^file:/+", "/").alias("file")).agg(F.count(F.lit(1)).alias("rows")))
    return (files.withColumn("file", F.regexp_replace("path", "^file:/+", "/")).join(rows, "file")
            .groupBy("live").agg(F.sum("rows").alias("rows")))


@query
def ingest_evolving(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two landings ingested with no schema given: records without drift, then the rest, whose new fields
    become columns while known fields keep their type."""
    base = work_path(spark, "ingest_evolving")
    recs = faulted_records(spark, sf_dir)
    plain = F.col("drift_kind").isNull() & (F.col("copy_id") == 0)
    for part in (recs.where(plain), recs.where(~plain)):
        G.to_json_lines(part).write.mode("append").text(f"{base}/raw")
        P.ingest_json(spark, f"{base}/raw", f"{base}/bronze", f"{base}/_checkpoints/bronze", pattern="*.txt", evolve=True)
    schema = SchemaStore(spark, f"{base}/_checkpoints/bronze_schema").schema()
    read = spark.read.schema(TY.StructType([*schema.fields, TY.StructField("_rescued_data", TY.StringType())])).parquet(f"{base}/bronze")
    return read.select("customer_id", "customer_name", F.col("customerName").alias("renamed_name"), "experimental_flag", "age", "account_balance",
                       F.col("metadata.preferences.language").alias("language"), "_rescued_data")


@query
def published_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The published customer dimension as an analyst and as an engineer read it."""
    name = R.publish_masked(spark, _models(spark, sf_dir, shared=False)[1], "dim_customer_published")
    analyst, engineer = (R.read_as(spark, name, r).select("customer_id", F.col("email").alias(f"email_{c}"))
                         for r, c in (("ANALYST_ROLE", "analyst"), ("ENGINEER_ROLE", "engineer")))
    return analyst.join(engineer, "customer_id")


@query
def row_loss_after_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q20 where rows really go: documents against those that an inner join with their labels leaves."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id")
    left = docs.join(read_table(spark, sf_dir, "labels").select("doc_id").distinct(), "doc_id")
    return T.row_loss_check(docs, left, key="doc_id")


@query
def expect_fail_stops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1 where the rule fires: events enforced into a table; what the fail rules found and whether a version
    became visible."""
    events = read_table(spark, sf_dir, "events")
    rules = [X.expect_or_fail("has_user", "user_id IS NOT NULL"), X.expect_or_fail("no_errors", "event_type <> 'error'")]
    table = VersionedTable(spark, work_path(spark, "enforced"))
    try:
        X.enforce_into(table, events, rules)
    except X.ExpectationFailed:
        pass                                           # reported below
    return X.fail_report(events, rules).withColumn("published", F.lit(table.current_path() is not None))
