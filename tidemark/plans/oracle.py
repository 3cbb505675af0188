"""DuckDB SQL twins of the registered queries (the correctness oracle).

Written independently of the Spark code, over the same driver tables. Shared
CTEs reproduce the stand-in mapping of ``tidemark.plans.standins``.
"""

from __future__ import annotations

from tidemark.operators import faults as FX

CUST = """
cust AS (
  SELECT c.c_custkey AS customer_id, c.c_name AS customer_name,
         CAST((c.c_custkey % 130) - 5 AS BIGINT) AS age,
         n.n_name AS country,
         CASE c.c_custkey % 40
              WHEN 1 THEN lower(replace(c.c_name, '#', '.')) || 'example.com'
              WHEN 2 THEN lower(replace(c.c_name, '#', '.')) || '@'
              WHEN 3 THEN ' ' || lower(replace(c.c_name, '#', '.')) || '@example.com '
              WHEN 4 THEN lower(replace(c.c_name, '#', '.')) || '@@example.com'
              ELSE lower(replace(c.c_name, '#', '.')) || '@example.com' END AS email,
         ['checking', 'savings', 'credit'][CAST(c.c_custkey % 3 AS INTEGER) + 1] AS account_type,
         c.c_acctbal AS account_balance
  FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)"""

EXPORTS = """
exports AS (
  SELECT o_custkey AS customer_id,
         strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS registration_date,
         CASE o_orderstatus WHEN 'P' THEN 'pending' WHEN 'F' THEN 'verified' WHEN 'O' THEN 'rejected' END AS kyc_status,
         ['android', 'ios', 'web', 'unknown'][CAST(o_orderkey % 4 AS INTEGER) + 1] AS device,
         ['es', 'en', 'pt'][CAST(o_orderkey % 3 AS INTEGER) + 1] AS language_preference,
         floor(o_totalprice / 50) / 100.0 AS risk_score,
         o_orderdate AS exported_at_utc_minus_5,
         o_orderkey AS export_id
  FROM orders)"""

LANDING = CUST + "," + EXPORTS + """,
landing AS (
  SELECT e.customer_id, c.customer_name, c.age, c.country, c.email, e.registration_date,
         c.account_type, c.account_balance, e.kyc_status, e.device, e.language_preference,
         e.risk_score, false AS had_schema_drift,
         c.age BETWEEN 18 AND 100 AS is_valid_age,
         CASE WHEN e.risk_score IS NOT NULL THEN e.risk_score BETWEEN 0 AND 100 END AS is_valid_risk_score,
         e.exported_at_utc_minus_5, e.export_id
  FROM exports e LEFT JOIN cust c ON e.customer_id = c.customer_id)"""

BRONZE = LANDING + """,
bronze AS (
  SELECT * FROM landing
  QUALIFY row_number() OVER (PARTITION BY customer_id
                             ORDER BY exported_at_utc_minus_5 DESC NULLS LAST, export_id DESC) = 1)"""

MODELS = BRONZE + """,
dim_customer AS (
  SELECT DISTINCT customer_id, customer_name, age, country, kyc_status, email, is_valid_age, had_schema_drift
  FROM bronze),
dim_date AS (
  SELECT DISTINCT d AS date_id, d AS full_date, CAST(year(d) AS INTEGER) AS year,
         CAST(month(d) AS INTEGER) AS month, CAST(day(d) AS INTEGER) AS day,
         CAST(dayofweek(d) AS INTEGER) AS day_of_week, strftime(d, '%b') AS month_name
  FROM (SELECT try_cast(registration_date AS DATE) AS d FROM bronze WHERE registration_date IS NOT NULL)
  WHERE d IS NOT NULL),
fact AS (
  SELECT customer_id, account_balance, risk_score, is_valid_risk_score, registration_date, exported_at_utc_minus_5
  FROM bronze)"""


def w(ctes: str, body: str) -> str:
    return "WITH " + ctes.strip() + "\n" + body.strip()


SQL: dict[str, str] = {}

SQL["latest_per_key"] = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC) = 1
"""

SQL["mart_balance"] = w(MODELS, """
SELECT d.country, dt.year, dt.month,
       count(DISTINCT f.customer_id) AS total_customers,
       round(avg(f.account_balance) * 1e6) / 1e6 AS avg_balance,
       CAST(sum(CAST(f.account_balance AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_balance,
       round(avg(f.risk_score) * 1e6) / 1e6 AS avg_risk_score,
       count(*) FILTER (WHERE d.kyc_status = 'pending') AS pending_kyc_count,
       count(*) FILTER (WHERE d.kyc_status = 'rejected') AS rejected_kyc_count
FROM fact f
JOIN dim_customer d ON f.customer_id = d.customer_id
JOIN dim_date dt ON try_cast(f.registration_date AS DATE) = dt.date_id
GROUP BY d.country, dt.year, dt.month
""")

# ---------------------------------------------------------------- fault-injected records

SEED = 42


def _u(salt: str, key: str = "k") -> str:
    return f"(('0x' || substr(md5('{SEED}|{salt}|' || CAST({key} AS VARCHAR)), 1, 8))::BIGINT / 4294967296.0)"


def _lit(v) -> str:
    if isinstance(v, str):
        return "'" + v + "'"
    if isinstance(v, float):
        return f"CAST({v!r} AS DOUBLE)"
    return str(v)


def _ch(salt: str, values: list, key: str = "k") -> str:
    lst = "[" + ", ".join(_lit(v) for v in values) + "]"
    return f"{lst}[CAST(floor({_u(salt, key)} * {len(values)}) AS INTEGER) + 1]"


def _letters(salt: str, key: str = "k") -> str:
    return (f"translate(substr(md5('{SEED}|{salt}|' || CAST({key} AS VARCHAR)), 1, 8), "
            f"'0123456789abcdef', 'abcdefghijklmnop')")


COUNTRIES, DOMAINS = FX.COUNTRIES, FX.EMAIL_DOMAINS

_FACTORY = f"""
g0 AS (
  SELECT c_custkey AS k, c_custkey AS customer_id,
         'Customer_' || CAST(c_custkey AS VARCHAR) AS customer_name,
         CAST(floor({_u('age')} * 58) + 18 AS BIGINT) AS age,
         {_ch('country', COUNTRIES)} AS country,
         {_letters('email')} || '@' || {_ch('domain', DOMAINS)} AS email,
         strftime(DATE '2022-01-01' + CAST(floor({_u('reg')} * 1201) AS INTEGER), '%Y-%m-%dT00:00:00') AS registration_date,
         {_ch('acct', FX.ACCOUNT_TYPES)} AS account_type,
         floor({_u('bal')} * 5000001) / 100.0 AS account_balance,
         CASE WHEN {_u('kyc')} < 0.1 THEN 'pending' WHEN {_u('kyc')} < 0.95 THEN 'verified' ELSE 'rejected' END AS kyc_status,
         {_ch('device', FX.DEVICES)} AS device,
         {_u('notif')} < 0.5 AS notifications,
         {_ch('lang', FX.LANGUAGES)} AS language,
         CAST(CAST(floor({_u('ip1')} * 255) + 1 AS BIGINT) AS VARCHAR) || '.' ||
         CAST(CAST(floor({_u('ip2')} * 256) AS BIGINT) AS VARCHAR) || '.' ||
         CAST(CAST(floor({_u('ip3')} * 256) AS BIGINT) AS VARCHAR) || '.' ||
         CAST(CAST(floor({_u('ip4')} * 256) AS BIGINT) AS VARCHAR) AS last_login_ip,
         floor({_u('risk')} * 10001) / 100.0 AS risk_score
  FROM customer),"""

# the records that most queries run on: the latest export of every customer
_RECORDS = BRONZE + """,
g0 AS (
  SELECT customer_id AS k, customer_id, customer_name, age, country, email, registration_date, account_type, account_balance,
         kyc_status, device, export_id % 2 = 0 AS notifications, language_preference AS language,
         CAST(export_id % 255 + 1 AS VARCHAR) || '.' || CAST(CAST(floor(export_id / 255) AS BIGINT) % 256 AS VARCHAR) || '.' ||
         CAST(customer_id % 256 AS VARCHAR) || '.' || CAST(CAST(floor(customer_id / 256) AS BIGINT) % 256 AS VARCHAR) AS last_login_ip,
         risk_score
  FROM bronze),"""

_INJECT = f"""
gf AS (
  SELECT g0.*,
         {_u('null')} < 0.05 AS hit_null,
         {_ch('null_field', FX.NULLABLE_FIELDS)} AS null_field,
         {_u('bad_age')} < 0.03 AS g2,
         CAST({_ch('bad_age_pick', FX.INVALID_AGES)} AS BIGINT) AS bad_age,
         {_u('bad_email')} < 0.03 AS g3,
         {_ch('bad_email_pick', FX.EMAIL_FAULTS)} AS email_kind,
         {_letters('bad_email_local')} AS bl,
         {_ch('bad_email_domain', DOMAINS)} AS bd,
         CASE WHEN {_u('drift')} < 0.02 THEN {_ch('drift_pick', FX.DRIFT_KINDS)} END AS drift_kind,
         {_u('bad_bal')} < 0.03 AS g5,
         {_ch('bad_bal_pick', FX.INVALID_BALANCES)} AS bad_bal,
         {_u('kyc_viol')} < 0.04 AS g6,
         {_ch('kyc_pick', FX.KYC_VIOLATION_STATUSES)} AS kyc_v,
         floor({_u('kyc_bal')} * 1990001) / 100.0 + 100 AS kyc_bal,
         {_u('bad_risk')} < 0.03 AS g7,
         {_ch('bad_risk_pick', FX.INVALID_RISK_SCORES)} AS bad_risk,
         {_u('dup')} < 0.03 AS g8
  FROM g0),
faulted0 AS (
  SELECT customer_id,
         CASE WHEN hit_null AND null_field = 'customer_name' THEN NULL ELSE customer_name END AS customer_name,
         CASE WHEN g2 THEN bad_age WHEN hit_null AND null_field = 'age' THEN NULL ELSE age END AS age,
         CASE WHEN hit_null AND null_field = 'country' THEN NULL ELSE country END AS country,
         CASE WHEN g3 THEN (CASE email_kind WHEN 'no_at' THEN bl || bd WHEN 'no_domain' THEN bl || '@'
                                            WHEN 'spaces' THEN ' ' || bl || '@' || bd || ' '
                                            ELSE bl || '@@' || bd END)
              WHEN hit_null AND null_field = 'email' THEN NULL ELSE email END AS email,
         registration_date, account_type,
         CASE WHEN g6 THEN kyc_bal WHEN g5 THEN bad_bal ELSE account_balance END AS account_balance,
         coalesce(drift_kind = 'type_change', false) AND NOT g5 AND NOT g6 AS balance_is_text,
         CASE WHEN g6 THEN kyc_v ELSE kyc_status END AS kyc_status,
         device, notifications, language, last_login_ip,
         CASE WHEN g7 THEN bad_risk ELSE risk_score END AS risk_score,
         drift_kind, g8
  FROM gf),
faulted AS (
  SELECT * EXCLUDE (g8), 0 AS copy_id FROM faulted0
  UNION ALL
  SELECT * EXCLUDE (g8), 1 AS copy_id FROM faulted0 WHERE g8),
dedup AS (
  SELECT * FROM faulted QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY copy_id) = 1),
clean AS (
  SELECT * FROM dedup WHERE customer_name IS NOT NULL AND email IS NOT NULL)"""

FACTORY_FAULTS, FAULTS = _FACTORY + _INJECT, _RECORDS + _INJECT

SQL["dedup_by_key"] = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts ASC NULLS LAST, event_id ASC) = 1
"""

SQL["mart_monthly"] = w(MODELS, """
SELECT d.country, CAST(date_trunc('month', try_cast(f.registration_date AS DATE)) AS DATE) AS month,
       count(DISTINCT f.customer_id) AS total_customers,
       round(avg(f.account_balance) * 1e6) / 1e6 AS avg_balance,
       CAST(sum(CAST(f.account_balance AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_balance
FROM fact f JOIN dim_customer d ON f.customer_id = d.customer_id
GROUP BY 1, 2
""")

SQL["dim_customer"] = w(MODELS, "SELECT * FROM dim_customer")
SQL["dim_date"] = w(MODELS, "SELECT * FROM dim_date")
SQL["fact_activity"] = w(MODELS, "SELECT * FROM fact")

SQL["dim_service"] = """
SELECT DISTINCT
       md5(coalesce(CAST(source AS VARCHAR), '_dbt_utils_surrogate_key_null_') || '-' ||
           coalesce(CAST(lang AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS device_id,
       source AS device_type, lang AS language_preference
FROM documents WHERE source IS NOT NULL
"""

SQL["risk_category"] = w(MODELS, """
SELECT customer_id, account_balance, risk_score,
       CASE WHEN risk_score >= 70 THEN 'high_risk' WHEN risk_score >= 40 THEN 'medium_risk' ELSE 'low_risk' END
         AS risk_category
FROM fact
""")

SQL["validity_flags"] = w(BRONZE, """
SELECT customer_id, age, risk_score, is_valid_age, is_valid_risk_score FROM bronze
""")

SQL["json_extract"] = """
SELECT event_id, user_id, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS risk_score FROM events
"""

SQL["mask_email"] = w(MODELS, """
SELECT customer_id, CASE WHEN contains(email, '@') THEN regexp_replace(email, '^.*@', '***@')
                         WHEN email IS NOT NULL THEN '***' END AS email_analyst, email AS email_engineer
FROM dim_customer
""")

LIMITS = """
lim AS (SELECT n_name AS country, CAST(n_nationkey AS BIGINT) * 250 + 5000 AS max_balance_limit FROM nation)"""

SQL["limit_breaches"] = w(MODELS + "," + LIMITS, """
SELECT f.customer_id, f.account_balance, d.country, l.max_balance_limit
FROM fact f JOIN dim_customer d ON f.customer_id = d.customer_id JOIN lim l ON d.country = l.country
WHERE f.account_balance > l.max_balance_limit
""")

SQL["test_unique"] = """
SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
"""

SQL["test_not_null"] = w(FAULTS, "SELECT customer_id, copy_id, email FROM faulted WHERE email IS NULL")

SQL["test_between"] = w(MODELS, """
SELECT customer_id, age FROM dim_customer WHERE NOT (age >= 0 AND age <= 120)
""")

SQL["test_relationships"] = """
SELECT c.from_field, c.n_records
FROM (SELECT doc_id AS from_field, count(*) AS n_records FROM documents WHERE doc_id IS NOT NULL GROUP BY doc_id) c
WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = c.from_field)
"""

SQL["test_row_loss"] = w(MODELS, """
SELECT b.bronze_distinct_customers, f.fact_rows, f.fact_rows < b.bronze_distinct_customers * 0.9 AS failed
FROM (SELECT count(DISTINCT customer_id) AS bronze_distinct_customers FROM landing) b
CROSS JOIN (SELECT count(*) AS fact_rows FROM fact) f
""")

SQL["test_report"] = w(MODELS + "," + LIMITS + """,
ds AS (
  SELECT DISTINCT md5(coalesce(source, '_dbt_utils_surrogate_key_null_') || '-' ||
                      coalesce(lang, '_dbt_utils_surrogate_key_null_')) AS device_id
  FROM documents WHERE source IS NOT NULL),
t AS (
  SELECT 'unique_dim_customer_customer_id' AS test_name, 'error' AS severity,
         (SELECT count(*) FROM (SELECT customer_id FROM dim_customer WHERE customer_id IS NOT NULL
                                GROUP BY 1 HAVING count(*) > 1)) AS failures
  UNION ALL SELECT 'not_null_dim_customer_customer_id', 'error',
         (SELECT count(*) FROM dim_customer WHERE customer_id IS NULL)
  UNION ALL SELECT 'between_dim_customer_age', 'warn',
         (SELECT count(*) FROM dim_customer WHERE NOT (age >= 0 AND age <= 120))
  UNION ALL SELECT 'not_null_fact_customer_id', 'error', (SELECT count(*) FROM fact WHERE customer_id IS NULL)
  UNION ALL SELECT 'relationships_fact_dim_customer', 'error',
         (SELECT count(DISTINCT customer_id) FROM fact f WHERE customer_id IS NOT NULL
            AND NOT EXISTS (SELECT 1 FROM dim_customer d WHERE d.customer_id = f.customer_id))
  UNION ALL SELECT 'not_null_fact_account_balance', 'error', (SELECT count(*) FROM fact WHERE account_balance IS NULL)
  UNION ALL SELECT 'between_fact_risk_score', 'warn',
         (SELECT count(*) FROM fact WHERE NOT (risk_score >= -50 AND risk_score <= 200))
  UNION ALL SELECT 'unique_dim_service_device_id', 'error',
         (SELECT count(*) FROM (SELECT device_id FROM ds WHERE device_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1))
  UNION ALL SELECT 'not_null_dim_service_device_id', 'error', (SELECT count(*) FROM ds WHERE device_id IS NULL)
  UNION ALL SELECT 'assert_balance_within_country_limit', 'warn',
         (SELECT count(*) FROM fact f JOIN dim_customer d ON f.customer_id = d.customer_id
            JOIN lim l ON d.country = l.country WHERE f.account_balance > l.max_balance_limit)
  UNION ALL SELECT 'assert_fact_not_empty_after_join', 'error',
         (SELECT count(*) FROM (SELECT count(DISTINCT customer_id) AS b FROM landing) x
            CROSS JOIN (SELECT count(*) AS f FROM fact) y WHERE y.f < x.b * 0.9))""", """
SELECT test_name, severity, failures,
       CASE WHEN failures = 0 THEN 'pass' WHEN severity = 'error' THEN 'fail' ELSE 'warn' END AS status
FROM t
""")

SQL["inject_faults"] = w(FACTORY_FAULTS, """
SELECT customer_id, customer_name, age, country, email, registration_date, account_type, account_balance,
       balance_is_text, kyc_status, device, notifications, language, last_login_ip, risk_score, drift_kind, copy_id
FROM faulted
""")

SQL["expect_drop"] = w(FAULTS, "SELECT customer_id, customer_name, email, age, risk_score FROM clean")

_RULES = [("valid_customer_id", "fail", "customer_id IS NOT NULL"),
          ("valid_customer_name", "drop", "customer_name IS NOT NULL"),
          ("valid_email", "drop", "email IS NOT NULL"),
          ("valid_age", "warn", "age BETWEEN 18 AND 100"),
          ("valid_risk_score", "warn", "risk_score BETWEEN 0 AND 100")]


def _metric(name, action, pred):
    p, f, u = (f"count(*) FILTER (WHERE ({pred}))", f"count(*) FILTER (WHERE NOT ({pred}))",
               f"count(*) FILTER (WHERE ({pred}) IS NULL)")
    viol = f"{f} + {u}" if action in ("drop", "fail") else f
    return (f"SELECT '{name}' AS rule_name, '{action}' AS action, {p} AS passed_records, {f} AS failed_records, "
            f"{u} AS unknown_records, CAST({viol} AS BIGINT) AS violations FROM dedup")


SQL["expect_warn_metrics"] = w(FAULTS, "\nUNION ALL\n".join(_metric(*r) for r in _RULES))

SQL["expect_fail_report"] = w(FAULTS, """
SELECT 'valid_customer_id' AS rule_name, count(*) FILTER (WHERE NOT coalesce(customer_id IS NOT NULL, false)) AS violations,
       CASE WHEN count(*) FILTER (WHERE NOT coalesce(customer_id IS NOT NULL, false)) > 0 THEN 'fail' ELSE 'pass' END
         AS outcome
FROM dedup
""")

# suite rows: (rule_id, expectation, column, success, element_count, unexpected_count, observed_value)
_EXP = {
    "cols": "expect_table_columns_to_match_set", "rows": "expect_table_row_count_to_be_between",
    "nn": "expect_column_values_to_not_be_null", "uniq": "expect_column_values_to_be_unique",
    "btw": "expect_column_values_to_be_between", "set": "expect_column_values_to_be_in_set",
    "re": "expect_column_values_to_match_regex", "mean": "expect_column_mean_to_be_between",
    "std": "expect_column_stdev_to_be_between", "type": "expect_column_values_to_be_of_type",
}
EMAIL_RE = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"


def _rule_sql(rid: int, kind: str, col: str | None, src: str, arg=None) -> str:
    c = "CAST(NULL AS VARCHAR)" if col is None else f"'{col}'"
    if kind == "cols11":
        # the clean records carry all 11 documentation columns (fixed by their construction)
        head = f"SELECT CAST({rid} AS INTEGER) AS rule_id, '{_EXP['cols']}' AS expectation, {c} AS column_name, "
        return head + (f"true AS success, count(*) AS element_count, CAST(0 AS BIGINT) AS unexpected_count, "
                       f"0.0::DOUBLE AS observed_value FROM {src}")
    head = f"SELECT CAST({rid} AS INTEGER) AS rule_id, '{_EXP[kind]}' AS expectation, {c} AS column_name, "
    n = "count(*)"
    if kind == "cols":
        # the clean records lack 6 of the 18 expected columns (fixed by their construction)
        return head + f"false AS success, {n} AS element_count, CAST(6 AS BIGINT) AS unexpected_count, 6.0::DOUBLE AS observed_value FROM {src}"
    if kind == "type":
        duck = {"LongType": "BIGINT", "DoubleType": "DOUBLE"}[arg]
        ok = f"coalesce(any_value(typeof({col})) = '{duck}', true)"
        return head + (f"{ok} AS success, {n} AS element_count, CAST(CASE WHEN {ok} THEN 0 ELSE 1 END AS BIGINT) "
                       f"AS unexpected_count, CASE WHEN {ok} THEN 1.0 ELSE 0.0 END::DOUBLE AS observed_value FROM {src}")
    if kind == "rows":
        lo, hi = arg
        if hi is None:
            return head + (f"{n} >= {lo} AS success, {n} AS element_count, CAST(0 AS BIGINT) AS unexpected_count, "
                           f"CAST({n} AS DOUBLE) AS observed_value FROM {src}")
        return head + (f"{n} BETWEEN {lo} AND {hi} AS success, {n} AS element_count, CAST(0 AS BIGINT) AS unexpected_count, "
                       f"CAST({n} AS DOUBLE) AS observed_value FROM {src}")
    if kind in ("mean", "std"):
        fn = "avg" if kind == "mean" else "stddev_samp"
        lo, hi = arg
        s = f"{fn}(CAST({col} AS DOUBLE))"
        cond = " AND ".join(x for x in ([f"{s} >= {lo}"] if lo is not None else []) + ([f"{s} <= {hi}"] if hi is not None else []))
        return head + (f"coalesce({cond}, false) AS success, {n} AS element_count, CAST(0 AS BIGINT) AS unexpected_count, "
                       f"round({s} * 1e6) / 1e6 AS observed_value FROM {src}")
    if kind == "uniq":
        v = (f"(SELECT coalesce(sum(cnt), 0) FROM (SELECT count(*) AS cnt FROM {src} WHERE {col} IS NOT NULL "
             f"GROUP BY {col} HAVING count(*) > 1))")
        return head + (f"{v} = 0 AS success, {n} AS element_count, CAST({v} AS BIGINT) AS unexpected_count, "
                       f"CAST({v} AS DOUBLE) AS observed_value FROM {src}")
    if kind == "nn":
        bad = f"{col} IS NULL"
    elif kind == "btw":
        lo, hi = arg
        rng = " AND ".join(x for x in ([f"{col} >= {lo}"] if lo is not None else []) + ([f"{col} <= {hi}"] if hi is not None else []))
        bad = f"{col} IS NOT NULL AND (NOT ({rng}) OR isnan(CAST({col} AS DOUBLE)))"
    elif kind == "set":
        bad = f"{col} IS NOT NULL AND {col} NOT IN ({', '.join(_lit(v) for v in arg)})"
    else:
        bad = f"{col} IS NOT NULL AND NOT regexp_matches({col}, '{arg}')"
    v = f"count(*) FILTER (WHERE {bad})"
    return head + (f"{v} = 0 AS success, {n} AS element_count, {v} AS unexpected_count, "
                   f"CAST({v} AS DOUBLE) AS observed_value FROM {src}")


_TABLE = [("cols", None, None), ("rows", None, (1, 100000)), ("type", "customer_id", "LongType"),
          ("type", "account_balance", "DoubleType")]
_ROWS = [("nn", "customer_id", None), ("nn", "email", None), ("btw", "age", (18, 100)),
         ("btw", "risk_score", (0, 100)), ("btw", "account_balance", (0, None)),
         ("set", "account_type", ["checking", "savings", "credit"]),
         ("set", "kyc_status", ["pending", "verified", "rejected"]), ("re", "email", EMAIL_RE)]
_STATS = [("mean", "age", (18, 80)), ("std", "account_balance", (1, None))]
_ALL = _TABLE[:2] + _ROWS[:2] + [("uniq", "customer_id", None)] + _ROWS[2:] + _STATS + _TABLE[2:]


def _suite(rules, src):
    return "\nUNION ALL\n".join(_rule_sql(i, k, c, src, a) for i, (k, c, a) in enumerate(rules, start=1))


SQL["suite_table"] = w(FAULTS, _suite(_TABLE, "clean"))
SQL["suite_rows"] = w(FAULTS, _suite(_ROWS, "clean"))
SQL["suite_unique"] = w(FAULTS, _suite([("uniq", "customer_id", None)], "faulted"))
SQL["suite_stats"] = w(FAULTS, _suite(_STATS, "clean"))
SQL["suite_report"] = w(FAULTS, "SELECT rule_id, expectation, column_name, success, element_count, unexpected_count, "
                                "round(observed_value * 1e6) / 1e6 AS observed_value FROM (" + _suite(_ALL, "clean") + ")")

SQL["rescue_unknown_fields"] = w(FAULTS, """
SELECT customer_id,
       CASE WHEN drift_kind = 'rename_field' AND customer_name IS NOT NULL
              THEN '{"customerName":"' || customer_name || '"}'
            WHEN drift_kind = 'extra_field' THEN '{"experimental_flag":true}'
            WHEN balance_is_text THEN '{"account_balance":"' || CAST(account_balance AS VARCHAR) || '"}'
       END AS _rescued_data
FROM faulted
""")

SQL["resolve_rename"] = w(FAULTS, "SELECT customer_id, customer_name, account_balance FROM faulted")

SQL["drift_flag"] = w(FAULTS, """
SELECT customer_id,
       coalesce(drift_kind = 'rename_field' AND customer_name IS NOT NULL, false)
       OR coalesce(drift_kind = 'extra_field', false) OR balance_is_text AS had_schema_drift
FROM faulted
""")

_LATEST = "QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY exported_at_utc_minus_5 DESC NULLS LAST, export_id DESC) = 1"
_FACT_COLS = "customer_id, account_balance, risk_score, is_valid_risk_score, registration_date, exported_at_utc_minus_5"

SQL["incremental_merge"] = w(LANDING + f""",
target AS (SELECT {_FACT_COLS} FROM landing WHERE exported_at_utc_minus_5 <= (SELECT date_trunc('year', max(exported_at_utc_minus_5)) - INTERVAL 3 YEAR FROM landing) {_LATEST}),
new AS (SELECT {_FACT_COLS} FROM landing
        WHERE exported_at_utc_minus_5 > (SELECT max(exported_at_utc_minus_5) FROM target) {_LATEST})""", """
SELECT * FROM target WHERE customer_id NOT IN (SELECT customer_id FROM new)
UNION ALL SELECT * FROM new
""")

HISTORY = LANDING + """,
versions AS (
  SELECT * FROM landing
  QUALIFY row_number() OVER (PARTITION BY customer_id, exported_at_utc_minus_5 ORDER BY export_id DESC) = 1),
history AS (
  SELECT customer_id, kyc_status, account_balance, exported_at_utc_minus_5,
         md5(CAST(customer_id AS VARCHAR) || '|' || CAST(exported_at_utc_minus_5 AS VARCHAR)) AS dbt_scd_id,
         exported_at_utc_minus_5 AS dbt_updated_at, exported_at_utc_minus_5 AS dbt_valid_from,
         lead(exported_at_utc_minus_5) OVER (PARTITION BY customer_id ORDER BY exported_at_utc_minus_5) AS dbt_valid_to
  FROM versions WHERE exported_at_utc_minus_5 IS NOT NULL)"""

SQL["scd2_history"] = w(HISTORY, "SELECT * FROM history")
SQL["scd2_as_of"] = w(HISTORY, """
SELECT * FROM history
WHERE dbt_valid_from <= TIMESTAMP '1998-06-30 00:00:00'
  AND (dbt_valid_to IS NULL OR TIMESTAMP '1998-06-30 00:00:00' < dbt_valid_to)
""")

_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
           "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
SQL["table_profile"] = "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS row_count, "
    f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}') AS column_count FROM {t}"
    for t in _TABLES)

SQL["expired_versions"] = """
WITH log AS (SELECT event_type AS table_name, event_id AS version, ts AS committed_at FROM events),
newest AS (SELECT table_name, arg_max(version, committed_at) AS newest FROM log GROUP BY table_name)
SELECT l.table_name, l.version, l.committed_at,
       (epoch_us((SELECT max(committed_at) FROM log)) - epoch_us(l.committed_at)) / 3.6e9 > 168
         AND l.version != n.newest AS expired
FROM log l LEFT JOIN newest n ON l.table_name = n.table_name
"""

SQL["load_failures"] = """
SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start,
       time_bucket(INTERVAL 15 MINUTE, ts) + INTERVAL 15 MINUTE AS window_end,
       'file_' || CAST(user_id AS VARCHAR) AS file_name, count(*) AS failures
FROM events WHERE event_type = 'error'
GROUP BY ALL
"""

_CLEAN_COLS = ("customer_id, customer_name, age, country, email, registration_date, account_type, account_balance, "
               "balance_is_text, kyc_status, device, notifications, language, last_login_ip, risk_score, "
               "drift_kind, copy_id")

SQL["ingest_incremental"] = w(FAULTS, """
SELECT customer_id, CASE WHEN drift_kind = 'rename_field' THEN NULL ELSE customer_name END AS customer_name,
       age, country, email, account_balance,
       CASE WHEN drift_kind = 'rename_field' AND customer_name IS NOT NULL
              THEN '{"customerName":"' || customer_name || '"}'
            WHEN drift_kind = 'extra_field' THEN '{"experimental_flag":true}'
            WHEN balance_is_text THEN '{"account_balance":"' || CAST(account_balance AS VARCHAR) || '"}'
       END AS _rescued_data
FROM faulted
""")

SQL["medallion_clean"] = w(FAULTS, """
SELECT customer_id, customer_name, email, age, account_balance,
       coalesce(drift_kind = 'rename_field' AND customer_name IS NOT NULL, false)
       OR coalesce(drift_kind = 'extra_field', false) OR balance_is_text AS had_schema_drift
FROM clean
""")

SQL["stream_dedup"] = SQL["dedup_by_key"]

SQL["stream_expectations"] = """
SELECT * FROM events WHERE coalesce(event_type IN ('click', 'view', 'purchase', 'signup'), false)
"""

_EV_RULES = [("has_user", "fail", "user_id IS NOT NULL"),
             ("known_type", "drop", "event_type IN ('click', 'view', 'purchase', 'signup')"),
             ("positive_value", "warn", "value > 0")]
SQL["stream_expectation_metrics"] = "\nUNION ALL\n".join(
    _metric(*r).replace("FROM dedup", "FROM events") for r in _EV_RULES)

SQL["load_by_name"] = w(FAULTS, f"""
SELECT {_CLEAN_COLS} FROM clean
UNION ALL
SELECT {_CLEAN_COLS.replace('last_login_ip', 'CAST(NULL AS VARCHAR) AS last_login_ip')} FROM clean
""")

SQL["export_snapshot"] = w(FAULTS, f"""
SELECT {_CLEAN_COLS}, TIMESTAMP '2024-01-01 00:00:00' AS exported_at_utc_minus_5 FROM clean
""")

SQL["interleaved_rewrite"] = "SELECT * FROM lineitem"
SQL["clustered_rewrite"] = w(FAULTS, f"SELECT {_CLEAN_COLS} FROM clean")

SQL["seed_limits"] = """
SELECT n_name AS country, CAST(n_nationkey AS BIGINT) * 250 + 5000 AS max_balance_limit,
       'REG_' || CAST(n_regionkey AS VARCHAR) AS regulatory_body
FROM nation
"""

# the graph's mart straight from the landing rows, each customer by its last export
SQL["model_build"] = w(LANDING + """,
newest AS (
  SELECT customer_id, arg_max({'country': country, 'kyc': kyc_status, 'balance': account_balance, 'risk': risk_score, 'day': try_cast(registration_date AS DATE)},
                              {'stamp': exported_at_utc_minus_5, 'id': export_id}) AS r
  FROM landing GROUP BY customer_id)""", """
SELECT r.country AS country, CAST(year(r.day) AS INTEGER) AS year, CAST(month(r.day) AS INTEGER) AS month, count(DISTINCT customer_id) AS total_customers,
       round(avg(r.balance) * 1e6) / 1e6 AS avg_balance, CAST(sum(CAST(r.balance AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_balance,
       round(avg(r.risk) * 1e6) / 1e6 AS avg_risk_score,
       count(*) FILTER (WHERE r.kyc = 'pending') AS pending_kyc_count, count(*) FILTER (WHERE r.kyc = 'rejected') AS rejected_kyc_count
FROM newest WHERE r.day IS NOT NULL GROUP BY ALL
""")
SQL["mart_refresh"] = SQL["mart_monthly"]
SQL["fixture_load"] = w(FAULTS, f"SELECT {_CLEAN_COLS} FROM clean")

DOCS_EMAIL_RE = r"^[\w\.-]+@[\w\.-]+\.\w+$"
_DOCS = [("cols11", None, None), ("rows", None, (1, None)), ("nn", "customer_id", None), ("uniq", "customer_id", None),
         ("btw", "age", (18, 100)), ("btw", "account_balance", (0, None)),
         ("set", "kyc_status", ["pending", "verified", "rejected"]),
         ("set", "account_type", ["checking", "savings", "credit"]), ("re", "email", DOCS_EMAIL_RE),
         ("mean", "age", (18, 100)), ("std", "age", (1, None))]
SQL["suite_docs"] = w(FAULTS, "SELECT rule_id, expectation, column_name, success, element_count, unexpected_count, "
                              "round(observed_value * 1e6) / 1e6 AS observed_value FROM (" + _suite(_DOCS, "clean") + ")")

SQL["end_to_end_mart"] = w(FAULTS + """,
e2e_bronze AS (
  SELECT customer_id, customer_name, age, country, email, registration_date, kyc_status, account_balance,
         risk_score, age BETWEEN 18 AND 100 AS is_valid_age,
         coalesce(drift_kind = 'rename_field' AND customer_name IS NOT NULL, false)
           OR coalesce(drift_kind = 'extra_field', false) OR balance_is_text AS had_schema_drift
  FROM clean),
e2e_dim AS (SELECT DISTINCT customer_id, customer_name, age, country, kyc_status, email, is_valid_age, had_schema_drift
            FROM e2e_bronze),
e2e_date AS (SELECT DISTINCT try_cast(registration_date AS DATE) AS date_id,
                    CAST(year(try_cast(registration_date AS DATE)) AS INTEGER) AS year,
                    CAST(month(try_cast(registration_date AS DATE)) AS INTEGER) AS month
             FROM e2e_bronze WHERE registration_date IS NOT NULL AND try_cast(registration_date AS DATE) IS NOT NULL)""", """
SELECT d.country, dt.year, dt.month,
       count(DISTINCT f.customer_id) AS total_customers,
       round(avg(f.account_balance) * 1e6) / 1e6 AS avg_balance,
       CAST(sum(CAST(f.account_balance AS DECIMAL(18,2))) AS DECIMAL(38,2)) AS total_balance,
       round(avg(f.risk_score) * 1e6) / 1e6 AS avg_risk_score,
       count(*) FILTER (WHERE d.kyc_status = 'pending') AS pending_kyc_count,
       count(*) FILTER (WHERE d.kyc_status = 'rejected') AS rejected_kyc_count
FROM e2e_bronze f
JOIN e2e_dim d ON f.customer_id = d.customer_id
JOIN e2e_date dt ON try_cast(f.registration_date AS DATE) = dt.date_id
GROUP BY d.country, dt.year, dt.month
""")

SQL["scd2_changes"] = w(LANDING + """,
versions AS (
  SELECT customer_id, kyc_status, exported_at_utc_minus_5 FROM landing
  WHERE exported_at_utc_minus_5 IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY customer_id, exported_at_utc_minus_5 ORDER BY export_id DESC) = 1),
changes AS (
  SELECT * FROM (
    SELECT *, lag(kyc_status) OVER (PARTITION BY customer_id ORDER BY exported_at_utc_minus_5) AS prev,
           row_number() OVER (PARTITION BY customer_id ORDER BY exported_at_utc_minus_5) AS rn
    FROM versions)
  WHERE rn = 1 OR prev IS DISTINCT FROM kyc_status)""", """
SELECT customer_id, kyc_status, exported_at_utc_minus_5,
       md5(CAST(customer_id AS VARCHAR) || '|' || CAST(exported_at_utc_minus_5 AS VARCHAR)) AS dbt_scd_id,
       exported_at_utc_minus_5 AS dbt_updated_at, exported_at_utc_minus_5 AS dbt_valid_from,
       lead(exported_at_utc_minus_5) OVER (PARTITION BY customer_id ORDER BY exported_at_utc_minus_5) AS dbt_valid_to
FROM changes
""")

SQL["scd2_snapshots"] = w(LANDING + """,
runs AS (SELECT make_timestamp(y, 1, 1, 0, 0, 0) AS cut
         FROM (SELECT unnest(range(year(min(exported_at_utc_minus_5)) + 1, year(max(exported_at_utc_minus_5)) + 2)) AS y FROM landing)),
snap AS (
  SELECT l.customer_id, l.kyc_status, l.account_balance, l.exported_at_utc_minus_5, r.cut
  FROM landing l JOIN runs r ON l.exported_at_utc_minus_5 < r.cut
  QUALIFY row_number() OVER (PARTITION BY r.cut, l.customer_id
                             ORDER BY l.exported_at_utc_minus_5 DESC NULLS LAST, l.export_id DESC) = 1),
versions AS (
  SELECT * FROM snap
  QUALIFY row_number() OVER (PARTITION BY customer_id, exported_at_utc_minus_5 ORDER BY cut) = 1)""", """
SELECT customer_id, kyc_status, account_balance, exported_at_utc_minus_5,
       md5(CAST(customer_id AS VARCHAR) || '|' || CAST(exported_at_utc_minus_5 AS VARCHAR)) AS dbt_scd_id,
       exported_at_utc_minus_5 AS dbt_updated_at, exported_at_utc_minus_5 AS dbt_valid_from,
       lead(exported_at_utc_minus_5) OVER (PARTITION BY customer_id ORDER BY exported_at_utc_minus_5) AS dbt_valid_to
FROM versions
""")

SQL["cast_repair"] = """
SELECT o_orderkey, text, try_cast(text AS DOUBLE) AS value
FROM (SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN '' WHEN 1 THEN 'abc' || CAST(o_orderkey AS VARCHAR)
                              WHEN 2 THEN CAST(o_orderkey AS VARCHAR) || '.5' ELSE CAST(o_orderkey AS VARCHAR) END AS text FROM orders)
"""

SQL["suite_verdict"] = f"""
SELECT bool_and(success) AS success, count(*) AS rules, count(*) FILTER (WHERE NOT success) AS failed
FROM ({SQL["suite_report"]})
"""

SQL["risk_procedure"] = f"""
SELECT *, 'Categorized ' || CAST(count(*) OVER () AS VARCHAR) || ' customers into risk buckets.' AS message
FROM ({SQL["risk_category"]})
"""

# the model graph's service dimension comes from the exports, whose devices are never null
SQL["build_gate"] = f"""
SELECT count(*) AS tests, count(*) FILTER (WHERE failures > 0 AND severity = 'error') AS failed,
       count(*) FILTER (WHERE failures > 0 AND severity = 'warn') AS warned,
       count(*) FILTER (WHERE failures > 0 AND severity = 'error') = 0 AS passed
FROM ({SQL["test_report"]})
"""

_TYPES = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "TIMESTAMP": "timestamp_ntz",
          "DATE": "date", "FLOAT": "float", "BOOLEAN": "boolean"}
_TYPE_CASE = ("CASE WHEN data_type LIKE '%[]' THEN 'array<' ELSE '' END || CASE replace(data_type, '[]', '') "
              + " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in _TYPES.items())
              + " ELSE lower(data_type) END || CASE WHEN data_type LIKE '%[]' THEN '>' ELSE '' END")
SQL["column_profile"] = "\nUNION ALL\n".join(f"""
SELECT '{t}' AS table_name, CAST(i.ordinal_position AS INTEGER) AS position, i.column_name, {_TYPE_CASE} AS column_type,
       n.row_count, n.row_count - u.filled AS null_count
FROM (UNPIVOT (SELECT count(COLUMNS('(.*)')) AS '\\1' FROM {t}) ON COLUMNS(*) INTO NAME column_name VALUE filled) u
JOIN information_schema.columns i ON i.table_name = '{t}' AND i.column_name = u.column_name, (SELECT count(*) AS row_count FROM {t}) n""" for t in _TABLES)

_CUT = "(SELECT date_trunc('year', max(exported_at_utc_minus_5)) - INTERVAL 3 YEAR FROM landing)"
SQL["model_build_incremental"] = w(LANDING + f""",
target AS (SELECT {_FACT_COLS} FROM landing WHERE exported_at_utc_minus_5 <= {_CUT} {_LATEST}),
new AS (SELECT {_FACT_COLS} FROM landing WHERE exported_at_utc_minus_5 > (SELECT max(exported_at_utc_minus_5) FROM target) {_LATEST}),
fact2 AS (SELECT * FROM target WHERE customer_id NOT IN (SELECT customer_id FROM new) UNION ALL SELECT * FROM new),
kyc AS (
  SELECT customer_id, count(DISTINCT stamp) AS kyc_versions, max(stamp) AS kyc_since
  FROM (SELECT customer_id, max(exported_at_utc_minus_5) AS stamp FROM landing WHERE exported_at_utc_minus_5 <= {_CUT} GROUP BY customer_id
        UNION ALL SELECT customer_id, max(exported_at_utc_minus_5) FROM landing GROUP BY customer_id)
  GROUP BY customer_id)""", "SELECT f.*, kyc_versions, kyc_since FROM fact2 f JOIN kyc USING (customer_id)")

SQL["mart_delta_refresh"] = SQL["mart_monthly"]

SQL["unreferenced_files"] = w(LANDING, f"""
SELECT true AS live, count(DISTINCT customer_id) AS rows FROM landing
UNION ALL SELECT false, count(DISTINCT customer_id) FROM landing WHERE exported_at_utc_minus_5 <= {_CUT}
""")

SQL["as_of_join"] = w(HISTORY + """,
lines AS (SELECT l_orderkey, l_linenumber, l_shipdate, o_custkey AS customer_id FROM lineitem JOIN orders ON l_orderkey = o_orderkey)""", """
SELECT l.*, h.kyc_status, h.account_balance, h.dbt_valid_from
FROM lines l ASOF LEFT JOIN history h ON l.customer_id = h.customer_id AND l.l_shipdate >= h.dbt_valid_from
""")

SQL["ingest_evolving"] = w(FAULTS, """
SELECT customer_id, CASE WHEN drift_kind = 'rename_field' THEN NULL ELSE customer_name END AS customer_name,
       CASE WHEN drift_kind = 'rename_field' THEN customer_name END AS renamed_name,
       CASE WHEN drift_kind = 'extra_field' THEN true END AS experimental_flag, age, account_balance, language,
       CASE WHEN balance_is_text THEN '{"account_balance":"' || CAST(account_balance AS VARCHAR) || '"}' END AS _rescued_data
FROM faulted
""")

SQL["published_dimension"] = SQL["mask_email"]

SQL["row_loss_after_join"] = """
SELECT count(DISTINCT doc_id) AS bronze_distinct_customers, count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)) AS fact_rows,
       count(*) FILTER (WHERE doc_id IN (SELECT doc_id FROM labels WHERE doc_id IS NOT NULL)) < count(DISTINCT doc_id) * 0.9 AS failed
FROM documents
"""

SQL["expect_fail_stops"] = """
SELECT rule_name, violations, CASE WHEN violations > 0 THEN 'fail' ELSE 'pass' END AS outcome, sum(violations) OVER () = 0 AS published
FROM (SELECT 'has_user' AS rule_name, count(*) FILTER (WHERE user_id IS NULL) AS violations FROM events
      UNION ALL SELECT 'no_errors', count(*) FILTER (WHERE NOT coalesce(event_type <> 'error', false)) FROM events)
"""
