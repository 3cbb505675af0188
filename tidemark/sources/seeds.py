"""Seeds (S9) and test fixtures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

COUNTRY_LIMITS_SCHEMA = "country string, max_balance_limit long, regulatory_body string"

# The regulatory balance limit per country that the compliance
# test compares balances with (country, max_balance_limit, regulatory_body).
COUNTRY_LIMITS = [
    ("Peru", 50000, "SBS"),
    ("Chile", 55000, "CMF"),
    ("Colombia", 45000, "SFC"),
    ("Mexico", 60000, "CNBV"),
    ("Argentina", 40000, "BCRA"),
    ("Brazil", 65000, "BCB"),
    ("Spain", 100000, "CNMV"),
]

def load_seed(spark: SparkSession, path: str, schema: str = COUNTRY_LIMITS_SCHEMA) -> DataFrame:
    """Typed CSV seed with a header line; no schema inference."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)


def write_country_limits_csv(spark: SparkSession, path: str) -> str:
    """Write the fixed country-limit seed as a one-file CSV (for tests and demos)."""
    (spark.createDataFrame(COUNTRY_LIMITS, COUNTRY_LIMITS_SCHEMA)
     .coalesce(1).write.mode("overwrite").option("header", True).csv(path))
    return path


def load_fixture(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Fixture loader dispatching on suffix: ``.json``/``.jsonl`` or ``.csv``; anything else raises."""
    lower = path.lower()
    reader = spark.read
    if schema:
        reader = reader.schema(schema)
    if lower.endswith((".json", ".jsonl", ".ndjson")):
        return reader.json(path)
    if lower.endswith(".csv"):
        # values are kept verbatim: surrounding spaces are data (a malformed e-mail case)
        return (reader.option("header", True).option("ignoreLeadingWhiteSpace", False)
                .option("ignoreTrailingWhiteSpace", False).csv(path))
    raise ValueError(f"unsupported fixture format: {path}")
