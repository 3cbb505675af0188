"""Host-level quality rules: rule failures by host, shrunk with an empirical beta prior.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import WHITESPACE, let, stored

# a document fails the base rules with fewer words than this, or with more than this share of words in
# repeated windows (percent)
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5
SYMBOLS = "#*$%&|<>"
# a host is rejected when even the lower end of its shrunk failure rate lies above this
HOST_LIMIT = 0.5
HOST_SIGMAS = 2.0


# bits of a word position in a packed (hash prefix, position) number
POSITION_BITS = 24


def _without(text: Column, chars: str, to: str = "") -> Column:
    return reduce(lambda t, c: F.replace(t, F.lit(c), F.lit(to)), chars, text)


def words(text: Column) -> Column:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text; none for null."""
    spaced = _without(F.coalesce(text, F.lit("")), WHITESPACE[1:], " ")
    return F.array_remove(F.split(spaced, " "), "")


def repeated_words(w: Column, window: int = WINDOW) -> Column:
    """Words covered by ``window``-word windows that the text holds at least twice.

    Windows are compared by a 64-bit hash of their words' hashes. Their count against their distinct
    count settles most texts. In a text with a repeat, a sort of plain numbers (hash prefix, then
    position) finds the windows whose prefix occurs twice, and only those are compared by the whole hash.
    """
    long0 = F.lit(0).cast("long")
    position = (1 << POSITION_BITS) - 1
    prefix = F.lit(~position)

    def windows(hashes: Column) -> Column:
        at = F.transform(hashes, lambda h, i: F.xxhash64(h, *[F.get(hashes, i + k) for k in range(1, window)]))
        return F.slice(at, F.lit(1), F.size(hashes) - (window - 1))

    def with_neighbour(s: Column, of) -> Column:
        return F.filter(s, lambda x, k: of(F.get(s, k - 1)).eqNullSafe(of(x)) | of(F.get(s, k + 1)).eqNullSafe(of(x)))

    def candidates(wins: Column) -> Column:
        packed = F.sort_array(F.transform(wins, lambda h, i: h.bitwiseAND(prefix).bitwiseOR(i)))
        near = let(packed, lambda s: with_neighbour(s, lambda x: x.bitwiseAND(prefix)))
        some = F.transform(near, lambda x: F.struct(
            F.get(wins, x.bitwiseAND(F.lit(position)).cast("int")).alias("h"), x.bitwiseAND(F.lit(position)).cast("int").alias("i")))
        every = F.transform(wins, lambda h, i: F.struct(h.alias("h"), i.alias("i")))
        return F.sort_array(F.when(F.size(wins) < (1 << POSITION_BITS), some).otherwise(every))

    def count(tagged: Column) -> Column:
        at = F.sort_array(F.transform(with_neighbour(tagged, lambda x: x["h"]), lambda x: x["i"]))
        return let(at, lambda p: F.aggregate(
            F.transform(p, lambda v, k: F.least(F.lit(window), F.coalesce(F.get(p, k + 1) - v, F.lit(window)))),
            long0, lambda acc, v: acc + v))

    def total(wins: Column) -> Column:
        return F.when(F.size(F.array_distinct(wins)) == F.size(wins), long0).otherwise(let(candidates(wins), count))

    some = let(F.transform(w, lambda x: F.xxhash64(x)), lambda h: let(windows(h), total))
    return F.when(F.size(w) <= window, long0).otherwise(some)


def duplicate_lines(text: Column) -> Column:
    """``\\n``-split lines with a word that equal an earlier line of the text."""
    lines = F.filter(F.split(F.coalesce(text, F.lit("")), "\n"),
                     lambda x: F.btrim(x, F.lit(WHITESPACE)) != "")
    return let(lines, lambda v: (F.size(v) - F.size(F.array_distinct(v))).cast("long"))


def base_metrics(text: Column) -> Column:
    """Struct of the base measurements of a whole text."""
    plain = F.coalesce(text, F.lit(""))
    return let(words(text), lambda w: F.struct(
        F.size(w).cast("long").alias("n_words"),
        F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
        (F.octet_length(plain) - F.octet_length(_without(plain, SYMBOLS))).cast("long").alias("n_symbols"),
        duplicate_lines(text).alias("n_dup_lines"),
        repeated_words(w).alias("n_repeat_words")))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < MIN_WORDS) | (100 * m["n_repeat_words"] > MAX_REPEAT_PERCENT * m["n_words"])


def beta_prior(hosts: DataFrame) -> tuple[float, float]:
    """Empirical beta prior ``(alpha, beta)`` of the hosts' failure rates by the method of moments.

    ``hosts`` has ``n`` documents and ``f`` failures a host. The variance between hosts is the weighted
    variance of their rates less what binomial noise explains. One row of sums comes to the driver.
    Without documents, or when all or none fail, the prior is flat over that one rate.
    """
    rate = F.col("f") / F.col("n")
    s = hosts.agg(F.sum("n").alias("n"), F.sum("f").alias("f"), F.count(F.lit(1)).alias("k"),
                  F.sum(F.col("n") * rate * rate).alias("sq")).first()
    if not s["n"]:
        return 0.5, 0.5
    mean = s["f"] / s["n"]
    noise = mean * (1 - mean)
    if noise == 0:
        return max(mean, 1e-9), max(1 - mean, 1e-9)
    between = s["sq"] / s["n"] - mean * mean - noise * s["k"] / s["n"]
    strength = min(max(noise / between - 1, 1.0), 1e6) if between > 0 else 1e6
    return mean * strength, (1 - mean) * strength


def rejected_hosts(hosts: DataFrame, host_limit: float = HOST_LIMIT) -> DataFrame:
    """``bad_host`` and ``host_rate`` (its shrunk failure rate) of the hosts to reject; ``hosts``: host, n, f, stored."""
    alpha, beta = beta_prior(hosts)
    a, b = F.col("f") + F.lit(alpha), F.col("n") - F.col("f") + F.lit(beta)
    rate = a / (a + b)
    low = rate - HOST_SIGMAS * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return hosts.filter(low > host_limit).select(F.col("host").alias("bad_host"), rate.alias("host_rate"))


def _by_host(base: DataFrame) -> DataFrame:
    return stored(base.groupBy("host").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("base_failed").cast("long")).alias("f")),
                  "host-rules-hosts")


def judged(docs: DataFrame, carry: list[str], text: str = "text", host: str = "source",
           host_limit: float = HOST_LIMIT) -> DataFrame:
    """Judge every document: its base rules, then its host's verdict joined back.

    Returns the columns named in ``carry`` (inside a struct ``row``, so that their names cannot clash),
    the metrics struct ``m``, ``base_failed``, the host's shrunk failure rate ``host_rate`` (rejected
    hosts only, else null) and ``kept``. A null text has no words and fails; null hosts form one host of
    their own; repeated rows count as often as they occur; empty tables give no rows.

    The measurements are stored once; the aggregate by host combines map-side, so a host with a third of
    all rows costs one row a task. How the verdict reaches the documents is left to Spark, which measures the
    rejected hosts: by broadcast, or by a shuffled join whose hot keys adaptive execution splits.
    """
    row = F.struct(*[F.col(f"`{c}`") for c in carry]).alias("row")
    base = docs.select(row, F.col(host).cast("string").alias("host"), base_metrics(F.col(text)).alias("m"))
    base = stored(base.withColumn("base_failed", base_failed(F.col("m"))), "host-rules-base")
    rejected = rejected_hosts(_by_host(base), host_limit)
    return (base.join(rejected, base["host"].eqNullSafe(rejected["bad_host"]), "left")
            .select("row", "m", "base_failed", "host_rate",
                    (~F.col("base_failed") & F.col("host_rate").isNull()).alias("kept")))


def quality_report(docs: DataFrame) -> DataFrame:
    """One row a document: its measurements, ``base_failed`` and ``kept``."""
    j = judged(docs, ["doc_id"])
    return j.select("row.doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words",
                    "base_failed", "kept")


def passing(docs: DataFrame, text: str = "text", host: str = "source") -> DataFrame:
    """The documents that pass, with their own columns. The measurements are made twice, for the hosts' rates and
    for the documents themselves, so that no text is stored or moved beside them."""
    failed = base_failed(base_metrics(F.col(f"`{text}`")))
    rejected = rejected_hosts(_by_host(docs.select(F.col(f"`{host}`").cast("string").alias("host"), failed.alias("base_failed"))))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    rows = docs.filter(~failed).select(row, F.col(f"`{host}`").cast("string").alias("host"))
    return rows.join(rejected, F.col("host").eqNullSafe(F.col("bad_host")), "left_anti").select("row.*")
