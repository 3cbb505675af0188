"""WARC archives: writing with revisits, and reading by boundary-chain verification.

Archives are read by Spark's text reader with the record magic as line separator; plain files are split, so
one of any size is read by many tasks (gzipped files are not, so the writer bounds their records). The pieces between magics tile a file, which gives every magic its offset:
the bytes of the splits before, then of the pieces before. Each magic is a candidate record whose header
names its successor's offset. Each split's candidates that follow one another are contracted to runs, and
pointer jumping over the runs from the file's start keeps what is reachable from there; a magic inside a payload is never a successor and is rejected, its piece going back to the record around it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import shared_path, stored

MAGIC = "WARC/1.1\r\n"
DATE = "2020-01-01T00:00:00Z"
MIN_REVISIT_BYTES = 1000
RECORDS_A_FILE = 20_000
CRLF = "\r\n"
# characters that would break a header line, and the escape's own mark
_ESCAPED = [("%", "%25"), ("\r", "%0D"), ("\n", "%0A")]


def _escape(c: Column) -> Column:
    for a, b in _ESCAPED:
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _unescape(c: Column) -> Column:
    for a, b in reversed(_ESCAPED):
        c = F.replace(c, F.lit(b), F.lit(a))
    return c


def _hashed(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html"), F.lit(""))
    return pages.select("page_id", "url", payload.alias("html"), F.sha1(payload.cast("binary")).alias("digest"),
                        F.octet_length(payload).cast("long").alias("size"))


def originals(hashed: DataFrame) -> DataFrame:
    """``(d, z, best)``: digest and size of payloads of at least ``MIN_REVISIT_BYTES`` that occur more than
    once, and the largest page_id that has them (nulls last). Copies are combined map-side."""
    return (hashed.filter(F.col("size") >= MIN_REVISIT_BYTES).groupBy(F.col("digest").alias("d"), F.col("size").alias("z"))
            .agg(F.max("page_id").alias("best"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND best IS NOT NULL").drop("n"))


def write(pages: DataFrame, path: str) -> None:
    """Write one record a page (columns page_id, url, html) to gzipped archives below ``path``.

    Null html is an empty payload; a null url has no target line. Equal payloads share the response of the
    largest page_id, the others are revisits that refer to it; repeated rows of that page are responses all,
    with the same record id. Pages without an id are revisits of pages with one, else responses. Files are
    committed by Spark's own writer, so a lost executor's files are written again.
    """
    hashed = _hashed(pages)
    best = stored(originals(hashed), "warc-originals")
    # the stored verdicts have a size: Spark chooses between broadcasting and shuffling them
    j = hashed.join(best, (F.col("digest") == F.col("d")) & (F.col("size") == F.col("z")), "left")
    (j.select(record_text().alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", RECORDS_A_FILE)
     .option("compression", "gzip").text(path))


def record_id(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page_id.cast("string"), F.lit("")), F.lit(">"))


def record_text() -> Column:
    """A whole record without its last line feed, which the text writer adds."""
    revisit = F.col("best").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("best"))
    http = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                    F.col("size").cast("string"), F.lit(CRLF + CRLF))
    block = F.when(revisit, http).otherwise(F.concat(http, F.col("html")))

    def line(name: str, value: Column) -> Column:
        return F.concat(F.lit(name + ": "), value, F.lit(CRLF))

    head = F.concat(
        F.lit(MAGIC),
        line("WARC-Type", F.when(revisit, F.lit("revisit")).otherwise(F.lit("response"))),
        line("WARC-Record-ID", record_id(F.col("page_id"))),
        line("WARC-Date", F.lit(DATE)),
        F.coalesce(line("WARC-Target-URI", _escape(F.col("url"))), F.lit("")),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("digest"))),
        F.when(revisit, F.concat(
            line("WARC-Refers-To", record_id(F.col("best"))),
            F.lit("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" + CRLF))).otherwise(F.lit("")),
        F.lit("Content-Type: application/http; msgtype=response" + CRLF),
        line("Content-Length", F.octet_length(block).cast("string")),
        F.lit(CRLF))
    return F.concat(head, block, F.lit("\r\n\r"))


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """What lies between magics, with file, offset and bytes: ``(file, at, size, value)``, stored once.

    Candidates are pieces behind a magic (``at`` is the magic's offset); a file's text before its first
    magic has ``at`` null."""
    raw = (spark.read.option("lineSep", MAGIC).text(path)
           .select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                   F.monotonically_increasing_id().alias("id")))
    raw = stored(raw.withColumn("size", F.octet_length("value").cast("long")), "warc-pieces")
    sep = len(MAGIC)
    # pieces of one split: a split is bounded by the reader's partition bytes, so its window is bounded too
    inside = Window.partitionBy("file", "block").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    blocks = raw.groupBy("file", "block").agg(F.sum(F.col("size") + sep).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))
    light = raw.select("file", "block", "id", "size", _header("value").alias("head"))
    at = F.col("base") + F.coalesce(F.sum(F.col("size") + sep).over(inside), F.lit(0)) - sep
    places = light.join(blocks, ["file", "block"]).select("file", "block", "id", "size", "head", at.alias("at"))
    return raw.select("id", "value"), stored(places, "warc-places")


def _header(value: str) -> Column:
    """A piece's lines up to the first empty one, null if there is none."""
    v = F.col(value)
    return F.when(F.instr(v, CRLF + CRLF) > 0, F.substring_index(v, CRLF + CRLF, 1))


def field(head: Column, name: str) -> Column:
    """A header field's value, null if absent."""
    got = F.regexp_extract(F.concat(F.lit(CRLF), head, F.lit(CRLF)), rf"(?i)\r\n{name}:[ \t]*([^\r\n]*)\r\n", 1)
    return F.when(F.regexp_like(F.concat(F.lit(CRLF), head, F.lit(CRLF)), F.lit(rf"(?i)\r\n{name}:")), got)


def runs_of(candidates: DataFrame) -> DataFrame:
    """``candidates (file, block, at, next)`` with ``run``: the offset of the first candidate of their run.

    A run is a stretch of one split's candidates that each name the one behind them as successor, and that a
    pointer from elsewhere enters at the first only. So a run is reached as a whole or not at all, and only
    runs take part in pointer jumping: a file without magics in payloads is one run a split.
    """
    split = Window.partitionBy("file", "block").orderBy("at")
    c = stored(candidates.withColumn("close", F.col("next").eqNullSafe(F.lead("at").over(split))), "warc-close")
    targets = c.filter(~F.col("close")).select("file", F.col("next").alias("at")).distinct().withColumn("target", F.lit(True))
    c = c.join(targets, ["file", "at"], "left")
    first = F.col("target").isNotNull() | ~F.coalesce(F.lag("close").over(split), F.lit(False))
    c = c.withColumn("first", first)
    so_far = split.rowsBetween(Window.unboundedPreceding, 0)
    return c.select("file", "at", "next", F.max(F.when(F.col("first"), F.col("at"))).over(so_far).alias("run"))


def reachable(candidates: DataFrame) -> DataFrame:
    """``(file, at)`` of the records on the chain from each file's start, by pointer jumping.

    ``candidates`` is a stored table ``(file, at, next)``. Each round doubles the length of every pointer
    and adds what the records found so far point to, so a chain of n records takes log2(n) rounds. Pointers
    that leave the candidates end there.
    """
    found = candidates.filter("at = 0").select("file", "at")
    jump = candidates
    known = found.count()
    while known:
        target = jump.select("file", F.col("at").alias("at"), F.col("next").alias("to"))
        ends = candidates.select("file", F.col("at").alias("to"))
        jump = target.join(ends, ["file", "to"]).select("file", "at", F.col("to").alias("next"))
        ahead = found.join(jump, ["file", "at"]).select("file", F.col("next").alias("at"))
        found = stored(found.union(ahead).distinct(), "warc-found")
        n = found.count()
        if n == known:
            break
        known = n
        hop = jump.select("file", F.col("at").alias("next"), F.col("next").alias("after"))
        jump = stored(jump.join(hop, ["file", "next"]).select("file", "at", F.col("after").alias("next")), "warc-jump")
    return found


def read(spark: SparkSession, path: str, payload: bool = True) -> DataFrame:
    """The records of all archives below ``path``: file, at, type, record_id, url, refers_to, http (header),
    digest and size as the headers state them, payload_bytes and payload_digest of the payload itself, and
    with ``payload`` the payload (binary).

    Records end where their header says. Bytes that no chain from a file's start reaches are no records; a
    record cut off by the file's end is dropped. An empty folder gives no rows. Payloads are shuffled only
    if they are asked for, or if they hold a magic and so were read in several pieces.
    """
    values, places = _pieces(spark, path)
    sep = len(MAGIC)
    length = field(F.col("head"), "Content-Length").try_cast("long")
    cand = places.filter("at >= 0").select("file", "block", "id", "at", "size", "head", length.alias("length"))
    succ = F.col("at") + sep + F.octet_length("head") + 4 + F.col("length") + 4
    light = cand.filter("head IS NOT NULL AND length >= 0").select("file", "block", "at", succ.alias("next"))
    light = stored(runs_of(light), "warc-candidates")
    runs = stored(light.groupBy("file", F.col("run").alias("at")).agg(F.max_by("next", "at").alias("next")), "warc-runs")
    found = reachable(runs).withColumnRenamed("at", "run")
    real = light.join(found, ["file", "run"]).select("file", "at", F.lit(True).alias("real"))
    marked = stored(places.filter("at >= 0").select("file", "id", "at").join(real, ["file", "at"], "left"), "warc-marked")
    # a rejected piece belongs to the record before it; a record's pieces are put together again
    rejected = marked.filter("real IS NULL").select("file").distinct()
    owner = Window.partitionBy("file").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    parts = (marked.join(rejected, "file", "left_semi")
             .withColumn("start", F.max(F.when(F.col("real"), F.col("at"))).over(owner)).filter("start IS NOT NULL"))
    parts = stored(parts.select("id", "file", "start", "at"), "warc-parts")
    several = parts.groupBy("file", "start").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("file", "start")
    wanted = ["file", "at", "type", "record_id", "url", "refers_to", "http", "digest", "size", "payload_bytes", "payload_digest",
              *["payload"] * payload]
    single = marked.filter("real").join(several.withColumnRenamed("start", "at"), ["file", "at"], "left_anti")
    whole = _parsed(values.select("id", "value"), ["id"]).join(single.select("id", "file", "at"), "id").select(*wanted)
    joined = (parts.join(several, ["file", "start"], "left_semi").join(values, "id").groupBy("file", F.col("start").alias("at"))
              .agg(F.array_sort(F.collect_list(F.struct(F.col("at").alias("k"), "value"))).alias("p"))
              .select("file", "at", F.array_join(F.transform("p", lambda x: x["value"]), MAGIC).alias("value")))
    return whole.unionByName(_parsed(joined, ["file", "at"]).select(*wanted))


def _parsed(records: DataFrame, keep: list[str]) -> DataFrame:
    """The fields of whole records from their text behind the magic; texts that are none are left out."""
    head = F.substring_index("value", CRLF + CRLF, 1)
    r = records.select(*keep, head.alias("head"), F.col("value").cast("binary").alias("body"))
    r = r.select(*keep, "head", field(F.col("head"), "Content-Length").try_cast("int").alias("length"),
                 F.expr("substring(body, octet_length(head) + 5)").alias("rest"))
    r = r.filter(F.octet_length("rest") >= F.col("length"))
    r = r.select(*keep, "head", F.expr("substring(rest, 1, length)").alias("block"))
    r = r.select(*keep, "head", "block", F.substring_index(F.col("block").cast("string"), CRLF + CRLF, 1).alias("http"))
    r = r.select(*keep, "head", "http", F.expr("substring(block, octet_length(http) + 5)").alias("payload"))
    return r.select(
        *keep, field(F.col("head"), "WARC-Type").alias("type"), field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _unescape(field(F.col("head"), "WARC-Target-URI")).alias("url"), field(F.col("head"), "WARC-Refers-To").alias("refers_to"),
        F.substring_index(field(F.col("head"), "WARC-Payload-Digest"), ":", -1).alias("digest"), "http",
        field(F.col("http"), "Content-Length").try_cast("long").alias("size"),
        F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "payload")


def page_of(record: Column) -> Column:
    return F.regexp_extract(record, r"^<urn:page:(-?\d*)>", 1).try_cast("long")


def round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages to archives in the shared folder, read them back, and return one row a record: page_id,
    payload_bytes, payload_digest, record_type, refers_to. A response's bytes and digest are those of the
    payload read; a revisit has no payload, its header states them."""
    spark = pages.sparkSession
    path = shared_path(spark, "archives")
    write(pages, path)
    r = read(spark, path, payload=False)
    response = F.col("type") == "response"
    return r.select(page_of(F.col("record_id")).alias("page_id"),
                    F.when(response, F.col("payload_bytes")).otherwise(F.col("size")).alias("payload_bytes"),
                    F.when(response, F.col("payload_digest")).otherwise(F.col("digest")).alias("payload_digest"),
                    F.col("type").alias("record_type"), page_of(F.col("refers_to")).alias("refers_to"))
