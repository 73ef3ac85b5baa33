"""Content-addressed web archive: payloads once by digest, record headers apart.

``write_archive`` makes one WARC record per page. Its exact header bytes go to ``records``;
payload bytes go to ``payloads``, once per SHA-256. A digest is trusted only after all payloads
that have it proved alike in length and in a second hash. ``read_archive`` parses the headers,
hashes every stored payload again and joins both; ``restore`` gives whole records as bytes and
``pages`` the rows that went in.

Of the records with one payload of at least ``SMALL`` bytes, that of the smallest page_id (null
last, then by url) is the response and the others revisit it; smaller payloads are always
responses. Rows alike in id, url and payload are records of their own: the first is the
response, the others revisit it. Null html is an empty payload, a record without url or
page_id has no such header line. Line breaks in urls are escaped, since a header is one line.
Other columns are not read. No rows, no records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ticketlake.llm.text import materialize
from ticketlake.session import Scratch

#: Bytes from which a payload is worth a revisit.
SMALL = 100
CRLF = "\r\n"
#: Fixed values of the format.
VERSION, REVISIT = "WARC/1.1", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _rows(pages: DataFrame) -> DataFrame:
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    return pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.regexp_replace(F.regexp_replace(F.col("url").cast("string"), "\r", "%0D"), "\n", "%0A").alias("url"),
        payload.alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))


def _line(name: str, value: Column) -> Column:
    """A header line, absent for null."""
    return F.coalesce(F.concat(F.lit(f"{name}: "), value, F.lit(CRLF)), F.lit(""))


def _record_id(digest: str, page_id: str, url: str, copy: Column) -> Column:
    """The same id whenever the same record is written: 128 bits of a hash of what it says."""
    said = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (digest, page_id, url)]
    missing = [F.col(c).isNull().cast("string") for c in (page_id, url)]
    h = F.sha2(F.concat_ws("\n", *said, *missing, copy.cast("string")).cast("binary"), 256)
    parts = [F.substring(h, i, n) for i, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def _headers(rows: DataFrame, date: str) -> DataFrame:
    """Header bytes of records: (digest, warc, http)."""
    text = lambda c: F.col(c).cast("string")
    http = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        text("bytes"), F.lit(CRLF * 2),
    )
    revisit = F.col("record_type") == "revisit"
    if_revisit = lambda c: F.when(revisit, c)
    block = F.octet_length(http) + F.when(revisit, 0).otherwise(F.col("bytes"))
    warc = F.concat(
        F.lit(VERSION + CRLF),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", _record_id("digest", "page_id", "url", F.col("copy"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", F.col("url")),
        _line("WARC-Page-ID", text("page_id")),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _line("WARC-Profile", if_revisit(F.lit(REVISIT))),
        _line("WARC-Refers-To", if_revisit(_record_id("digest", "first_id", "first_url", F.lit(1)))),
        _line("WARC-Refers-To-Target-URI", if_revisit(F.col("first_url"))),
        _line("WARC-Refers-To-Page-ID", if_revisit(text("first_id"))),
        _line("Content-Type", F.lit("application/http; msgtype=response")),
        _line("Content-Length", block.cast("string")),
        F.lit(CRLF),
    )
    return rows.select("digest", warc.cast("binary").alias("warc"), http.cast("binary").alias("http"))


def write_archive(pages: DataFrame, target: str, date: str, scratch: Scratch | None = None) -> None:
    """Write ``pages`` (page_id, url, html) as an archive below ``target``.

    Payloads cross one shuffle, after each task kept one copy per digest; everything about
    records is decided on thin rows. A digest that a third of the pages share is one row per
    task there, and its records meet the response's row in a join whose large side may be split.
    """
    scratch = scratch or Scratch()
    rows = _rows(pages)
    alike = F.max(F.length("payload")) == F.min(F.length("payload"))
    second = F.xxhash64("payload", F.lit(1))
    stored = rows.groupBy("digest").agg(
        F.any_value("payload").alias("payload"), (alike & (F.max(second) == F.min(second))).alias("_alike")
    )
    clash = F.raise_error(F.concat(F.lit("different payloads with digest "), F.col("digest")))
    stored = stored.select("digest", F.when(F.col("_alike"), F.col("payload")).otherwise(clash.cast("binary")).alias("payload"))
    stored.write.parquet(f"{target}/payloads")

    groups = rows.groupBy("digest", F.length("payload").cast("long").alias("bytes"), "page_id", "url").agg(
        F.count("*").alias("copies")
    )
    groups = materialize(groups, "records", scratch)
    rank = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNull().alias("no_url"), "url")
    firsts = groups.filter(F.col("bytes") >= SMALL).groupBy("digest").agg(
        F.min(rank).alias("first"), F.sum("copies").alias("_n")
    )
    firsts = firsts.filter("_n > 1").select(
        "digest", F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"), F.lit(True).alias("_shared")
    )
    same = F.col("page_id").eqNullSafe(F.col("first_id")) & F.col("url").eqNullSafe(F.col("first_url"))
    records = groups.join(firsts, "digest", "left")
    records = records.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    revisit = F.coalesce(F.col("_shared"), F.lit(False)) & ~(same & (F.col("copy") == 1))
    records = records.withColumn("record_type", F.when(revisit, "revisit").otherwise("response"))
    _headers(records, date).write.parquet(f"{target}/records")


def _header(name: str, headers: Column) -> Column:
    """Value of a header line, null if there is none."""
    found = F.regexp_extract(headers, f"\r\n{name}: ([^\r\n]*)\r\n", 1)
    return F.when(headers.contains(f"\r\n{name}: "), found)


def _stored(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema("digest string, payload binary").parquet(f"{target}/payloads")


def _records(spark: SparkSession, target: str) -> DataFrame:
    return spark.read.schema("digest string, warc binary, http binary").parquet(f"{target}/records")


def read_archive(spark: SparkSession, target: str) -> DataFrame:
    """(page_id, url, record_id, record_type, refers_to, payload_digest, payload_bytes) per record.

    Digest and length are those of the stored bytes, hashed again; a record whose header
    promises another digest, or whose payload is missing, stops the read.
    """
    headers = F.col("warc").cast("string")
    parsed = _records(spark, target).select(
        F.substring(_header("WARC-Payload-Digest", headers), 8, 64).alias("_promised"),
        _header("WARC-Page-ID", headers).cast("long").alias("page_id"),
        _header("WARC-Target-URI", headers).alias("url"),
        _header("WARC-Record-ID", headers).alias("record_id"),
        _header("WARC-Type", headers).alias("record_type"),
        _header("WARC-Refers-To-Page-ID", headers).cast("long").alias("refers_to"),
    )
    again = _stored(spark, target).select(
        F.sha2("payload", 256).alias("payload_digest"), F.length("payload").cast("long").alias("payload_bytes")
    )
    joined = parsed.join(again, parsed["_promised"] == again["payload_digest"], "left")
    lost = F.raise_error(F.concat(F.lit("no payload with digest "), F.col("_promised"))).cast("string")
    digest = F.coalesce(F.col("payload_digest"), lost)
    return joined.withColumn("payload_digest", digest).drop("_promised")


def restore(spark: SparkSession, target: str) -> DataFrame:
    """(digest, record): the records' bytes as they stand in a WARC file."""
    joined = _records(spark, target).join(_stored(spark, target), "digest")
    revisit = F.col("warc").cast("string").contains(f"{CRLF}WARC-Type: revisit{CRLF}")
    payload = F.when(revisit, F.lit(b"")).otherwise(F.col("payload"))
    return joined.select("digest", F.concat("warc", "http", payload, F.lit((CRLF * 2).encode())).alias("record"))


def pages(spark: SparkSession, target: str) -> DataFrame:
    """(page_id, url, html) of every record, revisits with the payload they refer to."""
    thin = read_archive(spark, target).select("page_id", "url", F.col("payload_digest").alias("digest"))
    return thin.join(_stored(spark, target), "digest").select("page_id", "url", F.col("payload").cast("string").alias("html"))
