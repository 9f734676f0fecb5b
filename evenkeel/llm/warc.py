"""A content-addressed archive of web records.

An archive is two tables in one folder.  ``payloads`` has the bytes of each
payload once, under its SHA-256.  ``records`` has the exact header block of
each record and the digest of its payload.  A record is rebuilt by joining the
two; digests are computed anew when payloads are read, and one that doesn't
fit is an error.  Everything is DataFrame operations.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenkeel.llm.common import bitmap_of, column, whole_text, with_membership
from evenkeel.sources.workspace import written

#: From this size on, an equal payload makes a revisit record.
REVISIT_BYTES = 1000
END = "\r\n\r\n"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def record_uri(page_id: Column) -> Column:
    return F.concat(F.lit("urn:page:"), F.coalesce(page_id.cast("string"), F.lit("unnamed")))


def _line(name: str, value: Column) -> Column:
    """A header line; nothing if the value is null. Line ends in a value are escaped."""
    escaped = F.replace(F.replace(value, F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.coalesce(F.concat(F.lit(f"{name}: "), escaped, F.lit("\r\n")), F.lit(""))


def header_block(revisit: Column, page_id: Column, url: Column, refers_to: Column, sha1: Column, size: Column, date: str) -> Column:
    """The header of a record and, as its block's first part, that of the HTTP response."""
    http = F.concat(
        F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"), _line("Content-Length", size.cast("string")), F.lit("\r\n")
    )
    length = F.octet_length(http) + F.when(revisit, 0).otherwise(size)
    return F.concat(
        F.lit("WARC/1.1\r\n"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", F.concat(F.lit("<"), record_uri(page_id), F.lit(">"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), sha1)),
        _line("WARC-Refers-To", F.when(revisit, F.concat(F.lit("<"), record_uri(refers_to), F.lit(">")))),
        _line("WARC-Profile", F.when(revisit, F.lit(_PROFILE))),
        _line("Content-Type", F.lit("application/http;msgtype=response")),
        _line("Content-Length", length.cast("string")),
        F.lit("\r\n"),
        http,
    )


def write_archive(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", *,
    revisit_bytes: int = REVISIT_BYTES, date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record for each row of ``pages`` to a new archive in folder ``path``.

    Of records with equal payloads of ``revisit_bytes`` or more, that with the
    largest id is a response and the others are revisits of it; of rows with
    that same id, one.  Smaller payloads are responses all, and are stored once
    all the same.

    A null payload is empty, a null url is left out of the header, and a null
    id, smaller than any other, makes a record named ``unnamed``.  Line ends in
    a url are escaped.  Without rows both tables are empty; other columns are
    ignored.  ``date`` is that of all records.
    """
    rows = pages.select(
        column(id_col).cast("long").alias("page_id"), column(url_col).cast("string").alias("url"),
        whole_text(payload_col).cast("binary").alias("payload"),
    )
    hashed = rows.withColumn("sha256", F.sha2("payload", 256))
    facts = written(
        hashed.select(
            F.monotonically_increasing_id().alias("row"), "page_id", "url", "sha256",
            F.sha1("payload").alias("sha1"), F.octet_length("payload").cast("long").alias("size"),
        ),
        "pages",
    )
    same = facts.groupBy("sha256").agg(F.max(F.struct("page_id", "row")).alias("keep"), F.count("*").alias("rows"))
    same = written(same.filter("rows > 1").select("sha256", "keep"), "same_payload")

    joined = facts.join(same, "sha256", "left")
    revisit = F.coalesce((F.col("size") >= revisit_bytes) & (F.col("keep.row") != F.col("row")), F.lit(False))
    header = header_block(
        revisit, F.col("page_id"), F.col("url"), F.col("keep.page_id"), F.col("sha1"), F.col("size"), date
    )
    joined.select("row", header.cast("binary").alias("header"), "sha256").write.parquet(f"{path}/records")

    # A payload that surely stands alone is written where it is read; only others are brought together.
    key = F.xxhash64("sha256")
    marked = with_membership(hashed.select("sha256", "payload"), key, bitmap_of(same.select(key.alias("k")), "k"), "shared")
    once = marked.filter("shared").dropDuplicates(["sha256"])
    marked.filter("not shared").unionByName(once).select("sha256", "payload").write.parquet(f"{path}/payloads")


def read_records(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("row long, header binary, sha256 string").parquet(f"{path}/records")


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """(sha256, payload), each payload checked against its digest."""
    stored = spark.read.schema("sha256 string, payload binary").parquet(f"{path}/payloads")
    wrong = F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("sha256"))).cast("binary")
    return stored.select("sha256", F.when(F.sha2("payload", 256) == F.col("sha256"), F.col("payload")).otherwise(wrong).alias("payload"))


def _field(text: Column, pattern: str) -> Column:
    found = F.regexp_extract(text, rf"\r\n{pattern}\r\n", 1)
    return F.when(found != "", found)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(page_id, record_type, payload_bytes, payload_digest, refers_to, url), one row for each record of an archive.

    Every record is rebuilt from its header and the bytes of its payload, and
    all comes from the rebuilt bytes: the fields from its header, digest and size
    of a response from what follows the header of the HTTP response.  A revisit
    has no payload of its own; its digest and size are those of the payload it
    shares.  A digest that is not the one the header names, and a record without
    a payload, is an error.
    """
    shared = read_payloads(spark, path).select(
        "sha256", F.sha1("payload").alias("payload_digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    whole = _records(spark, path).select("sha256", F.col("record").cast("string").alias("record"))
    blank = F.lit(END)
    http = F.instr(F.col("record"), END) + len(END)
    body = F.call_function("locate", blank, F.col("record"), http) + len(END)
    payload = F.substring(F.col("record"), body, F.length("record") - body + 1 - len(END)).cast("binary")
    head = F.substring(F.col("record"), F.lit(1), http)
    parsed = whole.select("sha256", head.alias("head"), payload.alias("payload")).select(
        "sha256", "payload", _field(F.col("head"), "WARC-Type: ([a-z]+)").alias("record_type"),
        _field(F.col("head"), "WARC-Record-ID: <urn:page:(-?[0-9]+)>").alias("page_id"),
        _field(F.col("head"), "WARC-Refers-To: <urn:page:(-?[0-9]+)>").alias("refers_to"),
        _field(F.col("head"), "WARC-Target-URI: ([^\r\n]*)").alias("url"),
        _field(F.col("head"), "WARC-Payload-Digest: sha1:([0-9a-f]+)").alias("said"),
    )
    is_revisit = F.coalesce(F.col("record_type") == "revisit", F.lit(False))  # what has no payload is no record, and an error below
    own = parsed.filter(~is_revisit).withColumns({"payload_digest": F.sha1("payload"), "payload_bytes": F.octet_length("payload").cast("long")})
    others = parsed.filter(is_revisit).join(shared, "sha256", "left")
    wrong = F.raise_error(F.concat(F.lit("no payload fits the header of record "), F.coalesce("page_id", F.lit("unnamed")))).cast("string")
    return own.drop("payload").unionByName(others.drop("payload")).select(
        F.col("page_id").cast("long").alias("page_id"), "record_type", "payload_bytes",
        F.when(F.col("said") == F.col("payload_digest"), F.col("payload_digest")).otherwise(wrong).alias("payload_digest"),
        F.col("refers_to").cast("long").alias("refers_to"), "url",
    )


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(row, sha256, record): the bytes of every record. Only responses meet the payloads."""
    records = read_records(spark, path).withColumn("revisit", F.col("header").cast("string").contains("\r\nWARC-Type: revisit\r\n"))
    end = F.lit(END.encode())
    responses = records.filter("not revisit").join(read_payloads(spark, path), "sha256", "left")
    return responses.select("row", "sha256", F.concat("header", "payload", end).alias("record")).unionByName(
        records.filter("revisit").select("row", "sha256", F.concat("header", end).alias("record"))
    )


def rebuilt(spark: SparkSession, path: str) -> DataFrame:
    """(row, record) with the bytes of every record: its header, for a response its payload, and two line ends."""
    return _records(spark, path).select("row", "record")


def export_warc(spark: SparkSession, path: str, to: str, *, compression: str = "none") -> None:
    """Write the records as WARC files to folder ``to``."""
    lines = rebuilt(spark, path).select(F.expr(f"substring(record, 1, octet_length(record) - {len(END)})").cast("string"))
    lines.write.option("lineSep", END).option("compression", compression).text(to)
