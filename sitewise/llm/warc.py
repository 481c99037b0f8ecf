"""A content-addressed web archive.

Two tables stand for the archive files. ``payloads`` keeps each distinct payload once under
its SHA-256; ``records`` keeps every record's exact header bytes and the digest of its
payload. A join on the digest gives the original records back, and each payload is
verified against its address on reading.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..shared import materialize

#: Fixed strings of the WARC 1.1 format.
CRLF = "\r\n"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Payloads below this many bytes are never revisited.
MIN_REVISIT_BYTES = 1000
#: Up to so many digests with copies, some 100 bytes each, are broadcast.
MAX_BROADCAST_KEEPERS = 100_000


def _field(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(CRLF))


def _header(date: str) -> Column:
    """Exact header block of a record, with the empty line that ends it."""
    one_line = F.regexp_replace(F.coalesce(F.col("url"), F.lit("")), r"[\x00-\x20]", "%20")
    page = lambda c: F.concat(F.lit("<urn:page:"), F.coalesce(F.col(c).cast("string"), F.lit("null")), F.lit(">"))
    revisit = F.col("record_type") == "revisit"
    return F.concat(
        F.lit(VERSION + CRLF), _field("WARC-Type", F.col("record_type")), _field("WARC-Record-ID", page("page_id")),
        _field("WARC-Date", F.lit(date)), _field("WARC-Target-URI", one_line),
        _field("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("sha1"))),
        F.when(revisit, F.concat(_field("WARC-Profile", F.lit(REVISIT_PROFILE)), _field("WARC-Refers-To", page("keeper")))).otherwise(F.lit("")),
        _field("Content-Type", F.lit("text/html")),
        _field("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n_bytes")).cast("string")), F.lit(CRLF),
    )


def write_archive(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", date: str = "2000-01-01T00:00:00Z") -> None:
    """Write a record for each row of ``pages`` below ``path``.

    Of the records with equal payloads of MIN_REVISIT_BYTES or more, the largest id is the
    response and the others revisit it; shorter ones are all responses. A null html is an
    empty payload, a null url an empty one. Rows that repeat the largest id with the same
    payload are all responses. An empty table gives empty tables.
    """
    payload = F.encode(F.coalesce(F.col(html_col), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), payload.alias("payload")).select(
        "page_id", "url", "payload", F.sha2("payload", 256).alias("digest"), F.sha1("payload").alias("sha1"), F.length("payload").alias("n_bytes"))
    # The keeper of each digest: counts are summed before each shuffle, so a payload of a
    # third of all pages sends one row per task. Only digests with copies are looked up.
    keepers = (
        rows.groupBy("digest", "page_id").agg(F.count("*").alias("n"))
        .groupBy("digest").agg(F.max("page_id").alias("keeper"), F.sum("n").alias("copies"), F.max_by("n", "page_id").alias("n_keeper"))
        .where("copies > 1")
    )
    keepers = materialize(keepers, "warc-keepers")
    if keepers.count() <= MAX_BROADCAST_KEEPERS:  # else the payloads are shuffled to their keepers
        keepers = F.broadcast(keepers)
    marked = rows.join(keepers, "digest", "left").withColumn(
        "record_type", F.when((F.col("copies") > 1) & (F.col("n_bytes") >= MIN_REVISIT_BYTES) & ~F.col("page_id").eqNullSafe(F.col("keeper")), "revisit").otherwise("response"))
    marked.select("digest", F.encode(_header(date), "UTF-8").alias("header")).write.option("compression", "zstd").parquet(f"{path}/records")
    first = marked.where("copies is null or page_id <=> keeper")
    once = first.where("copies is null or n_keeper = 1").select("digest", "payload")
    again = first.where("copies is not null and not n_keeper <=> 1").select("digest", "payload").dropDuplicates(["digest"])
    once.unionByName(again).write.option("compression", "zstd").parquet(f"{path}/payloads")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """(header, payload, record) of every record: its exact header, full payload and exact bytes.

    A payload that does not match its address (SHA-256) or its header's digest (SHA-1) raises
    an error.
    """
    records = spark.read.schema("digest string, header binary").parquet(f"{path}/records")
    payloads = spark.read.schema("digest string, payload binary").parquet(f"{path}/payloads")
    checked = payloads.withColumn("payload", F.when(F.sha2("payload", 256) == F.col("digest"), F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its address "), F.col("digest")))))
    end = F.encode(F.lit(CRLF + CRLF), "UTF-8")
    block = F.when(header_field("WARC-Type") == "revisit", F.encode(F.lit(""), "UTF-8")).otherwise(F.col("payload"))
    named = F.concat(F.lit("sha1:"), F.sha1("payload"))
    same = records.join(checked, "digest").withColumn("payload", F.when(header_field("WARC-Payload-Digest") == named, F.col("payload")).otherwise(
        F.raise_error(F.concat(F.lit("payload does not match its header's digest, "), named))))
    return same.select("header", "payload", F.concat("header", block, end).alias("record"))


def header_field(name: str) -> Column:
    """A named field of the header, null where it is not there."""
    found = F.regexp_extract(F.decode("header", "UTF-8"), rf"(?m)^{name}: ([^\r\n]*)\r?$", 1)
    return F.when(found != "", found)


def page_of(urn: Column) -> Column:
    return F.regexp_extract(urn, "^<urn:page:(.*)>$", 1).try_cast("long")
