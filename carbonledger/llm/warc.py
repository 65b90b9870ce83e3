"""Content-addressed WARC archive of web pages.

``write_archive`` turns every page into a WARC record and stores it in two
Parquet tables in a shared folder:

* ``blobs``: each distinct payload once, under its strong digest (SHA-256),
  with the SHA-1 that WARC headers carry;
* ``headers``: the exact header block of every record.  Of records with equal
  payloads of at least ``min_revisit_bytes`` bytes, the smallest page_id is the
  ``response``; the others are ``revisit`` records that refer to it.

``read_archive`` joins headers to blobs, recomputes both digests of the bytes,
fails if one differs, and returns exact records again (``record_bytes`` gives
the byte string of a record: header block, payload for responses, two line ends).

Scale: the digests are computed where the page is read; only (digest, page_id)
is aggregated (partial map-side, so a payload on a third of the pages is one row
per task); payload bytes are shuffled once to keep one copy per digest, reduced
map-side first; headers join blobs by digest, where AQE may split a hot digest.

Defined cases: null html is the empty payload; exact repeats of a row (same
page_id and url and payload) are separate records of which at most one is the
response; a null page_id sorts after all others; a null url is written as an
empty target, and line ends in a url are left out; an empty table gives an empty archive; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from .common import cut

#: The RFC 4648 base32 alphabet and the digits of ``conv`` in base 32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DIGITS32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV"
CRLF = "\r\n"
WARC_DATE = "2024-01-01T00:00:00Z"


def base32_of_hex(hexed: Column, n_chars: int = 40) -> Column:
    """Base32 of a hex string whose length is a multiple of five digits (20 bits = 4 characters)."""
    groups = [F.lpad(F.conv(F.substring(hexed, i, 5), 16, 32), 4, "0") for i in range(1, n_chars, 5)]
    return F.translate(F.concat(*groups), DIGITS32, BASE32)


def _with_payload(pages: DataFrame) -> DataFrame:
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return (pages.select("page_id", "url", body.alias("payload"))
            .withColumn("sha256", F.sha2("payload", 256))
            .withColumn("sha1", base32_of_hex(F.sha1("payload")))
            .withColumn("payload_bytes", F.octet_length("payload").cast("long")))


def build_headers(digested: DataFrame, min_revisit_bytes: int = 0) -> DataFrame:
    """One row per record with its exact header block; ``digested``: page_id, url, sha256, sha1, payload_bytes."""
    rows = digested.groupBy("sha256", "page_id", "url").agg(
        F.first("sha1").alias("sha1"), F.first("payload_bytes").alias("payload_bytes"),
        F.count(F.lit(1)).alias("n"))
    order = F.struct(F.col("page_id").isNull().alias("z"), F.col("page_id"), F.col("url"))
    # Materialised, so that a digest with a large share of the records can be split in the join.
    first = cut(rows.groupBy("sha256").agg(F.min(order).alias("first")).withColumnRenamed("sha256", "f_sha256"))
    rows = rows.join(first, F.col("sha256") == F.col("f_sha256"))
    rows = rows.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))))
    is_first = (F.col("page_id").eqNullSafe(F.col("first.page_id")) & F.col("url").eqNullSafe(F.col("first.url"))
                & (F.col("copy") == 1))
    kind = F.when(is_first | (F.col("payload_bytes") < min_revisit_bytes), "response").otherwise("revisit")
    rows = rows.withColumn("record_type", kind).withColumn(
        "refers_to", F.when(F.col("record_type") == "revisit", F.col("first.page_id")))
    ident = F.sha2(F.concat_ws("|", F.coalesce(F.col("page_id").cast("string"), F.lit("null")),
                               F.coalesce("url", F.lit("")), "sha256", F.col("copy").cast("string")), 256)
    dashed = F.concat_ws("-", *[F.substring(ident, a, b) for a, b in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))])
    line = lambda k, v: F.concat(F.lit(f"{k}: "), v, F.lit(CRLF))
    stored = F.when(F.col("record_type") == "response", F.col("payload_bytes")).otherwise(F.lit(0))
    header = F.concat(
        F.lit(f"WARC/1.1{CRLF}"), line("WARC-Type", F.col("record_type")),
        line("WARC-Record-ID", F.concat(F.lit("<urn:uuid:"), dashed, F.lit(">"))),
        line("WARC-Date", F.lit(WARC_DATE)),
        line("WARC-Target-URI", F.regexp_replace(F.coalesce("url", F.lit("")), "[\r\n]", "")),
        line("WARC-Page-ID", F.coalesce(F.col("page_id").cast("string"), F.lit(""))),
        line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), "sha1")),
        F.when(F.col("record_type") == "revisit", F.concat(
            line("WARC-Refers-To-Page-ID", F.coalesce(F.col("refers_to").cast("string"), F.lit(""))),
            line("WARC-Profile", F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")),
        )).otherwise(F.lit("")),
        line("Content-Type", F.lit("text/html")), line("Content-Length", stored.cast("string")), F.lit(CRLF))
    return rows.select("sha256", header.cast("binary").alias("header"))


def write_archive(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Write the ``headers`` and ``blobs`` tables of ``pages`` (page_id, url, html) under ``path``."""
    p = _with_payload(pages)
    build_headers(p.drop("payload"), min_revisit_bytes).write.parquet(f"{path}/headers")
    (p.groupBy("sha256").agg(F.first("payload").alias("payload"), F.first("sha1").alias("sha1"))
     .write.parquet(f"{path}/blobs"))


def _field(name: str) -> Column:
    got = F.regexp_extract(F.col("header").cast("string"), rf"(?md)^{name}: ([^\r\n]*)\r$", 1)
    return F.when(got == "", F.lit(None)).otherwise(got)


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """Records of an archive: page_id, url, record_type, refers_to, payload_digest, header, payload (verified)."""
    headers = spark.read.parquet(f"{path}/headers")
    blobs = spark.read.parquet(f"{path}/blobs")
    bad = ((F.sha2("payload", 256) != F.col("sha256")) | (base32_of_hex(F.sha1("payload")) != F.col("sha1")))
    # Each stored payload is verified once, before records are put together from it.
    blobs = blobs.withColumn("payload", F.when(bad, F.raise_error(F.concat(
        F.lit("payload does not match its digest "), "sha256")).cast("binary")).otherwise(F.col("payload")))
    claimed = _field("WARC-Payload-Digest")
    j = (headers.join(blobs.withColumnRenamed("sha1", "blob_sha1"), "sha256", "left")
         .withColumn("claimed", F.regexp_replace(claimed, "^sha1:", "")))
    wrong = F.col("payload").isNull() | ~F.col("claimed").eqNullSafe(F.col("blob_sha1"))
    checked = F.when(wrong, F.raise_error(F.concat(F.lit("record without its payload "), "sha256")).cast("binary"))
    return j.select(
        _field("WARC-Page-ID").cast("long").alias("page_id"), _field("WARC-Target-URI").alias("url"),
        _field("WARC-Type").alias("record_type"), _field("WARC-Refers-To-Page-ID").cast("long").alias("refers_to"),
        F.col("claimed").alias("payload_digest"), "header", checked.otherwise(F.col("payload")).alias("payload"))


def record_bytes() -> Column:
    """Exact bytes of a record from ``read_archive``: header block, stored block, two line ends."""
    stored = F.when(F.col("record_type") == "response", F.col("payload")).otherwise(F.lit(b""))
    return F.concat(F.col("header"), stored, F.lit(b"\r\n\r\n"))


def archive_pages(pages: DataFrame, path: str | None = None, min_revisit_bytes: int = 0) -> DataFrame:
    """Write ``pages`` as an archive (in the shared checkpoint folder by default) and read it back."""
    spark = pages.sparkSession
    path = path or scratch_folder(spark, "warc")
    write_archive(pages, path, min_revisit_bytes)
    return read_archive(spark, path)
