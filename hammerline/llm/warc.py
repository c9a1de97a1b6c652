"""Content-addressed web archive: payload bytes once, exact record headers apart.

``write`` puts two tables into a folder: ``payloads`` holds each distinct payload once under its
SHA-256, ``headers`` the exact WARC header of every record with the key of its payload. ``read``
gets the records back by joining the two, checks every payload against its key, and fails on the
first that doesn't match or is missing.

Of records with equal payloads the one with the largest id is the response, the others are
revisits that refer to it. Certainly unique payloads are found with a bounded filter and are
written without a shuffle; only possibly repeated ones meet, after each task has reduced its own
copies.

Defined cases: NULL html is the empty payload, NULL url an empty target; line ends in a url are
percent-encoded; a NULL id is smaller than any other; of rows alike in id and payload one is the
response; an empty table makes an empty archive; further columns are not archived. Record ids are
made of id, url, payload and a number among rows alike in all three, so that the same pages get
the same ids however they are partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hammerline.llm.exact_dedup import filter_bits, probe, repeated_pages
from hammerline.session import scratch_path, write_table

# The alphabet of base32, and the names of the record format.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = "\r\n"
# Payloads below so many bytes are stored as responses even when equal.
LEAST_BYTES = 0
# Rows alike in everything are numbered in so many parts.
SLICES = 1024
CAPTURED = "2024-01-01T00:00:00Z"


def base32(hex_digits: Column) -> Column:
    """Base32 of 160 bits given as 40 hex digits: four groups of 40 bits, eight letters each."""
    letters = []
    for group in range(4):
        bits = F.conv(F.substring(hex_digits, 10 * group + 1, 10), 16, 10).cast("long")
        for letter in range(8):
            at = F.shiftright(bits, 35 - 5 * letter).bitwiseAND(F.lit(31)).cast("int") + 1
            letters.append(F.substring(F.lit(BASE32), at, F.lit(1)))
    return F.concat(*letters)


def payload_digest(payload: Column) -> Column:
    """The bare SHA-1 of a payload in base32."""
    return base32(F.sha1(payload))


def _uuid(*parts: Column) -> Column:
    # JSON keeps a missing part apart from an empty one, and one part from the next.
    digits = F.md5(F.to_json(F.array(*(p.cast("string") for p in parts))))
    cuts = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *(F.substring(digits, a, n) for a, n in cuts)), F.lit(">"))


def _line(name: str, value: Column | str) -> Column:
    return F.concat(F.lit(f"{name}: "), F.lit(value) if isinstance(value, str) else value, F.lit(END))


def http_header(size: Column) -> Column:
    start = f"HTTP/1.1 200 OK{END}Content-Type: text/html; charset=utf-8{END}Content-Length: "
    return F.concat(F.lit(start), size.cast("string"), F.lit(END + END))


def headers_of(records: DataFrame) -> Column:
    """The exact header of each record, with the empty line that ends it."""
    target = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    block = F.octet_length(http_header(F.col("payload_bytes"))) + F.col("payload_bytes")
    response = F.col("record_type") == "response"
    length = F.when(response, block).otherwise(F.lit(0))
    refers = F.when(response, F.lit("")).otherwise(
        F.concat(_line("WARC-Refers-To", F.col("refers_record")), _line("WARC-Profile", PROFILE))
    )
    return F.concat(
        F.lit(VERSION + END),
        _line("WARC-Type", F.col("record_type")),
        _line("WARC-Record-ID", F.col("record_id")),
        _line("WARC-Date", CAPTURED),
        _line("WARC-Target-URI", target),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha1:"), F.col("payload_digest"))),
        refers,
        _line("Content-Type", "application/http;msgtype=response"),
        _line("Content-Length", length.cast("string")),
        F.lit(END),
    )


def numbered(records: DataFrame) -> DataFrame:
    """Adds ``nth``: 0, or a number from 1 among the rows alike in id, url and payload.

    Alike rows are few, and are told by a grouping that carries counts only. Their rows are
    numbered slice by slice, from where the counts of the slices before end, so that any number of
    them has no task of its own.
    """
    alike, each = ["id", "url", "key"], ["id", "url", "key", "slice"]
    several = records.groupBy(*alike).agg(F.count("*").alias("n")).where("n > 1")
    several = write_table(several.select(F.struct(*alike).alias("alike")), "several")
    if several.isEmpty():
        return records.withColumn("nth", F.lit(0).cast("long"))
    rows = records.withColumn("alike", F.struct(*alike))
    alone = rows.join(several, "alike", "left_anti").drop("alike").withColumn("nth", F.lit(0).cast("long"))
    again = rows.join(several, "alike", "left_semi").drop("alike").withColumn("slice", F.pmod("row", F.lit(SLICES)))
    again = write_table(again, "again")
    sizes = again.groupBy(*each).agg(F.count("*").alias("n"))
    before = Window.partitionBy(*alike).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(F.struct(*each).alias("place"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"))
    starts = write_table(starts, "starts")
    placed = again.withColumn("place", F.struct(*each)).join(starts, "place")
    inside = F.row_number().over(Window.partitionBy("place").orderBy("row"))
    return alone.unionByName(placed.withColumn("nth", F.col("start") + inside).select(alone.columns))


def write(pages: DataFrame, path: str, id_col: str = "page_id", least_bytes: int = LEAST_BYTES) -> None:
    """Archive ``pages`` (id, url, html) below ``path``."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), "url", payload.alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    narrow = write_table(
        rows.select(
            F.monotonically_increasing_id().alias("row"), "id", "url", "key",
            F.octet_length("payload").cast("long").alias("payload_bytes"), payload_digest(F.col("payload")).alias("payload_digest"),
        ),
        "records",
    )
    narrow = numbered(narrow)
    first = write_table(narrow.groupBy("key").agg(F.max(F.struct("id", "url", "nth")).alias("first")), "firsts")
    records = narrow.join(first, "key")
    alone = F.struct("id", "url", "nth").eqNullSafe(F.col("first")) | (F.col("payload_bytes") < least_bytes)
    records = records.withColumns(
        {
            "record_type": F.when(alone, F.lit("response")).otherwise(F.lit("revisit")),
            "refers_to": F.when(~alone, F.col("first.id")),
            "record_id": _uuid(F.col("id"), F.col("url"), F.col("nth"), F.col("key")),
            "refers_record": _uuid(F.col("first.id"), F.col("first.url"), F.col("first.nth"), F.col("key")),
        }
    )
    header = headers_of(records).alias("header")
    records.select("id", "key", "record_type", "refers_to", header).write.parquet(f"{path}/headers")

    bits = filter_bits(narrow.count())
    pages_of_bits = write_table(repeated_pages(narrow, "key", bits), "pages")
    probed = probe(rows.select("key", "payload"), pages_of_bits, "key", bits)
    single = probed.where(~F.col("maybe")).select("key", "payload")
    several = probed.where("maybe").groupBy("key").agg(F.first("payload").alias("payload"))
    single.unionByName(several).write.option("compression", "zstd").parquet(f"{path}/payloads")


def payloads(spark: SparkSession, path: str) -> DataFrame:
    """The stored payloads, each checked against its key."""
    stored = spark.read.parquet(f"{path}/payloads")
    right = F.sha2("payload", 256) == F.col("key")
    wrong = F.raise_error(F.concat(F.lit("payload differs from its digest "), F.col("key"))).cast("binary")
    return stored.withColumn("payload", F.when(right, F.col("payload")).otherwise(wrong))


def read(spark: SparkSession, path: str) -> DataFrame:
    """The records: id, key, record_type, refers_to, header, and the exact bytes of the record.

    A response carries its HTTP header and payload, a revisit only its own header.
    """
    headers = spark.read.parquet(f"{path}/headers")
    responses = headers.where("record_type = 'response'").join(payloads(spark, path), "key", "left")
    missing = F.raise_error(F.concat(F.lit("no payload for "), F.col("key"))).cast("binary")
    responses = responses.withColumn("payload", F.coalesce("payload", missing))
    revisits = headers.where("record_type = 'revisit'").withColumn("payload", F.lit(b""))
    both = responses.withColumn("http", http_header(F.octet_length("payload"))).unionByName(
        revisits.withColumn("http", F.lit(None).cast("string"))
    )
    record = F.concat(
        F.col("header").cast("binary"), F.coalesce("http", F.lit("")).cast("binary"), F.col("payload"), F.lit(END + END).cast("binary")
    )
    return both.select("id", "key", "record_type", "refers_to", "header", "http", record.alias("record"))


def summary(spark: SparkSession, path: str, id_col: str = "page_id") -> DataFrame:
    """One row per record as read back: id, payload_bytes, payload_digest, record_type, refers_to.

    Sizes and digests are of the bytes in the restored response; a revisit has those of the
    response it refers to, found by the common payload key.
    """
    records = read(spark, path)
    start = (F.octet_length("header") + F.octet_length("http") + 1).cast("int")
    size = (F.octet_length("record") - start + 1 - len(END + END)).cast("int")
    restored = F.substring("record", start, size)
    responses = records.where("record_type = 'response'").select(
        "id", "key", "record_type", "refers_to", F.octet_length(restored).cast("long").alias("payload_bytes"),
        payload_digest(restored).alias("payload_digest"),
    )
    responses = write_table(responses, "responses")
    verified = responses.groupBy("key").agg(
        F.max("payload_bytes").alias("payload_bytes"), F.max("payload_digest").alias("payload_digest")
    )
    # Written, so that the revisits of a hot payload can be split in the join.
    verified = write_table(verified, "verified")
    revisits = spark.read.parquet(f"{path}/headers").where("record_type = 'revisit'").join(verified, "key")
    columns = ["id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    return responses.select(columns).unionByName(revisits.select(columns)).withColumnRenamed("id", id_col)


def archive(pages: DataFrame, id_col: str = "page_id") -> DataFrame:
    """Write the pages to a new archive in the shared folder, and its summary as read back."""
    spark = pages.sparkSession
    path = scratch_path(spark, "archive")
    write(pages, path, id_col)
    return summary(spark, path, id_col)
