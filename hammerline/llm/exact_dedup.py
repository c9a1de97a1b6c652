"""Exact duplicates: two-pass Bloom filtering, so that only possibly repeated rows shuffle.

Pass one counts, for every text digest, how often each of its two filter positions is hit,
and keeps the positions hit twice or more as a bitmap. Pass two probes the bitmap: a digest
with a position hit once is certainly unique and its row goes straight to the result. Only
the other rows are shuffled, grouped and decided. False positives cost a shuffle of a narrow
row, never an answer.

The bitmap has at most ``MAX_BITS`` bits whatever the input, which bounds its broadcast;
past about ``MAX_BITS / 8`` rows more and more unique rows take the shuffled way as well.

Defined cases: NULL text is the empty text; a NULL id is smaller than any other; of rows with
equal id and equal text exactly one stays; an empty table gives an empty result; columns other
than the id and the text are carried by :func:`keep_first` and ignored by :func:`decide`.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.llm.texts import filled, lower_ascii
from hammerline.session import write_table

# Bits of the filter: at most so many (16 MiB), and so many for each row below that.
MAX_BITS = 1 << 27
BITS_PER_ROW = 32
# Bits in one bitmap of bitmap_construct_agg.
PAGE = 32_768


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with A-Z lower-cased, as lowercase hex."""
    return F.sha2(lower_ascii(filled(text)), 256)


def _positions(digest: Column, bits: int) -> list[Column]:
    return [F.pmod(F.xxhash64(digest, F.lit(salt)), F.lit(bits)) for salt in (1, 2)]


def filter_bits(rows: int) -> int:
    """A power of two between one page and MAX_BITS."""
    return min(MAX_BITS, max(PAGE, 1 << math.ceil(math.log2(max(1, rows * BITS_PER_ROW)))))


def repeated_pages(digests: DataFrame, digest: str, bits: int, least: int = 2) -> DataFrame:
    """Pass one: (page, bitmap) of the positions that two (``least``) or more rows hit.

    Counting is pre-aggregated in each task, so a digest that fills a third of the table
    sends one row per task.
    """
    hits = digests.select(F.explode(F.array(*_positions(F.col(digest), bits))).alias("at"))
    twice = hits.groupBy("at").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return twice.groupBy(F.floor(F.col("at") / PAGE).alias("page")).agg(
        F.bitmap_construct_agg(F.col("at") % PAGE).alias("bitmap")
    )


def _bit(bitmap: Column, at: Column) -> Column:
    """The bit at a position of a bitmap; a missing bitmap has none set."""
    offset = (at % PAGE).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(offset / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.shiftright(byte, 0).bitwiseAND(F.pow(F.lit(2), offset % 8).cast("int")) != 0, F.lit(False))


def probe(rows: DataFrame, pages: DataFrame, digest: str, bits: int) -> DataFrame:
    """Pass two: adds ``maybe``, false only where the digest is certainly unique."""
    first, second = _positions(F.col(digest), bits)
    rows = rows.withColumns({"_at1": first, "_at2": second})
    for n in ("1", "2"):
        page = F.broadcast(pages.select(F.col("page").alias(f"_page{n}"), F.col("bitmap").alias(f"_bitmap{n}")))
        rows = rows.join(page, F.floor(F.col(f"_at{n}") / PAGE) == F.col(f"_page{n}"), "left")
    maybe = _bit(F.col("_bitmap1"), F.col("_at1")) & _bit(F.col("_bitmap2"), F.col("_at2"))
    return rows.withColumn("maybe", maybe).drop(*(f"_{c}{n}" for c in ("at", "page", "bitmap") for n in ("1", "2")))


def decide(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are read once; everything after works on (row, id, digest).
    """
    narrow = write_table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            text_digest(F.col(text_col)).alias("text_sha256"),
        ),
        "digests",
    )
    bits = filter_bits(narrow.count())
    probed = probe(narrow, repeated_pages(narrow, "text_sha256", bits), "text_sha256", bits)
    alone = probed.where(~F.col("maybe")).select(
        "id", F.col("id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256"
    )
    again = probed.where("maybe").drop("maybe")
    groups = again.groupBy("text_sha256").agg(
        F.max(F.struct("id", "row")).alias("keep"), F.count("*").alias("group_size")
    )
    # Written, so that both sides of the join are shuffled anew and a hot group can be split.
    groups = write_table(groups, "groups")
    decided = again.join(groups, "text_sha256").select(
        "id", F.col("keep.id").alias("keep_id"), "group_size", (F.col("row") == F.col("keep.row")).alias("kept"), "text_sha256"
    )
    return alone.unionByName(decided).withColumnRenamed("id", id_col)


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns: of equal texts the one with the largest id.

    Certainly unique rows are not shuffled. The others are cut to the winner's (digest, id)
    before their wide rows meet; identical rows are reduced to one.
    """
    whole = docs.select(F.struct("*").alias("doc"), F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("digest"))
    narrow = write_table(whole.select("id", "digest"), "digests")
    bits = filter_bits(narrow.count())
    pages = write_table(repeated_pages(narrow, "digest", bits), "pages")
    winners = probe(narrow, pages, "digest", bits).where("maybe").groupBy("digest").agg(F.max("id").alias("keep_id"))
    # Written, so that a hot text can be split in the join.
    winners = write_table(winners, "winners")
    probed = probe(whole, pages, "digest", bits)
    alone = probed.where(~F.col("maybe")).select("doc")
    again = probed.where("maybe").join(winners, "digest").where(F.col("id").eqNullSafe(F.col("keep_id")))
    return alone.unionByName(again.dropDuplicates(["digest"]).select("doc")).select("doc.*")
