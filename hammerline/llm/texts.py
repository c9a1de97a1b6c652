"""Column expressions shared by the corpus operators."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# A word is a run of anything but the ASCII blanks.
BLANKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"

# What a batch handed to Python may hold, while whole texts are: rows and bytes.
BATCHES = {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000", "spark.sql.execution.arrow.maxBytesPerBatch": "8m"}


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Whole texts go to Python in small batches while tables are written inside.

    A batch stands in memory several times over, outside Spark's heap; the usual ten thousand
    rows are meant for narrow columns.
    """
    before = {key: spark.conf.get(key, None) for key in BATCHES}
    for key, value in BATCHES.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def filled(text: str | Column = "text") -> Column:
    """The text, with NULL as the empty text."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z and nothing else; whole-string ``lower`` serves where both agree."""
    plain = F.octet_length(text) == F.length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, UPPER.lower()))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")
