"""Certificate work list."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.functions.text import cert_numbers


def found_certs(df: DataFrame, text: Column | str, *order: str) -> DataFrame:
    """Distinct certificates with the place they are first seen.

    ``order`` columns define reading order. Only (certificate, place) pairs are shuffled,
    reduced per task first; texts are read whole and stay where they are.
    """
    hits = df.select(*order, F.posexplode(cert_numbers(text)).alias("pos", "cert_number"))
    return hits.groupBy("cert_number").agg(
        F.count("*").alias("mentions"), F.min(F.struct(*order, "pos")).alias("first_seen")
    )


def with_cached(found: DataFrame, cache: DataFrame) -> DataFrame:
    """Flag certificates that were looked up before."""
    known = cache.select(F.col("cert_key").alias("cert_number"), F.lit(True).alias("_hit")).distinct()
    return found.join(known, "cert_number", "left").select(
        *found.columns, F.coalesce("_hit", F.lit(False)).alias("is_cached")
    )


def cert_totals(flagged: DataFrame) -> DataFrame:
    """Total, cached and still to fetch."""
    return flagged.agg(
        F.count("*").alias("total"),
        F.count_if("is_cached").alias("cached"),
        F.count_if(~F.col("is_cached")).alias("to_fetch"),
    )


def worklist(flagged: DataFrame, used_today: int = 0, quota: int = fixed.CERT_QUOTA) -> DataFrame:
    """V9 + T8: the next certificates to look up, first seen first, within today's quota."""
    return (
        flagged.where(~F.col("is_cached"))
        .orderBy("first_seen", "cert_number")
        .limit(max(quota - used_today, 0))
        .drop("is_cached")
    )


def preview(flagged: DataFrame, n: int = fixed.CERT_PREVIEW) -> DataFrame:
    """T8, dry run: the first certificates, cached or not."""
    return flagged.orderBy("first_seen", "cert_number").limit(n)
