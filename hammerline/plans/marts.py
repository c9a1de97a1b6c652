"""Staging, intermediate and mart models (P8, U1, J2-J5, A5, P9, P10; entry point B)."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.functions.sales import pct_deviation, rookie, surrogate_key
from hammerline.operators.resolve import resolve_dim
from hammerline.operators.rolling import DIM_KEYS, HOT_ROWS, rolling_by_rows
from hammerline.session import is_small, left_join_spread_nulls, scratch_scope, shuffles_dropped, write_table
from hammerline.sources import sinks
from hammerline.sources.layouts import (
    BUCKET_ROWS,
    FILE_BYTES,
    Buckets,
    bucket_number,
    open_bucketed,
    save_bucketed,
    save_clustered,
    table_size,
)
from hammerline.sources.scans import Layout, grade_table, scan_seed

STAGING = [
    ("source_listing_id", "listing_id", "string"),
    ("sale_price_usd", "sale_price_usd", "decimal(12,2)"),
    ("sale_date", "sale_date", "date"),
    ("scraped_at", "scraped_at", "timestamp"),
    ("ingested_at", "ingested_at", "timestamp"),
    ("listing_title", "listing_title", None),
    ("fighter_name", "fighter_name", None),
    ("fighter_name_canonical", "fighter_name_canonical", None),
    ("card_year", "card_year", None),
    ("card_set", "card_set", None),
    ("card_number", "card_number", None),
    ("grade", "grade", None),
    ("grader", "grader", None),
    ("grade_numeric", "grade_numeric", "double"),
    ("listing_url", "listing_url", "string"),
    ("sale_type", "sale_type", None),
    ("is_outlier", "is_outlier", "boolean"),
    ("sport", "sport", None),
    ("record_hash", "record_hash", None),
]

CARD_KEYS = ["card_year", "card_set", "card_number"]


def _staging_columns() -> list[Column]:
    return [(F.col(base) if kind is None else F.col(base).cast(kind)).alias(name) for name, base, kind in STAGING]


def staged(
    raw: DataFrame, source: str, as_of: Column | None = None, reject_future: bool | None = None
) -> DataFrame:
    """P8 + F4: the staging model of one source.

    The filters name base columns only, so they reach the Parquet scan.
    """
    today = F.current_date() if as_of is None else as_of
    keep = (F.col("sale_price_usd") > 0) & F.col("sale_date").isNotNull() & ~F.col("is_outlier")
    if fixed.REJECT_FUTURE[source] if reject_future is None else reject_future:
        keep = keep & (F.col("sale_date") <= today)
    return raw.where(keep).select(
        *_staging_columns(),
        F.lit(source).alias("source"),
        F.lit(fixed.MART_PREMIUM[source]).alias("has_buyer_premium"),
    )


def unioned(stages: list[DataFrame]) -> DataFrame:
    """All sources, with the sale key."""
    every = reduce(DataFrame.unionByName, stages)
    return every.withColumn("sale_id", surrogate_key("source", "source_listing_id"))


def staged_sales(enriched: DataFrame, as_of: Column | None = None) -> DataFrame:
    """P8 + F4 + U1 in one scan: the per-source constants are chosen per row.

    Same rows as the union of the three staging models, which would scan three times.
    """
    today = F.current_date() if as_of is None else as_of
    source = F.col("source")
    guarded = [s for s in fixed.STAGED_SOURCES if fixed.REJECT_FUTURE[s]]
    premium = [s for s in fixed.STAGED_SOURCES if fixed.MART_PREMIUM[s]]
    keep = (
        source.isin(fixed.STAGED_SOURCES)
        & (F.col("sale_price_usd") > 0)
        & F.col("sale_date").isNotNull()
        & ~F.col("is_outlier")
        & (~source.isin(guarded) | (F.col("sale_date") <= today))
    )
    return enriched.where(keep).select(
        *_staging_columns(),
        "source",
        source.isin(premium).alias("has_buyer_premium"),
        surrogate_key("source", F.col("listing_id").cast("string")).alias("sale_id"),
    )


def dim_fighter(seed: DataFrame) -> DataFrame:
    """Entity dimension, one row per alias; ``canonical_fighter_id`` groups the aliases."""
    return seed.select(
        surrogate_key("fighter_name_canonical", "fighter_name_alias").alias("fighter_id"),
        "fighter_name_canonical",
        "fighter_name_alias",
        "sport",
        "nationality",
        "promotion",
        "active",
        "debut_year",
        surrogate_key("fighter_name_canonical").alias("canonical_fighter_id"),
    )


def dim_grade(spark: SparkSession) -> DataFrame:
    return grade_table(spark)


def dim_card(resolved: DataFrame, entities: DataFrame, per_fighter: bool = False) -> DataFrame:
    """A5 + J5 + P10: distinct cards with a rookie flag.

    Default is one row per card, a rookie card when any of its entities debuted that
    year. ``per_fighter`` keeps a row per (card, entity), where the key may repeat.
    """
    cards = resolved.dropna(subset=CARD_KEYS).select(*CARD_KEYS, "fighter_id").distinct()
    debuts = entities.select("fighter_id", "debut_year")
    joined = left_join_spread_nulls(cards, debuts, ["fighter_id"], F.struct(*CARD_KEYS))
    flagged = joined.select(
        surrogate_key(*CARD_KEYS).alias("card_id"),
        *CARD_KEYS,
        rookie("card_year", "debut_year").alias("is_rookie"),
    )
    if per_fighter:
        return flagged
    return flagged.groupBy("card_id", *CARD_KEYS).agg(F.bool_or("is_rookie").alias("is_rookie"))


def join_card(sales: DataFrame, cards: DataFrame, co_located: bool = False) -> DataFrame:
    """Card key by year, set and number; sales lacking one of them get NULL.

    ``co_located`` sides are bucketed by these keys and are joined where they lie.
    """
    right = cards.select("card_id", *CARD_KEYS)
    if co_located:
        return sales.join(right, CARD_KEYS, "left")
    return left_join_spread_nulls(sales, right, CARD_KEYS, F.struct(*sales.columns))


def derive_card(sales: DataFrame) -> DataFrame:
    """J3 without a join: a card dimension built from these sales holds every complete
    card of theirs, and its key is a function of the three columns."""
    complete = F.lit(True)
    for key in CARD_KEYS:
        complete = complete & F.col(key).isNotNull()
    return sales.withColumn("card_id", F.when(complete, surrogate_key(*CARD_KEYS)))


def join_grade(sales: DataFrame, grades: DataFrame, raw_match: bool = False) -> DataFrame:
    """Grade key by grader and number; the grades are broadcast if they are measured small.

    By default the upper-cased grader is compared with the label as is, so "Raw" never
    matches; ``raw_match`` compares both upper-cased and NULL numbers as equal.
    """
    g = grades.select(
        F.col("grade_id"), F.col("grader").alias("_g"), F.col("grade_numeric").alias("_n")
    )
    mine = F.upper(F.trim("grader"))
    if raw_match:
        match = (mine == F.upper("_g")) & F.col("grade_numeric").eqNullSafe(F.col("_n"))
    else:
        match = (mine == F.col("_g")) & (F.col("grade_numeric") == F.col("_n"))
    return sales.join(F.broadcast(g) if is_small(g) else g, match, "left").drop("_g", "_n")


FACT_COLUMNS = [
    "sale_id",
    "fighter_id",
    "card_id",
    "grade_id",
    "source_listing_id",
    "source",
    "sale_price_usd",
    "sale_date",
    "sale_type",
    "has_buyer_premium",
    "listing_title",
    "listing_url",
    "scraped_at",
    "ingested_at",
]


# What dimensions and fact read of resolved sales; the rest is not stored for them.
RESOLVED_COLUMNS = [c for c in FACT_COLUMNS if c not in ("card_id", "grade_id")] + [*CARD_KEYS, "grader", "grade_numeric"]


def fct_card_sales(resolved: DataFrame, grades: DataFrame, cards: DataFrame | None = None) -> DataFrame:
    """The sales fact. Pass ``cards`` when the card dimension comes from elsewhere."""
    with_card = derive_card(resolved) if cards is None else join_card(resolved, cards)
    return join_grade(with_card, grades).select(*FACT_COLUMNS)


def _fact_keys(graded: DataFrame) -> DataFrame:
    """The fact from graded sales, its sale and card keys made anew."""
    return derive_card(graded.withColumn("sale_id", surrogate_key("source", "source_listing_id"))).select(*FACT_COLUMNS)


def fct_price_benchmarks(fact: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """W4 + W5 per sale, with the deviations the serving queries read."""
    priced = fact.where(F.col("sale_price_usd").isNotNull()).select(
        "fighter_id", "grade_id", "sale_date", "sale_id", "sale_price_usd"
    )
    rolled = rolling_by_rows(priced, DIM_KEYS, hot_rows=hot_rows)
    price = F.col("sale_price_usd")
    return rolled.select(
        "fighter_id",
        "grade_id",
        F.col("sale_date").alias("benchmark_date"),
        "sale_id",
        "vwap_7d",
        "vwap_30d",
        "vwap_90d",
        "sale_count_7d",
        "sale_count_30d",
        pct_deviation(price, F.col("vwap_7d")).alias("price_pct_change_7d"),
        pct_deviation(price, F.col("vwap_30d")).alias("price_pct_change_30d"),
    )


def resolved_sales(
    enriched: DataFrame, entities: DataFrame, as_of: Column | None = None
) -> DataFrame:
    """Staging, union and alias join in one pass; ``entities`` must be materialised."""
    return resolve_dim(staged_sales(enriched, as_of), entities)


def build_marts(
    spark: SparkSession,
    layout: Layout,
    as_of: Column | None = None,
    seed: DataFrame | None = None,
    grain: str = "day",
    file_bytes: int = FILE_BYTES,
    bucket_rows: int = BUCKET_ROWS,
) -> None:
    """Entry point B: marts written as tables from the per-source raw tables; ``seed`` takes
    the place of the built-in aliases.

    The fact is bucketed by entity and grade and sorted by time, as its windows want it, so the
    benchmarks are made without shuffling it. They lie in folders by day, or by month with that
    ``grain``; with the grain "files" contiguous days share files of about ``file_bytes``, which
    is the choice for thin days.
    """
    with scratch_scope(spark), shuffles_dropped(spark):
        _build_marts(spark, layout, as_of, seed, grain, file_bytes, bucket_rows)


def read_fact(spark: SparkSession, layout: Layout) -> DataFrame:
    """The sales fact by its buckets."""
    return open_bucketed(spark, layout.mart("fct_card_sales"))


def _build_marts(
    spark: SparkSession, layout: Layout, as_of: Column | None, seed: DataFrame | None, grain: str, file_bytes: int, bucket_rows: int
) -> None:
    enriched = spark.read.parquet(layout.warehouse)
    sinks.save_mart(dim_fighter(scan_seed(spark) if seed is None else seed), layout.mart("dim_fighter"))
    entities = spark.read.parquet(layout.mart("dim_fighter"))
    sinks.save_mart(dim_grade(spark), layout.mart("dim_grade"))
    grades = spark.read.parquet(layout.mart("dim_grade"))
    with scratch_scope(spark):  # the resolved rows go once they are in the fact
        resolved = write_table(resolved_sales(enriched, entities, as_of).select(*RESOLVED_COLUMNS), "resolved")
        sinks.save_mart(dim_card(resolved, entities), layout.mart("dim_card"))
        rows = resolved.count()
        number = bucket_number(rows, bucket_rows, spark.sparkContext.defaultParallelism)
        by = Buckets(DIM_KEYS, (*DIM_KEYS, "sale_date", "sale_id"), number)
        # Of a fact its two own keys are made of other columns, after the shuffle.
        shuffled = [c for c in RESOLVED_COLUMNS if c not in ("sale_id", "grader", "grade_numeric")]
        graded = join_grade(resolved, grades).select(*shuffled, "grade_id")
        fact = save_bucketed(graded, layout.mart("fct_card_sales"), by, _fact_keys)
    bench, path = fct_price_benchmarks(fact), layout.mart("fct_price_benchmarks")
    if grain != "files":
        sinks.save_mart(bench, path, "benchmark_date", grain)
        return
    # Rows of the benchmarks are narrower than those of the fact, which bounds their files.
    size, _ = table_size(spark, layout.mart("fct_card_sales"))
    per_file = math.ceil(file_bytes * max(1, rows) / max(1, size))
    days = fact.groupBy(F.col("sale_date").alias("day")).agg(F.count("*").alias("rows"))
    save_clustered(bench, path, "benchmark_date", days, per_file, ["sale_id"], ["fighter_id", "sale_id"])
