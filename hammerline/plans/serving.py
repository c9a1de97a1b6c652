"""Serving queries.

All take the marts and an explicit ``as_of`` date. The benchmark mart lies in folders by day or
is clustered by day, so the date filter skips all but the day, or the trailing 90.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.operators.dedup import first_per_key
from hammerline.session import is_small

HISTORY_DAYS = 90


def latest_benchmarks(benchmarks: DataFrame, as_of: Column) -> DataFrame:
    """the last benchmark row of each (entity, grade) on the date."""
    on_date = benchmarks.where(F.col("benchmark_date") == as_of)
    return first_per_key(on_date, ["fighter_id", "grade_id"], [F.col("sale_id").desc()])


def daily_benchmarks(benchmarks: DataFrame) -> DataFrame:
    """The last benchmark row of each (entity, grade) and day."""
    return first_per_key(benchmarks, ["fighter_id", "grade_id", "benchmark_date"], [F.col("sale_id").desc()])


def with_labels(benchmarks: DataFrame, entities: DataFrame, grades: DataFrame) -> DataFrame:
    """Inner star join; the few rows of a date meet the dimensions."""
    names = entities.select(
        "fighter_id", F.col("fighter_name_canonical").alias("fighter_name"), "sport", "promotion"
    )
    return benchmarks.join(names, "fighter_id").join(grades.select("grade_id", "grade_label"), "grade_id")


def market_overview(benchmarks: DataFrame, entities: DataFrame, grades: DataFrame, as_of: Column, limit: int = 100):
    """V1: the most traded (entity, grade) pairs with at least 3 sales in the 30-day frame."""
    liquid = latest_benchmarks(benchmarks, as_of).where("sale_count_30d >= 3")
    return (
        with_labels(liquid, entities, grades)
        .orderBy(F.col("sale_count_30d").desc(), "fighter_id", "grade_label")
        .limit(limit)
        .select(
            "fighter_id",
            "fighter_name",
            "sport",
            "grade_label",
            "vwap_7d",
            "vwap_30d",
            "sale_count_30d",
            "price_pct_change_7d",
            "price_pct_change_30d",
            "benchmark_date",
        )
    )


def market_kpis(overview: DataFrame) -> DataFrame:
    """A10: distinct entities, sales and the top entity of an overview."""
    first = F.min_by("fighter_name", F.struct(-F.col("sale_count_30d"), "fighter_id", "grade_label"))
    return overview.agg(
        F.count_distinct("fighter_id").alias("unique_fighters"),
        F.coalesce(F.sum("sale_count_30d"), F.lit(0)).alias("total_sales_30d"),
        first.alias("top_fighter"),
    )


def movers(benchmarks: DataFrame, entities: DataFrame, grades: DataFrame, as_of: Column, limit: int = 20) -> DataFrame:
    """Largest absolute 7-day deviations with at least 2 sales in the 7-day frame."""
    moved = latest_benchmarks(benchmarks, as_of).where(
        (F.col("sale_count_7d") >= 2) & F.col("price_pct_change_7d").isNotNull()
    )
    return (
        with_labels(moved, entities, grades)
        .orderBy(F.abs("price_pct_change_7d").desc(), "fighter_id", "grade_label")
        .limit(limit)
        .select(
            "fighter_id", "fighter_name", "grade_label", "vwap_7d", "vwap_30d", "price_pct_change_7d", "sale_count_7d"
        )
    )


def top_movers(
    benchmarks: DataFrame,
    entities: DataFrame,
    grades: DataFrame,
    as_of: Column,
    direction: str = "both",
    limit: int = 10,
) -> DataFrame:
    """V3: the 20 largest movers first, then the direction filter and the final limit."""
    if direction not in ("up", "down", "both"):
        raise ValueError(f"direction must be up, down or both, not {direction!r}")
    if not 1 <= limit <= 20:
        raise ValueError("limit must be between 1 and 20")
    change = F.col("price_pct_change_7d")
    top = movers(benchmarks, entities, grades, as_of)
    if direction == "up":
        top, first = top.where(change > 0), change.desc()
    elif direction == "down":
        top, first = top.where(change < 0), change.asc()
    else:
        first = F.abs(change).desc()
    return top.orderBy(first, "fighter_id", "grade_label").limit(limit)


def list_fighters(benchmarks: DataFrame, entities: DataFrame, as_of: Column) -> DataFrame:
    """V4 + A4: entities with a benchmark on the date, by name."""
    on_date = latest_benchmarks(benchmarks, as_of).where("sale_count_30d >= 1")
    totals = on_date.groupBy("fighter_id").agg(
        F.max("vwap_30d").alias("vwap_30d"), F.sum("sale_count_30d").alias("sale_count_30d")
    )
    names = entities.select(
        "fighter_id", F.col("fighter_name_canonical").alias("fighter_name"), "sport", "promotion"
    )
    return names.join(totals, "fighter_id").orderBy("fighter_name", "fighter_id")


def search_fighters(
    benchmarks: DataFrame,
    entities: DataFrame,
    q: str,
    as_of: Column,
    limit: int = 20,
    like: bool = False,
) -> DataFrame:
    """V5: entities whose name contains ``q`` in any case (F9), priced where possible.

    ``%`` and ``_`` are ordinary characters unless ``like``.
    """
    if not 1 <= len(q) <= 100:
        raise ValueError("q must have 1 to 100 characters")
    name = F.lower("fighter_name_canonical")
    hit = name.like(f"%{q.lower()}%") if like else name.contains(q.lower())
    prices = (
        latest_benchmarks(benchmarks, as_of).groupBy("fighter_id").agg(F.max("vwap_30d").alias("vwap_30d"))
    )
    return (
        entities.where(hit)
        .select("fighter_id", F.col("fighter_name_canonical").alias("fighter_name"), "sport", "promotion")
        .join(prices, "fighter_id", "left")
        .orderBy("fighter_name", "fighter_id")
        .limit(limit)
    )


def fighter_metadata(entities: DataFrame, fighter_id: str) -> DataFrame:
    """Point lookup (F8)."""
    return (
        entities.where(F.col("fighter_id") == fighter_id)
        .select("fighter_id", "fighter_name_canonical", "sport", "promotion")
        .limit(1)
    )


def price_history(benchmarks: DataFrame, grades: DataFrame, as_of: Column) -> DataFrame:
    """T4 + F7: one point per entity, grade and day of the trailing 90 days.

    Reduced to the day's last row, so an entity has at most days x grades points.
    """
    recent = benchmarks.where(F.col("benchmark_date").between(F.date_sub(as_of, HISTORY_DAYS), as_of))
    return (
        daily_benchmarks(recent)
        .join(grades.select("grade_id", "grade_label"), "grade_id")
        .select(
            "fighter_id",
            F.col("benchmark_date").alias("date"),
            "grade_label",
            "vwap_7d",
            "vwap_30d",
            F.col("sale_count_30d").alias("sale_count"),
        )
    )


def recent_sales(fact: DataFrame, grades: DataFrame, n: int = 20) -> DataFrame:
    """T3 for all entities at once: the last ``n`` graded sales of each.

    Grades are matched before ranking, as ungraded sales do not take a place.
    """
    labels = grades.select("grade_id", "grade_label")
    labels = F.broadcast(labels) if is_small(labels) else labels
    graded = fact.where(F.col("fighter_id").isNotNull()).join(labels, "grade_id")
    return first_per_key(graded, ["fighter_id"], [F.col("sale_date").desc(), "sale_id"], n).select(
        "fighter_id",
        "sale_id",
        "source_listing_id",
        "listing_title",
        F.col("sale_price_usd").cast("double").alias("sale_price_usd"),
        "sale_date",
        "sale_type",
        "source",
        "listing_url",
        "grade_label",
    )


def fighter_detail(
    benchmarks: DataFrame, fact: DataFrame, entities: DataFrame, grades: DataFrame, as_of: Column, fighter_id: str | None = None
) -> DataFrame:
    """V2 + A14: metadata, ordered price points and ordered recent sales per entity.

    The lists are bounded before they are built: days x grades points and 20 sales. With
    a ``fighter_id`` the key filter reaches both scans.
    """
    if fighter_id is not None:
        mine = F.col("fighter_id") == fighter_id
        benchmarks, fact, entities = benchmarks.where(mine), fact.where(mine), entities.where(mine)
    points = price_history(benchmarks, grades, as_of)
    history = points.groupBy("fighter_id").agg(
        F.array_sort(F.collect_list(F.struct("date", "grade_label", "vwap_7d", "vwap_30d", "sale_count"))).alias(
            "price_history"
        )
    )
    latest = recent_sales(fact, grades).groupBy("fighter_id").agg(
        F.collect_list(
            F.struct(
                F.date_diff(F.lit("9999-12-31").cast("date"), "sale_date").alias("age"),
                "sale_id",
                "listing_title",
                "sale_price_usd",
                "sale_date",
                "sale_type",
                "source",
                "listing_url",
                "grade_label",
            )
        ).alias("sales")
    )
    ordered = F.transform(F.array_sort("sales"), lambda s: s.dropFields("age", "sale_id"))
    listed = latest.select("fighter_id", ordered.alias("recent_sales"))
    return (
        entities.select("fighter_id", F.col("fighter_name_canonical").alias("fighter_name"), "sport", "promotion")
        .join(history, "fighter_id", "left")
        .join(listed, "fighter_id", "left")
        .withColumns(
            {
                "price_history": F.coalesce("price_history", F.array()),
                "recent_sales": F.coalesce("recent_sales", F.array()),
            }
        )
    )


def price_pivot(points: DataFrame, labels: list[str]) -> DataFrame:
    """Days as rows, the given grade labels as columns, 30-day mean as value."""
    return points.groupBy("fighter_id", "date").pivot("grade_label", labels).agg(F.max("vwap_30d"))


def grade_labels(points: DataFrame) -> DataFrame:
    """Labels that occur in each entity's history."""
    return points.select("fighter_id", "grade_label").distinct()
