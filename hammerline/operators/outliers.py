"""Grouped quartile bounds and outlier flags."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.session import is_small, left_join_spread_nulls, materialise


# Quantile sketches err by at most one in this many ranks; smaller groups are exact as they are.
ACCURACY = 10_000


def iqr_bounds(
    df: DataFrame,
    keys: Sequence[str] = ("source", "grade"),
    value: str = "sale_price_usd",
    multiplier: float = fixed.IQR_MULTIPLIER,
    accuracy: int = ACCURACY,
    exact: bool = True,
) -> DataFrame:
    """A1: quartiles and the bounds derived from them, per group.

    ``exact`` quartiles are the smallest values with a quarter and three quarters of the
    group's values up to them; otherwise they come from the sketch alone. The sketch is
    merged across tasks, so a hot group costs one sketch per task.
    """
    found = exact_quantiles(df, keys, value, (0.25, 0.75), accuracy) if exact else _sketched(df, keys, value, accuracy)
    q1, q3 = F.col("q1"), F.col("q3")
    return (
        found.select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
        .withColumn("iqr", q3 - q1)
        .withColumn("lower_bound", q1 - F.lit(multiplier) * F.col("iqr"))
        .withColumn("upper_bound", q3 + F.lit(multiplier) * F.col("iqr"))
    )


def _sketched(df: DataFrame, keys: Sequence[str], value: str, accuracy: int) -> DataFrame:
    quartiles = F.percentile_approx(F.col(value).cast("double"), [0.25, 0.75], accuracy)
    return df.groupBy(*keys).agg(quartiles.alias("_q"))


def exact_quantiles(
    df: DataFrame, keys: Sequence[str], value: str, shares: Sequence[float], accuracy: int = ACCURACY
) -> DataFrame:
    """The keys with ``_q``, an array of exact discrete quantiles as doubles.

    The sketch brackets each quantile: its error in ranks is bounded, so the values at
    slightly smaller and larger shares lie on either side. Values below a bracket are only
    counted; inside, equal values are counted and ranked. A group of any size thus sends a
    few counts per task and ranks about 4 / accuracy of its values, and no task holds it.
    Reads ``df`` twice.
    """
    slack = 2 / accuracy
    around = [min(1.0, max(0.0, s + d)) for s in shares for d in (-slack, slack)]
    narrow = df.select(F.struct(*keys).alias("_group"), F.col(value).cast("double").alias("_v"))
    groups = materialise(
        narrow.groupBy("_group").agg(F.count("_v").alias("_n"), F.percentile_approx("_v", around, accuracy).alias("_at"))
    )
    ranked = narrow.where(F.col("_v").isNotNull()).join(F.broadcast(groups) if is_small(groups) else groups, "_group")
    low = [F.col("_at")[2 * i] for i in range(len(shares))]
    high = [F.col("_at")[2 * i + 1] for i in range(len(shares))]
    places = F.array(
        *(
            F.struct(F.lit(i).alias("i"), F.when(F.col("_v") >= low[i], F.col("_v")).alias("v"))
            for i in range(len(shares))
        )
    )
    # One row per quantile and value: NULL stands for everything below the bracket.
    counted = (
        ranked.withColumn("_p", F.explode(places))
        .where(F.col("_p.v").isNull() | (F.col("_p.v") <= F.element_at(F.array(*high), F.col("_p.i") + 1)))
        .groupBy("_group", "_n", F.col("_p.i").alias("_i"), F.col("_p.v").alias("_value"))
        .agg(F.count("*").alias("_copies"))
    )
    upto = W.partitionBy("_group", "_i").orderBy(F.col("_value").asc_nulls_first())
    wanted = F.ceil(F.col("_n") * F.element_at(F.array(*map(F.lit, shares)), F.col("_i") + 1))
    reached = F.sum("_copies").over(upto.rowsBetween(W.unboundedPreceding, 0)) >= F.greatest(wanted, F.lit(1))
    first = counted.withColumn("_reached", reached).where("_reached").groupBy("_group", "_i").agg(F.min("_value").alias("_value"))
    found = first.groupBy("_group").agg(
        *(F.max(F.when(F.col("_i") == i, F.col("_value"))).alias(f"_q{i}") for i in range(len(shares)))
    )
    every = groups.select("_group").join(found, "_group", "left")
    return every.select("_group.*", F.array(*(f"_q{i}" for i in range(len(shares)))).alias("_q"))


def flag_outliers(
    df: DataFrame,
    keys: Sequence[str] = ("source", "grade"),
    value: str = "sale_price_usd",
    multiplier: float = fixed.IQR_MULTIPLIER,
    null_safe: bool = False,
    exact: bool = True,
) -> DataFrame:
    """``is_outlier`` against the bounds of the row's group.

    Rows with a NULL key match no bounds and are never outliers, unless ``null_safe``.
    The bounds are a few rows per source, computed once; only after measuring them are
    they broadcast, which spares the wide rows a shuffle on a handful of hot groups.
    """
    keys = list(keys)
    bounds = iqr_bounds(df, keys, value, multiplier, exact=exact).select(*keys, "lower_bound", "upper_bound")
    if not null_safe:
        for key in keys:
            bounds = bounds.where(F.col(key).isNotNull())
    bounds = materialise(bounds)
    small = is_small(bounds)
    if null_safe:
        right = bounds.select(*[F.col(k).alias(f"_{k}") for k in keys], "lower_bound", "upper_bound")
        match = F.lit(True)
        for key in keys:
            match = match & F.col(key).eqNullSafe(F.col(f"_{key}"))
        joined = df.join(F.broadcast(right) if small else right, match, "left").drop(*[f"_{k}" for k in keys])
    elif small:
        joined = df.join(F.broadcast(bounds), keys, "left")
    else:
        joined = left_join_spread_nulls(df, bounds, keys, F.struct(*df.columns))
    price = F.col(value).cast("double")
    outside = (price < F.col("lower_bound")) | (price > F.col("upper_bound"))
    return joined.withColumn("is_outlier", F.coalesce(outside, F.lit(False))).select(*df.columns, "is_outlier")
