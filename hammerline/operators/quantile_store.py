"""Exact quantiles over any period, from counts kept per day (A1, J1 over time).

Every value has a bin: its leading binary digits, so a bin is at most a sixteenth wider than its
least value, and bins are ordered as their values. Stored side by side, in versions that change
together, in folders by period:

* ``bins``: per key, day and bin the number of rows; adding up days gives the bins of any span,
* ``values``: per key, day, bin and value the number of copies, sorted by bin,
* ``sketches``: per key and day a KLL sketch, for answers that need not be exact.

A quantile of a span of days is found from the bins alone up to one bin, and only that bin's
values are read and ranked. Days of the rows that have not changed since the last refresh are
not read again.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Collection, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.operators.incremental import PART, Refreshed, find_changes, period_of, within
from hammerline.session import is_small, materialise
from hammerline.sources.versions import Folder, Versions, in_values

# Steps of the smallest bin, as a power of two, and the leading digits of a bin's values.
SCALE, DIGITS = 1 << 20, 5
MOST = 9.0e18
# Bins named in a filter.
MOST_BINS = 1000


def bin_of(value: Column) -> Column:
    """The bin of a double; equal or ordered as the values are. NaN is as the largest."""
    steps = F.floor(F.least(F.abs(value) * SCALE, F.lit(MOST)))
    head = lambda n, size: F.floor(n / F.pow(F.lit(2.0), size - DIGITS))
    named = F.transform(
        F.array(F.struct(steps.alias("n"), F.length(F.bin(steps)).alias("size"))),
        lambda s: F.when(s["n"] < 1 << DIGITS, s["n"]).otherwise(
            s["size"] * (1 << (DIGITS - 1)) + head(s["n"], s["size"]) + (1 << DIGITS)
        ),
    )[0].cast("int")
    return F.when(value < 0, -named - 1).otherwise(named)


def _present(df: DataFrame, keys: Sequence[str], date: str, value: str) -> DataFrame:
    number = F.col(value).cast("double")
    return df.select(*keys, F.col(date).alias("day"), number.alias("value")).withColumn("bin", bin_of(F.col("value")))


def refresh(
    rows: DataFrame,
    store: Versions,
    keys: Sequence[str] = ("source", "grade"),
    date: str = "sale_date",
    value: str = "sale_price_usd",
    grain: str = "month",
    days: Collection[dt.date | None] | None = None,
) -> Refreshed:
    """Bring the stored counts up to date with ``rows``: periods with a changed day are counted anew."""
    change = store.change()
    narrow = rows.select(*keys, date, value)
    touched, digests = find_changes(narrow, change, date, days)
    if not touched:
        return Refreshed(change.base.version, 0, (), ())
    first = lambda d: d.replace(day=1) if grain == "month" else d
    periods = {"none" if d is None else first(d).isoformat() for d in touched}
    some = _present(narrow.where(within(date, periods, grain)), keys, date, value)
    part, by = period_of(F.col("day"), grain), [*keys, "day", "bin"]
    # A value that is missing counts as no row of its key, which is known all the same.
    counted = some.groupBy(*by, "value").agg(F.count("value").alias("copies"))
    replaced = in_values(PART, periods)
    change.put("values", counted.withColumn(PART, part), [PART], replaces=replaced, sort=["bin", "value"])
    fresh = change.read("values", replaced)
    bins = fresh.groupBy(*by, PART).agg(F.sum("copies").alias("rows"))
    change.put("bins", bins, [PART], replaces=replaced)
    sketch = some.groupBy(*keys, "day").agg(F.kll_sketch_agg_double("value").alias("sketch")).withColumn(PART, part)
    change.put("sketches", sketch, [PART], replaces=replaced)
    change.put("days", digests, replaces=lambda _: True)
    return Refreshed(change.publish().version, len(touched), tuple(sorted(periods)), ())


def _span(store: Versions, table: str, first: dt.date | None, last: dt.date | None) -> DataFrame:
    """A table's rows of the days from first to last; without either, of all days, missing ones too."""

    def keep(folder: Folder) -> bool:
        period = folder.values[PART]
        if first is None and last is None:
            return True
        # A period begins at most 31 days before the days it holds.
        after = first is None or (period != "none" and dt.date.fromisoformat(period) > first - dt.timedelta(days=31))
        return period != "none" and after and (last is None or period <= last.isoformat())

    rows = store.read(table, keep=keep)
    if first is not None:
        rows = rows.where(F.col("day") >= F.lit(first))
    return rows if last is None else rows.where(F.col("day") <= F.lit(last))


def exact(
    store: Versions,
    shares: Sequence[float] = (0.25, 0.75),
    first: dt.date | None = None,
    last: dt.date | None = None,
    keys: Sequence[str] = ("source", "grade"),
) -> DataFrame:
    """The keys with ``_q``, an array of exact discrete quantiles over a span of days.

    Equal to :func:`hammerline.operators.outliers.exact_quantiles` of the rows of these days.
    """
    group = F.struct(*keys).alias("_group")
    bins = _span(store, "bins", first, last).groupBy(group, "bin").agg(F.sum("rows").alias("rows"))
    order = W.partitionBy("_group").orderBy(F.col("bin").asc_nulls_first())
    upto = F.sum("rows").over(order.rowsBetween(W.unboundedPreceding, 0))
    counted = bins.withColumns({"upto": upto, "n": F.sum("rows").over(W.partitionBy("_group"))})
    each = F.array(*(F.struct(F.lit(i).alias("i"), F.lit(s).alias("share")) for i, s in enumerate(shares)))
    placed = counted.withColumn("p", F.explode(each))
    rank = F.greatest(F.ceil(F.col("n") * F.col("p.share")), F.lit(1))
    hit = (F.col("upto") >= rank) & (F.col("upto") - F.col("rows") < rank)
    # One bin per key and share.
    wanted = materialise(
        placed.where(hit).select("_group", F.col("p.i").alias("i"), "bin", (rank - F.col("upto") + F.col("rows")).alias("rank"))
    )
    inside = wanted.select("_group", "bin").distinct()
    inside = F.broadcast(inside) if is_small(inside) else inside
    values = _span(store, "values", first, last)
    numbers = wanted.select("bin").distinct().limit(MOST_BINS + 1).collect()
    if len(numbers) <= MOST_BINS:  # so few that the scan can skip by them
        values = values.where(F.col("bin").isin([r["bin"] for r in numbers]))
    values = values.select(group, "bin", "value", "copies").join(inside, ["_group", "bin"])
    values = values.groupBy("_group", "bin", "value").agg(F.sum("copies").alias("copies"))
    within_bin = W.partitionBy("_group", "bin").orderBy("value").rowsBetween(W.unboundedPreceding, 0)
    ranked = values.withColumn("upto", F.sum("copies").over(within_bin)).join(wanted, ["_group", "bin"])
    found = ranked.where(F.col("upto") >= F.col("rank")).groupBy("_group", "i").agg(F.min("value").alias("value"))
    per_key = found.groupBy("_group").agg(*(F.max(F.when(F.col("i") == i, F.col("value"))).alias(f"_q{i}") for i in range(len(shares))))
    every = bins.select("_group").distinct().join(per_key, "_group", "left")
    return every.select("_group.*", F.array(*(f"_q{i}" for i in range(len(shares)))).alias("_q"))


def bounds(
    store: Versions,
    first: dt.date | None = None,
    last: dt.date | None = None,
    keys: Sequence[str] = ("source", "grade"),
    multiplier: float = fixed.IQR_MULTIPLIER,
) -> DataFrame:
    """A1 over a span of days: the columns of :func:`hammerline.operators.outliers.iqr_bounds`."""
    found = exact(store, (0.25, 0.75), first, last, keys).select(*keys, F.col("_q")[0].alias("q1"), F.col("_q")[1].alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    return found.withColumn("iqr", iqr).withColumns(
        {"lower_bound": F.col("q1") - F.lit(multiplier) * iqr, "upper_bound": F.col("q3") + F.lit(multiplier) * iqr}
    )


def approximate(
    store: Versions,
    shares: Sequence[float] = (0.25, 0.75),
    first: dt.date | None = None,
    last: dt.date | None = None,
    keys: Sequence[str] = ("source", "grade"),
) -> DataFrame:
    """The keys with ``_q`` from merged sketches, off by about 2 % of the ranks; reads no counts."""
    merged = _span(store, "sketches", first, last).groupBy(*keys).agg(F.kll_merge_agg_double("sketch").alias("sketch"))
    return merged.select(*keys, F.kll_sketch_get_quantile_double("sketch", F.array(*map(F.lit, shares))).alias("_q"))
