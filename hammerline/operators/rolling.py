"""Rolling price benchmarks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline import fixed
from hammerline.functions.sales import pct_deviation
from hammerline.session import bytes_to_hex, hex_to_bytes, is_small, left_join_spread_nulls, materialise

ENTITY_KEYS = ("fighter_name_canonical", "grade", "grader")
DIM_KEYS = ("fighter_id", "grade_id")

# A window group above this many rows is cut into blocks instead of sorted by one task.
HOT_ROWS = 5_000_000
# Of the order's tie, as slices of a hot group's day.
LONGEST_PREFIX = 16


def eligible(df: DataFrame, keys: Sequence[str] = ENTITY_KEYS, value: str = "sale_price_usd") -> DataFrame:
    """all keys and the price present, and not an outlier."""
    return df.dropna(subset=[*keys, value]).where(~F.col("is_outlier"))


def _mean(total: Column, n: Column) -> Column:
    """Mean of an exact decimal sum; NULL for an empty frame."""
    return F.when(n > 0, total.cast("double") / n.cast("double"))


def _exact(df: DataFrame, *columns: str | None) -> None:
    """Frames are differences of running totals, which only exact numbers survive."""
    for name in columns:
        if name is not None and isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
            raise TypeError(f"{name} is {df.schema[name].dataType.simpleString()}; cast it to a decimal first")


def rolling_by_date(
    df: DataFrame,
    keys: Sequence[str] = ENTITY_KEYS,
    date: str = "sale_date",
    value: str = "sale_price_usd",
    mean_days: Sequence[int] = fixed.MEAN_WINDOWS,
    count_days: Sequence[int] = fixed.COUNT_WINDOWS,
    weight: str | None = None,
) -> DataFrame:
    """W2 + W3: means and counts over the last N days including the current day.

    A time-range frame holds every same-day sale, so all sales of a day share one result.
    Sales are therefore first summed per key and day, the frames slide over days, and the
    result is joined back on key and day. No window group exceeds the number of days,
    however popular its key is. Rows with a NULL key keep NULL benchmarks. The frames are stored
    and measured first: small ones are broadcast, and the rows are not shuffled. Others are joined by hash,
    so that the wide rows are not sorted; hashes cross the shuffle as bytes.

    ``weight`` turns the plain mean into a weighted one. Value and weight must be decimals or
    integers.
    """
    keys = list(keys)
    daily = daily_sums(df, keys, date, value, weight)
    benchmarks = materialise(day_frames(daily, keys, date, mean_days, count_days))
    if is_small(benchmarks):
        joined = df.join(F.broadcast(benchmarks), [*keys, date], "left")
    else:
        hashes = [c for c in ("record_hash",) if c in df.columns and isinstance(df.schema[c].dataType, T.StringType)]
        frames = benchmarks.hint("shuffle_hash")
        spread = left_join_spread_nulls(hex_to_bytes(df, *hashes), frames, [*keys, date], F.struct(*df.columns))
        joined = bytes_to_hex(spread, *hashes)
    return joined.select(*df.columns, *_frame_names(mean_days, count_days))


def daily_sums(df: DataFrame, keys: Sequence[str], date: str, value: str, weight: str | None = None) -> DataFrame:
    """Per key and day: the exact sum, the number of values (or the weights' sum), the rows."""
    _exact(df, value, weight)
    amount = F.col(value) if weight is None else F.col(value) * F.col(weight)
    units = F.count(value) if weight is None else F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))
    return df.groupBy(*keys, date).agg(F.sum(amount).alias("_sum"), units.alias("_n"), F.count("*").alias("_rows"))


def day_frames(
    daily: DataFrame, keys: Sequence[str], date: str, mean_days: Sequence[int], count_days: Sequence[int]
) -> DataFrame:
    """Means and counts per key and day from daily sums; a day needs those of its longest frame."""
    by_day = W.partitionBy(*keys).orderBy(F.unix_date(date))

    def frame(column: str, days: int) -> Column:
        """Everything so far minus everything before the frame: both only ever grow,
        whereas a sliding frame is added up again for each day."""
        so_far = F.sum(column).over(by_day.rangeBetween(W.unboundedPreceding, 0))
        before = F.sum(column).over(by_day.rangeBetween(W.unboundedPreceding, -(days + 1)))
        return F.coalesce(so_far, F.lit(0)) - F.coalesce(before, F.lit(0))

    means = [_mean(frame("_sum", d), frame("_n", d)).alias(f"vwap_{d}d") for d in mean_days]
    counts = [frame("_rows", d).alias(f"sale_count_{d}d") for d in count_days]
    return daily.select(*keys, date, *means, *counts)


def with_deviation(df: DataFrame, value: str = "sale_price_usd", days: Sequence[int] = fixed.COUNT_WINDOWS) -> DataFrame:
    """P6 columns ``price_pct_change_{N}d`` against the N-day mean."""
    return df.withColumns(
        {f"price_pct_change_{d}d": pct_deviation(F.col(value), F.col(f"vwap_{d}d")) for d in days}
    )


def _frame_names(means: Sequence[int], counts: Sequence[int]) -> list[str]:
    return [f"vwap_{n}d" for n in means] + [f"sale_count_{n}d" for n in counts]


def _row_frames(
    df: DataFrame,
    group: Sequence[str],
    order: Sequence[Column],
    value: str,
    mean_rows: Sequence[int],
    count_rows: Sequence[int],
) -> DataFrame:
    """Row frames from running totals: two lookups per frame instead of re-adding it.

    Decimal totals are exact, so differences of them equal the frame's own sum.
    """
    ordered = W.partitionBy(*group).orderBy(*order)
    running = ordered.rowsBetween(W.unboundedPreceding, 0)
    totals = df.select(
        "*",
        F.sum(F.coalesce(F.col(value), F.lit(0).cast(df.schema[value].dataType))).over(running).alias("_sum"),
        F.count(value).over(running).alias("_n"),
        F.row_number().over(ordered).alias("_row"),
    )

    def frame(column: str, n: int) -> Column:
        return F.col(column) - F.coalesce(F.lag(column, n).over(ordered), F.lit(0))

    return totals.select(
        *df.columns,
        *[_mean(frame("_sum", n), frame("_n", n)).alias(f"vwap_{n}d") for n in mean_rows],
        *[F.least(F.col("_row"), F.lit(n)).cast("long").alias(f"sale_count_{n}d") for n in count_rows],
    )


def rolling_by_rows(
    df: DataFrame,
    keys: Sequence[str] = DIM_KEYS,
    date: str = "sale_date",
    tie: str = "sale_id",
    value: str = "sale_price_usd",
    mean_rows: Sequence[int] = fixed.MEAN_WINDOWS,
    count_rows: Sequence[int] = fixed.COUNT_WINDOWS,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """W4 + W5: means and counts over the current sale and the N-1 before it.

    Sales are ordered by date, then ``tie``, a string id with well spread leading
    characters such as a hash. NULL keys form groups of their own, as in any window;
    unresolved sales make that the likeliest hot group.

    Groups above ``hot_rows`` are not given to one task (see :func:`_rolling_hot`). The
    input is read once more to count its keys, so pass a written table, not a long plan.
    The value must be a decimal or an integer.
    """
    keys = list(keys)
    _exact(df, value)
    order = [F.col(date).asc_nulls_first(), F.col(tie).asc_nulls_first()]
    # A struct of the keys is never NULL itself, so NULL keys group and join as values. They are
    # counted by the plain keys, which a table bucketed by them need not shuffle.
    grouped = df.withColumn("_group", F.struct(*keys))
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = materialise(counts.where(F.col("_rows") > hot_rows).select(F.struct(*keys).alias("_group")))
    if hot.isEmpty():
        return _row_frames(df, keys, order, value, mean_rows, count_rows)
    side = F.broadcast(hot) if is_small(hot) else hot
    cold = grouped.join(side, "_group", "left_anti").drop("_group")
    warm = grouped.join(side, "_group", "left_semi")
    return _row_frames(cold, keys, order, value, mean_rows, count_rows).unionByName(
        _rolling_hot(warm, date, tie, value, mean_rows, count_rows, hot_rows).select(
            *df.columns, *_frame_names(mean_rows, count_rows)
        )
    )


def _rolling_hot(
    df: DataFrame,
    date: str,
    tie: str,
    value: str,
    mean_rows: Sequence[int],
    count_rows: Sequence[int],
    block_rows: int,
) -> DataFrame:
    """Row frames of groups (column ``_group``) too large for one task.

    1. Slice each group by day and leading characters of ``tie``; both follow the order.
       So many characters are taken that no slice is larger than a block, or LONGEST_PREFIX.
       Slice counts, summed in order, give the position each slice starts at.
    2. Position of a row = start of its slice + rank inside the slice. The join and the
       rank use the same keys, so the rows are shuffled once for both.
    3. Cut the group into blocks of ``block_rows`` positions. The last rows of a block are
       copied to the next one, so every frame is complete inside its block; the copies are
       dropped afterwards.
    """
    longest = max([*mean_rows, *count_rows])
    block_rows = max(block_rows, longest)
    slice_keys = ["_group", "_day", "_piece"]
    day = F.coalesce(F.unix_date(date), F.lit(-(2**31)))
    prefix = 1
    while True:
        piece = F.substring(F.coalesce(F.col(tie), F.lit("")), 1, prefix)
        sliced = df.withColumns({"_piece": piece, "_day": day})
        largest = sliced.groupBy(*slice_keys).agg(F.count("*").alias("_rows")).agg(F.max("_rows")).first()[0] or 0
        if largest <= block_rows or prefix >= LONGEST_PREFIX:
            break
        # A character of a hash cuts a slice into sixteen.
        prefix = min(LONGEST_PREFIX, prefix + max(1, math.ceil(math.log(largest / block_rows, 16))))
    before = W.partitionBy("_group").orderBy("_day", "_piece").rowsBetween(W.unboundedPreceding, -1)
    starts = (
        sliced.groupBy(*slice_keys)
        .agg(F.count("*").alias("_rows"))
        .select(*slice_keys, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    in_slice = W.partitionBy(*slice_keys).orderBy(F.col(tie).asc_nulls_first())
    placed = sliced.join(starts, slice_keys).withColumn("_pos", F.col("_start") + F.row_number().over(in_slice) - 1)
    block = F.floor(F.col("_pos") / block_rows)
    is_tail = F.col("_pos") % block_rows >= block_rows - longest
    blocks = (
        placed.withColumn("_home", block)
        .withColumn("_block", F.explode(F.when(is_tail, F.array(block, block + 1)).otherwise(F.array(block))))
        .drop("_start", "_piece", "_day")
    )
    framed = _row_frames(blocks, ["_group", "_block"], [F.col("_pos")], value, mean_rows, count_rows)
    return framed.where(F.col("_block") == F.col("_home"))
