"""Slowly changing snapshots by the check strategy."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SNAPSHOT_KEYS = ("fighter_id", "grade_id")
CHECK_COLUMNS = ("vwap_30d", "vwap_7d", "sale_count_30d")
VALIDITY = ["dbt_scd_id", "dbt_updated_at", "dbt_valid_from", "dbt_valid_to"]


def _scd_id(keys: Sequence[str], as_of: Column) -> Column:
    return F.md5(F.concat_ws("-", *[F.col(k).cast("string") for k in keys], as_of.cast("string")))


def first_snapshot(incoming: DataFrame, as_of: Column, keys: Sequence[str] = SNAPSHOT_KEYS) -> DataFrame:
    """All incoming rows as open versions; rows with a NULL key part are left out."""
    return incoming.dropna(subset=list(keys)).select(
        *incoming.columns,
        _scd_id(keys, as_of).alias("dbt_scd_id"),
        as_of.alias("dbt_updated_at"),
        as_of.alias("dbt_valid_from"),
        F.lit(None).cast("timestamp").alias("dbt_valid_to"),
    )


def apply_snapshot(
    snapshot: DataFrame,
    incoming: DataFrame,
    as_of: Column,
    keys: Sequence[str] = SNAPSHOT_KEYS,
    check: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
) -> DataFrame:
    """The snapshot after comparing its open versions with ``incoming``.

    ``incoming`` must have one row per key and all columns of the snapshot; anything else is
    an error rather than a wrong history. Per key: an unchanged version stays, a changed one
    is closed and followed by a new version, a missing one is closed, a new one opened.
    Versions closed earlier pass through without joining. Write the result to a new
    path; the old version stays readable until it is swapped.
    """
    keys = list(keys)
    columns = incoming.columns
    missing = [c for c in snapshot.columns if c not in columns and c not in VALIDITY]
    if missing:
        raise ValueError(f"incoming rows lack {', '.join(missing)}")
    if not incoming.dropna(subset=keys).groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1").isEmpty():
        raise ValueError(f"incoming rows repeat a key of {', '.join(keys)}")
    as_of = as_of.cast("timestamp")
    is_open = F.col("dbt_valid_to").isNull()
    opened = first_snapshot(incoming, as_of, keys)
    old = snapshot.where(is_open).select(*keys, F.struct(*columns, *VALIDITY).alias("old"))
    new = opened.select(*keys, F.struct(*columns, *VALIDITY).alias("new"))
    both = old.join(new, keys, "full_outer")
    changed = ~F.lit(True)
    for name in check:
        changed = changed | ~F.col(f"old.{name}").eqNullSafe(F.col(f"new.{name}"))
    closed = F.col("old").withField("dbt_valid_to", as_of)
    gone = closed if invalidate_hard_deletes else F.col("old")
    versions = (
        F.when(F.col("old").isNull(), F.array("new"))
        .when(F.col("new").isNull(), F.array(gone))
        .when(changed, F.array(closed, F.col("new")))
        .otherwise(F.array("old"))
    )
    current = both.select(F.inline(versions))
    return snapshot.where(~is_open).select(*columns, *VALIDITY).unionByName(current)
