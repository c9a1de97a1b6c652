"""Snapshots kept by merge (W6): only buckets of keys that have changed are compared and rewritten.

Versions of rows lie in folders by the hash of their key, open ones apart from closed ones, in
versions that change together (:mod:`hammerline.sources.versions`). Each bucket notes the number and
a digest of the keys and checked columns that came last. A run digests the incoming rows, one small
row a bucket, and compares only buckets whose digest differs with their open versions, by
:func:`hammerline.operators.scd.apply_snapshot`. Closed versions are appended and never read.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline.operators.scd import CHECK_COLUMNS, SNAPSHOT_KEYS, apply_snapshot, first_snapshot
from hammerline.session import write_table
from hammerline.sources.versions import Versions, in_values

OPEN, CLOSED, DIGESTS, BUCKET = "open", "closed", "digests", "bucket"


@dataclass(frozen=True)
class Merged:
    """The published version, and the buckets that were rewritten."""

    version: int
    buckets: tuple[int, ...]


def _bucket(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")


def merge_snapshot(
    store: Versions,
    incoming: DataFrame,
    as_of: Column,
    keys: Sequence[str] = SNAPSHOT_KEYS,
    check: Sequence[str] = CHECK_COLUMNS,
    invalidate_hard_deletes: bool = True,
    buckets: int = 64,
) -> Merged:
    """Bring the stored history up to date with ``incoming``: one row per key, as for
    :func:`hammerline.operators.scd.apply_snapshot`, whose results it gives.

    A run without a change in keys or checked columns publishes nothing. The number of buckets is
    that of the first run.
    """
    change = store.change()
    buckets = int(change.notes.setdefault("buckets", buckets))
    rows = incoming.dropna(subset=list(keys)).withColumn(BUCKET, _bucket(keys, buckets))
    each = F.xxhash64(*keys, *check).cast("decimal(38,0)")
    digests = write_table(rows.groupBy(BUCKET).agg(F.count("*").alias("rows"), F.sum(each).alias("digest")), "digests")
    seen = change.read(DIGESTS, schema=digests.schema)
    both = digests.alias("a").join(seen.alias("b"), BUCKET, "full")
    same = F.col("a.rows").eqNullSafe(F.col("b.rows")) & F.col("a.digest").eqNullSafe(F.col("b.digest"))
    changed = sorted(r[BUCKET] for r in both.where(~same).select(BUCKET).collect())  # at most ``buckets``
    if not changed:
        return Merged(change.base.version, ())
    mine = in_values(BUCKET, map(str, changed))
    new = rows.where(F.col(BUCKET).isin(changed)).drop(BUCKET)
    schema = first_snapshot(incoming, as_of.cast("timestamp"), keys).schema
    old = change.read(OPEN, mine, T.StructType([*schema, T.StructField(BUCKET, T.IntegerType())])).drop(BUCKET)
    current = write_table(apply_snapshot(old, new, as_of, keys, check, invalidate_hard_deletes), "versions")
    current = current.withColumn(BUCKET, _bucket(keys, buckets))
    change.put(OPEN, current.where("dbt_valid_to is null"), [BUCKET], replaces=mine)
    change.put(CLOSED, current.where("dbt_valid_to is not null"), [BUCKET])
    change.put(DIGESTS, digests, replaces=lambda _: True)
    return Merged(change.publish().version, tuple(changed))


def history(store: Versions) -> DataFrame:
    """All versions, open and closed."""
    manifest = store.manifest()
    return store.read(OPEN, manifest).unionByName(store.read(CLOSED, manifest)).drop(BUCKET)
