"""Duplicate handling and set operations on record hashes."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline.session import is_small, materialise, write_table

# Bits of the filter over repeated keys: so many for each of them, at most 16 MiB; bits in one bitmap.
BITS_PER_KEY = 16
MAX_BITS = 1 << 27
PAGE = 32_768


def _sortable(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column], n: int = 1) -> DataFrame:
    """The first ``n`` rows of each key in a total order.

    Spark turns the rank filter into a per-task limit ahead of the shuffle, so a hot key
    contributes at most ``n`` rows per map task.
    """
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rn", rank).where(F.col("_rn") <= n).drop("_rn")


def keep_latest(
    df: DataFrame,
    key: str = "record_hash",
    latest: str = "scraped_at",
    ties: Sequence[str] | None = None,
    written: bool = False,
    by: Sequence[Column] = (),
) -> DataFrame:
    """Newest row per key. Among equally new rows the one with the largest ``ties``
    wins, then the largest remaining columns in order, so reruns agree.

    Most keys occur once. Digests of the keys are counted first, which reads only the key
    column and shuffles eight bytes a key; rows whose digest occurs once then pass through as
    they are, neither shuffled nor sorted nor aggregated, however many keys are repeated: beyond
    the broadcast limit a bitmap over the repeated digests tells them. Of the others, and of the
    few that share a digest or a bit with them, the row itself, led by its order columns, is the
    value whose maximum is taken: each task reduces its own copies of a key to one row, so a hot
    key costs the shuffle one row per task. ``df`` is read three times and should be cheap to
    read; with ``written`` so is the result, as what had to be shuffled is kept in a table, laid out
    ``by`` columns that also lay out ``df``. Rows with a NULL key are not comparable and are left out; see :func:`split_null_key`.
    """
    order = [latest, *(ties or [])]
    sortable = _sortable(df)
    rest = [c for c in df.columns if c not in (key, *order)]
    if all(c in sortable for c in rest):
        newest = F.max(F.struct(*order, *rest))
    else:  # nested columns take no part in the order
        plain = [c for c in rest if c in sortable]
        newest = F.max_by(F.struct(*order, *rest), F.struct(*order, *plain))
    keyed = df.where(F.col(key).isNotNull())
    digests = keyed.select(F.xxhash64(key).alias("_digest"))
    repeated = materialise(duplicate_keys(digests, "_digest").select("_digest"))
    alone, again = _teller(repeated, key)(keyed)
    kept = again.groupBy(key).agg(newest.alias("_row"))
    kept = kept.select(*[F.col(c) if c == key else F.col(f"_row.{c}").alias(c) for c in df.columns])
    if not written:
        return alone.unionByName(kept)
    return alone.unionByName(write_table(kept.repartition(*by) if by else kept, "kept"))


def _teller(digests: DataFrame, key: str) -> Callable[[DataFrame], tuple[DataFrame, DataFrame]]:
    """What splits rows into those whose key surely has none of the digests (column ``_digest``,
    materialised), and the others: by broadcast, or by bitmaps beyond its limit."""
    if is_small(digests):
        side, found = F.broadcast(digests), None
    else:
        side, found = None, _bitmaps(digests, "_digest")

    def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
        if found is None:
            marked = rows.withColumn("_digest", F.xxhash64(key))
            without, within = (marked.join(side, "_digest", how) for how in ("left_anti", "left_semi"))
        else:
            marked = _probed(rows, F.xxhash64(key), *found)
            without, within = marked.where(~F.col("_maybe")), marked.where("_maybe")
        return without.select(rows.columns), within.select(rows.columns)

    return split


def _bitmaps(digests: DataFrame, digest: str) -> tuple[DataFrame, int]:
    """(page, bitmap) of the places of 64-bit digests among a number of bits, and that number."""
    bits = PAGE
    while bits < min(MAX_BITS, BITS_PER_KEY * digests.count()):
        bits *= 2
    at = F.pmod(F.col(digest), F.lit(bits))
    paged = digests.select(F.floor(at / PAGE).alias("_page"), (at % PAGE).alias("_at")).repartition("_page")
    return materialise(paged.groupBy("_page").agg(F.bitmap_construct_agg("_at").alias("_bitmap"))), bits


def _probed(df: DataFrame, digest: Column, bitmaps: DataFrame, bits: int) -> DataFrame:
    """``df`` with ``_maybe``, false only where no digest has the row's bit."""
    at = F.pmod(digest, F.lit(bits))
    paged = df.withColumns({"_page": F.floor(at / PAGE), "_at": (at % PAGE).cast("int")})
    byte = F.conv(F.hex(F.substring("_bitmap", F.floor(F.col("_at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = byte.bitwiseAND(F.pow(F.lit(2), F.col("_at") % 8).cast("int")) != 0
    joined = paged.join(F.broadcast(bitmaps), "_page", "left")
    return joined.withColumn("_maybe", F.coalesce(bit, F.lit(False))).drop("_page", "_at", "_bitmap")


def split_null_key(df: DataFrame, key: str = "record_hash") -> tuple[DataFrame, DataFrame]:
    """Rows that can be deduplicated, and rows to quarantine because their key is NULL."""
    return df.where(F.col(key).isNotNull()), df.where(F.col(key).isNull())


def duplicate_keys(df: DataFrame, key: str = "record_hash") -> DataFrame:
    """A2, as rows: keys that occur more than once, with their counts."""
    return df.groupBy(key).agg(F.count("*").alias("copies")).where("copies > 1")


def duplicate_key_count(df: DataFrame, key: str = "record_hash") -> DataFrame:
    """A2: how many keys occur more than once."""
    return duplicate_keys(df, key).agg(F.count("*").alias("duplicate_hash_count"))


def new_records(
    df: DataFrame,
    seen: DataFrame,
    key: str = "record_hash",
    latest: str = "scraped_at",
    ties: Sequence[str] | None = None,
) -> DataFrame:
    """Drop copies within the batch, then rows whose key was seen before.

    Deduplicating first leaves one row per key. Of text keys the 64-bit digests are joined first;
    rows without a digest in common with the seen ones pass through as they are, and only the
    others meet the seen keys of such digests in the exact anti-join. Both inputs are read several
    times and should be cheap to read.
    """
    seen = seen.select(key)
    if not all(isinstance(side.schema[key].dataType, T.StringType) for side in (df, seen)):
        return keep_latest(df, key, latest, ties).join(seen, key, "left_anti")
    digests = [side.where(F.col(key).isNotNull()).select(F.xxhash64(key).alias("_digest")) for side in (df, seen)]
    split = _teller(materialise(digests[0].join(digests[1], "_digest", "left_semi").distinct()), key)
    fresh, maybe = split(keep_latest(df, key, latest, ties, written=True))
    new = maybe.join(split(seen)[1], key, "left_anti")
    return fresh.select(new.columns).unionByName(new)


def merge_seen(seen: DataFrame, batch: DataFrame, key: str = "record_hash") -> DataFrame:
    """The seen set after a batch. Inputs are left as they are."""
    return seen.select(key).unionByName(batch.select(key)).where(F.col(key).isNotNull()).distinct()


def unseen_keys(batch: DataFrame, seen: DataFrame, key: str = "record_hash") -> DataFrame:
    """Distinct keys of the batch that are not in the seen set."""
    return batch.select(key).where(F.col(key).isNotNull()).distinct().join(seen.select(key), key, "left_anti")
