"""Cross-run dedup of a stream into few, compacted folders (J8, K4, 2.13).

A table in versions (:mod:`hammerline.sources.versions`) is the seen set. Its rows lie in a fixed
number of folders by the key's hash, whatever the keys look like. A batch reads the key column of
the folders its own keys fall into, adds its new rows as folders of its own, and merges folders of
one hash in the same change once ``fanout`` of them are of like size. A row is thus rewritten
once for every time its folder grows by that factor, and a hash has at most ``fanout`` folders
of each size.

The manifest notes the last batch of each stream, so a batch repeated after a failure changes
nothing, and readers see a batch, or a merge, whole or not at all.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from hammerline.operators.dedup import new_records
from hammerline.session import open_files, parts_apart, scratch_scope, write_table
from hammerline.sources.layouts import FILE_BYTES
from hammerline.sources.versions import Change, Conflict, Folder, Versions, in_values

ROWS, BUCKET, BATCHES = "rows", "bucket", "batches"
# Folders up to this size count as of one size.
LEAST_BYTES = 1 << 20
# Buckets of at least so many rows of a batch are written by every task, without a shuffle, up to so many buckets.
DEALT_ROWS = 100_000
OPEN_FILES = 64
ATTEMPTS = 5


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


def _level(folder: Folder, fanout: int) -> int:
    return max(0, math.ceil(math.log(max(1, folder.bytes) / LEAST_BYTES, fanout)))


def to_merge(folders: Sequence[Folder], fanout: int) -> list[Folder]:
    """The folders of like size, ``fanout`` or more of one value; several files count as folders."""
    levels: dict[tuple[str, int], list[Folder]] = {}
    for folder in folders:
        levels.setdefault((folder.name, _level(folder, fanout)), []).append(folder)
    return [f for found in levels.values() if len(found) >= fanout for f in found]


def merge_folders(change: Change, table: str, fanout: int) -> int:
    """Put one folder in place of each value's folders that are to be merged; their number.

    A task reads folders of one value only and writes them to one file, so nothing is shuffled.
    """
    old = change.tables[table]
    chosen = set(to_merge(old.folders, fanout))
    if chosen:
        values: dict[str, set[Folder]] = {}
        for folder in chosen:
            values.setdefault(folder.name, set()).add(folder)
        files = {name: math.ceil(sum(f.bytes for f in found) / FILE_BYTES) for name, found in values.items()}
        parts = [change.read(table, values[name].__contains__).coalesce(max(1, files[name])) for name in sorted(values)]
        with parts_apart(change.store.spark):
            change.put(table, reduce(DataFrame.unionByName, parts), old.by, replaces=chosen.__contains__, deal=False)
    return len(chosen)


def compact(spark: SparkSession, path: str, table: str = ROWS, fanout: int = 8) -> int:
    """Merge folders of a table beside its writers: who publishes second starts again."""
    for _ in range(ATTEMPTS):
        change = Versions(spark, path).change()
        merged = merge_folders(change, table, fanout)
        if not merged:
            return 0
        try:
            change.publish()
            return merged
        except Conflict:
            continue
    raise Conflict(f"{path} changes too often to be merged")


def appender(
    spark: SparkSession,
    path: str,
    name: str = "stream",
    key: str = "record_hash",
    latest: str = "scraped_at",
    ties: list[str] | None = None,
    buckets: int = 64,
    fanout: int = 8,
    versions_kept: int = 10,
    written: bool = False,
) -> Callable[[DataFrame, int], None]:
    """What one batch does: append the rows whose key no earlier batch has, the newest of copies.

    A batch is stored first, as it is read several times; not if batches are ``written`` tables.
    """
    store = Versions(spark, path)

    def once(rows: DataFrame, batch_id: int) -> bool:
        change = store.change()
        done = change.notes.get(BATCHES, {})
        if batch_id <= done.get(name, -1):
            return True
        counts = rows.groupBy(BUCKET).count().collect()  # at most ``buckets``
        mine = {str(r[0]) for r in counts}
        # Small batches are dealt to their folders, so as to be one file each.
        deal = buckets > OPEN_FILES or sum(r["count"] for r in counts) < DEALT_ROWS * buckets
        schema = T.StructType([rows.schema[key]])
        seen = change.read(ROWS, in_values(BUCKET, mine), schema).select(key)
        fresh = new_records(rows.drop(BUCKET), seen, key, latest, ties).withColumn(BUCKET, bucket_of(key, buckets))
        with open_files(spark, buckets):
            change.put(ROWS, fresh, [BUCKET], deal=deal)
        merge_folders(change, ROWS, fanout)
        change.notes[BATCHES] = done | {name: batch_id}
        try:
            change.publish()
        except Conflict:
            return False
        return True

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark):
            keyed = batch.where(F.col(key).isNotNull())
            keyed = keyed.withColumn(BUCKET, bucket_of(key, buckets))
            rows = keyed if written else write_table(keyed, "batch")
            if not any(once(rows, batch_id) for _ in range(ATTEMPTS)):
                raise Conflict(f"{path} changes too often for batch {batch_id}")
        if batch_id % versions_kept == versions_kept - 1:
            store.vacuum(versions_kept)

    return write


def append_compacted(stream: DataFrame, path: str, checkpoint: str, name: str = "stream", **options) -> StreamingQuery:
    """J8, exact, over any number of batches: see :func:`appender` for the options."""
    write = appender(stream.sparkSession, path, name, **options)
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return query.trigger(availableNow=True).start()


def read_appended(spark: SparkSession, path: str) -> DataFrame:
    """All rows appended so far."""
    return Versions(spark, path).read(ROWS).drop(BUCKET)
