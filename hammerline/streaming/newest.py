"""The newest row of every key from a stream, as changes.

State by bucket of keys holds the newest row of each so far. A newer copy, in the order of
:func:`hammerline.operators.dedup.keep_latest`, is emitted as a replacement; older copies are not
emitted. So whatever order the rows arrive in, the last row emitted for a key is the one that
``keep_latest`` takes from all of them. A timer in event time drops a key's row once the
watermark has passed its newest row by the retention; a copy that arrives still later begins
anew and is told by ``keep_newest``.

This is the one place of the core that runs Python on executors: Spark offers keyed state with
timers to Python as processors only. They see a batch's rows of a bucket one at a time. Each call
of the state crosses to the JVM and back, which costs more than the row itself; so the rows of a bucket
are one value, compressed, read and written once a batch, with one timer. A batch thus rewrites the buckets
it touches: 4 million keys are 250 to a bucket. Of the state before a batch two versions are kept, the last to
start from again; Spark's usual hundred would be a hundred copies of the whole state.

Rows without key or time are left out, and rows behind the watermark when they arrive. Columns
are to be plain: numbers, text, booleans, dates and times.
"""

from __future__ import annotations

import pickle
import sys
import zlib
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from hammerline.operators.dedup import keep_latest
from hammerline.session import SHUFFLES_DROPPED

REPLACES = "is_replacement"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
PARTITIONS = "spark.sql.shuffle.partitions"
RETAINED = "spark.sql.streaming.minBatchesToRetain"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT, BUCKET = "_event", "_bucket"
BUCKETS = 1 << 14

# The processor travels to the executors by value, so that only the driver needs the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


class Newest(StatefulProcessor):
    """Emits a row that is the first of its key, or newer than the one before; a group is a bucket of keys."""

    def __init__(self, columns: Sequence[str], key: int, order: Sequence[int], at: int, retention: int):
        self.columns, self.key, self.order, self.at, self.retention = list(columns), key, list(order), at, retention
        self.change = Row(*self.columns, REPLACES)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.newest = handle.getValueState("newest", "rows binary")

    def _rank(self, row: tuple) -> list[tuple]:
        # As in Spark, a missing value comes before any other.
        return [(row[i] is not None, row[i]) if row[i] is not None else (False,) for i in self.order]

    def _expiry(self, row: tuple) -> int:
        return row[self.at] // 1000 + self.retention

    def _held(self) -> dict:
        kept = self.newest.get()
        return {} if kept is None else {row[self.key]: row for row in pickle.loads(zlib.decompress(kept[0]))}

    def _hold(self, held: dict) -> None:
        self.newest.update((zlib.compress(pickle.dumps(list(held.values()), pickle.HIGHEST_PROTOCOL), 1),))
        # One timer, for the first to go. An earlier one that is still set finds nothing to drop.
        self.handle.registerTimer(min(map(self._expiry, held.values())))

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held, best, places = self._held(), {}, None
        for row in rows:
            if places is None:
                places = [row.__fields__.index(c) for c in self.columns]
            mine = tuple([row[i] for i in places])
            name = mine[self.key]
            old = best.get(name) or held.get(name)
            if old is None or self._rank(mine) > self._rank(old):
                best[name] = mine
        if not best:
            return
        self._hold(held | best)
        for name, row in best.items():
            yield self.change(*row, name in held)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, fired = timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()
        left = {name: row for name, row in self._held().items() if self._expiry(row) >= now and self._expiry(row) != fired}
        if left:
            self._hold(left)
        else:
            self.newest.clear()
        yield from ()

    def close(self) -> None:
        pass


def _seconds(spark: SparkSession, interval: str) -> int:
    return int(spark.sql(f"SELECT CAST(date_diff(SECOND, TIMESTAMP_SECONDS(0), TIMESTAMP_SECONDS(0) + INTERVAL {interval}) AS BIGINT)").first()[0])


def newest_changes(
    stream: DataFrame,
    key: str = "record_hash",
    latest: str = "scraped_at",
    ties: Sequence[str] | None = None,
    lateness: str = "30 days",
    retention: str = "30 days",
    buckets: int = BUCKETS,
) -> DataFrame:
    """The stream of rows that are the newest of their key when they arrive, with
    ``is_replacement``: whether a row of that key was emitted before. The keys share ``buckets`` states."""
    nested = [f.name for f in stream.schema if isinstance(f.dataType, (T.ArrayType, T.MapType, T.StructType))]
    if nested:
        raise TypeError(f"columns {', '.join(nested)} are nested")
    if not isinstance(stream.schema[latest].dataType, (T.TimestampType, T.TimestampNTZType)):
        raise TypeError(f"{latest} is to be a timestamp")
    times = {f.name: f.dataType for f in stream.schema if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))}
    days = {f.name for f in stream.schema if isinstance(f.dataType, T.DateType)}
    usable = stream.where(F.col(key).isNotNull() & F.col(latest).isNotNull())
    event = usable.withColumn(EVENT, F.col(latest).cast("timestamp")).withWatermark(EVENT, lateness)
    # Times cross to Python as whole numbers, which compare there as they do here.
    plain = [
        F.unix_micros(F.col(c).cast("timestamp")).alias(c) if c in times else F.unix_date(c).alias(c) if c in days else F.col(c)
        for c in stream.columns
    ]
    bucket = F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")
    narrow = event.select(bucket.alias(BUCKET), EVENT, *plain)
    fields = [T.StructField(c, narrow.schema[c].dataType, True) for c in stream.columns]
    order = [latest, *(ties or [])]
    order += [c for c in stream.columns if c not in (key, *order)]
    where = {c: i for i, c in enumerate(stream.columns)}
    keep = _seconds(stream.sparkSession, retention) * 1000
    processor = Newest(stream.columns, where[key], [where[c] for c in order], where[latest], keep)
    out = T.StructType([*fields, T.StructField(REPLACES, T.BooleanType())])
    changes = narrow.groupBy(BUCKET).transformWithState(processor, out, "Update", "EventTime")
    back = [
        F.timestamp_micros(c).cast(times[c]).alias(c) if c in times else F.date_from_unix_date(c).alias(c) if c in days else F.col(c)
        for c in stream.columns
    ]
    return changes.select(*back, REPLACES)


@contextmanager
def _started_with(spark: SparkSession, partitions: int | None) -> Iterator[None]:
    """Keyed state with timers needs this store; a query keeps the settings it was started with, and
    its checkpoint the number of partitions of its first start.

    Every batch starts a Python worker and opens a store for each partition of the state, however few
    rows it has: about a second each. So there are no more of them than cores unless ``partitions`` says so.
    """
    usual = min(int(spark.conf.get(PARTITIONS)), spark.sparkContext.defaultParallelism)
    wanted = {PROVIDER: ROCKS, PARTITIONS: str(partitions or usual), RETAINED: "2", SHUFFLES_DROPPED: "true"}
    before = {name: spark.conf.get(name, None) for name in wanted}
    for name, value in wanted.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def write_newest(stream: DataFrame, path: str, checkpoint: str, partitions: int | None = None, **options) -> StreamingQuery:
    """Append the changes of a stream to a folder, one ``batch_id`` each; see :func:`newest_changes`
    for the options. A batch repeated after a failure replaces its first try. The state of a new
    checkpoint lies in ``partitions``, by default as many as there are cores."""

    def write(batch: DataFrame, batch_id: int) -> None:
        rows = batch.withColumn("batch_id", F.lit(batch_id).cast("long"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)

    with _started_with(stream.sparkSession, partitions):
        query = newest_changes(stream, **options).writeStream.foreachBatch(write).outputMode("update")
        return query.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def keep_newest(
    changes: DataFrame, key: str = "record_hash", latest: str = "scraped_at", ties: Sequence[str] | None = None
) -> DataFrame:
    """The newest row of each key from written changes, which hold few copies of any."""
    return keep_latest(changes.drop("batch_id", REPLACES), key, latest, ties)
