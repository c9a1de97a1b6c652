"""Tables laid out for the work that reads them: bucketed by key, or clustered by day.

A bucketed table keeps rows of equal keys together, so windows and joins on its keys need no
shuffle. Spark knows buckets from its catalog only; what :func:`open_bucketed` needs to register
a table again, in any session, stands in a small text beside the data.

A clustered table has contiguous days in files of about one size, however thin or busy the days
are; filters on the day skip files and row groups by their bounds.
"""

from __future__ import annotations

import hashlib
import json
import math
from collections.abc import Callable, Sequence
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline.session import CODEC, is_small, materialise

# What a bucket or file should hold at most.
BUCKET_ROWS = 4_000_000
LEAST_BUCKET_ROWS = 20_000
FILE_BYTES = 128 * 1024 * 1024
MOST_BUCKETS = 65_536


@dataclass(frozen=True)
class Buckets:
    """Rows of equal ``keys`` share one of ``number`` buckets, in which files are sorted."""

    keys: tuple[str, ...]
    sort: tuple[str, ...]
    number: int


def bucket_number(rows: int, per_bucket: int = BUCKET_ROWS, cores: int = 1) -> int:
    """A power of two, so that tables of different size still align by whole factors.

    Tables of fewer full buckets than cores get smaller ones, as a bucket is read by one task.
    """

    def power(buckets: float) -> int:
        return 1 << max(0, math.ceil(math.log2(max(1.0, buckets))))

    spread = min(power(cores), power(rows / LEAST_BUCKET_ROWS))
    return min(MOST_BUCKETS, max(power(rows / per_bucket), spread))


def _name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def _layout(path: str) -> str:
    return path.rstrip("/") + ".layout"


def save_bucketed(
    df: DataFrame, path: str, buckets: Buckets, derive: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> DataFrame:
    """Write a table by buckets, replacing it, and return it as Spark's catalog knows it.

    Rows are shuffled once by the bucket's own hash. What ``derive`` adds, column by column, is made
    after the shuffle and does not go through it. Adaptive execution splits a bucket that
    holds a large share of the rows over several tasks, and has one task write several small ones.
    """
    spark, name = df.sparkSession, _name(path)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    rows = derive(df.hint("rebalance", buckets.number, *buckets.keys))
    (
        rows.write.mode("overwrite")
        .format("parquet")
        .option("compression", CODEC)
        .option("path", path)
        .bucketBy(buckets.number, *buckets.keys)
        .sortBy(*buckets.sort)
        .saveAsTable(name)
    )
    spec = json.dumps(asdict(buckets) | {"schema": rows.schema.jsonValue()})
    spark.range(1).select(F.lit(spec).alias("value")).coalesce(1).write.mode("overwrite").text(_layout(path))
    return spark.table(name)


def open_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """A table written by :func:`save_bucketed`, registered if this session doesn't know it."""
    name = _name(path)
    if not spark.catalog.tableExists(name):
        spec = json.loads(spark.read.text(_layout(path)).first()["value"])
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in T.StructType.fromJson(spec["schema"]))
        spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet LOCATION '{path}' CLUSTERED BY ({', '.join(spec['keys'])}) "
            f"SORTED BY ({', '.join(spec['sort'])}) INTO {spec['number']} BUCKETS"
        )
    return spark.table(name)


def table_size(spark: SparkSession, path: str) -> tuple[int, int]:
    """(bytes, files) of a written table, listed by Spark."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)
    size = files.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("bytes"), F.count("*").alias("files")).first()
    return size["bytes"], size["files"]


def clusters(days: DataFrame, rows_per_file: int) -> DataFrame:
    """(day, first, files) from (day, rows): contiguous days share a file, busy days get several.

    One row per day, so the running total is taken over the calendar, not over the rows.
    """
    before = F.sum("rows").over(W.orderBy(F.col("day").asc_nulls_first()).rowsBetween(W.unboundedPreceding, -1))
    placed = days.withColumn("before", F.coalesce(before, F.lit(0)))
    return placed.select(
        "day", F.floor(F.col("before") / rows_per_file).alias("first"), F.ceil(F.col("rows") / rows_per_file).alias("files")
    )


def save_clustered(
    df: DataFrame, path: str, day: str, days: DataFrame, rows_per_file: int, sort: Sequence[str] = (), hexed: Sequence[str] = ()
) -> None:
    """Write a table in files of contiguous days; ``days`` (day, rows) says how busy each is.
    ``hexed`` columns, which hold keys in lowercase hex, are shuffled as bytes."""
    numbered = materialise(clusters(days, max(1, rows_per_file))).withColumnRenamed("day", "_day")
    side = F.broadcast(numbered) if is_small(numbered) else numbered
    spread = F.pmod(F.xxhash64(*df.columns), F.greatest("files", F.lit(1)))
    # Days that are not listed go with the first.
    cluster = F.coalesce(F.col("first") + spread, F.lit(0))
    placed = df.join(side, F.col(day) == F.col("_day"), "left").withColumn("_cluster", cluster)
    placed = placed.select(*df.columns, "_cluster").withColumns({c: F.unhex(c) for c in hexed}).hint("rebalance", "_cluster")
    ordered = placed.sortWithinPartitions("_cluster", day, *sort).drop("_cluster")
    ordered = ordered.withColumns({c: F.lower(F.hex(c)) for c in hexed})
    ordered.write.mode("overwrite").option("compression", CODEC).parquet(path)
