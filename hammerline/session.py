"""Session settings, the shared scratch folder, and size-checked broadcasts."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Largest table handed to every executor: rows and bytes of its JSON form.
BROADCAST_ROWS = 200_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Of Parquet files: hashes and addresses take about half of what they take in Spark's default.
CODEC = "zstd"
SHUFFLES_DROPPED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "hammerline", master: str | None = None, **conf: str) -> SparkSession:
    """A UTC session with adaptive execution; cluster sizing is left to the deployment."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The folder for intermediate tables: ``spark.checkpoint.dir`` of the session.

    Only a local session without that setting gets a temporary folder of its own; on a
    cluster a machine-local folder would be lost with its executor.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if configured:
        if current is None:
            context.setCheckpointDir(configured)
        return configured
    if current:
        return current
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="hammerline-"))
    return context.getCheckpointDir()


# Scratch paths handed out inside each open scratch_scope, the innermost last.
_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the scratch folder."""
    path = f"{scratch_root(spark).rstrip('/')}/hammerline/{name}-{uuid.uuid4().hex}"
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Intermediate tables written inside are deleted at the end.

    For jobs that write their result: a DataFrame that still reads an intermediate table
    must not leave the scope.
    """
    _SCOPES.append([])
    try:
        yield
    finally:
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCOPES.pop():
            target = spark._jvm.org.apache.hadoop.fs.Path(path)
            target.getFileSystem(hadoop).delete(target, True)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """The shuffle files of every query inside are deleted as it ends, not when the driver next collects
    garbage: jobs of many queries would else keep all of them on the executors' disks at once.

    A DataFrame must not be acted on twice inside; one derived from it may.
    """
    with _setting(spark, SHUFFLES_DROPPED, "true"):
        yield


@contextmanager
def _setting(spark: SparkSession, name: str, value: str) -> Iterator[None]:
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def open_files(spark: SparkSession, folders: int):
    """Writes inside keep a file open for each of so many folders instead of sorting by folder."""
    return _setting(spark, "spark.sql.maxConcurrentOutputFileWriters", str(folders))


def parts_apart(spark: SparkSession):
    """Unions inside keep the tasks of their parts, also if each part is a single one."""
    return _setting(spark, "spark.sql.unionOutputPartitioning", "false")


def materialise(df: DataFrame) -> DataFrame:
    """Compute once and cut the lineage at a reliable checkpoint."""
    scratch_root(df.sparkSession)
    return df.checkpoint(eager=True)


def write_table(df: DataFrame, name: str) -> DataFrame:
    """Compute once into a Parquet table of the scratch folder and read it back.

    Unlike a checkpoint the result keeps column pruning and filter pushdown, and its
    file sizes tell the planner which later joins may broadcast it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", CODEC).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_small(df: DataFrame, *by: str) -> DataFrame:
    """Give a scan of fewer partitions than cores to all cores.

    Spark sizes file splits so that this only happens for inputs of a few megabytes per
    core, where a single row group would otherwise keep one core busy. Larger scans are
    returned as they are. ``by`` should be a well spread key.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if df.rdd.getNumPartitions() < cores else df


def spread_evenly(df: DataFrame, per_core: int = 4) -> DataFrame:
    """Deal the rows of a scan evenly over several tasks a core, for work that is dear per row.

    A file is split by bytes, but read by row groups: of the splits of a large row group one has all
    its rows and the others none, so a scan of many partitions may still keep few cores busy.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(max(per_core * cores, df.rdd.getNumPartitions()))


def is_small(kept: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure an already materialised table against the broadcast limits.

    No more rows than the limit are looked at, however large the table is.
    """
    size = kept.limit(max_rows + 1).agg(
        F.count("*").alias("rows"),
        F.coalesce(F.sum(F.octet_length(F.to_json(F.struct("*")))), F.lit(0)).alias("bytes"),
    ).first()
    return size["rows"] <= max_rows and size["bytes"] <= max_bytes


def broadcast_if_small(df: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Materialise a side table and hint a broadcast only when its measured size allows.

    Beyond the limit the plain table is returned and the join shuffles, with skewed
    partitions split by adaptive execution.
    """
    kept = materialise(df)
    return F.broadcast(kept) if is_small(kept, max_rows) else kept


def hex_to_bytes(df: DataFrame, *columns: str) -> DataFrame:
    """Texts that are lowercase hex, as hashes are, as half as many bytes in a column beside, for a shuffle;
    others stay as they are. See :func:`bytes_to_hex`."""
    packed = {c: F.when(F.lower(F.hex(F.unhex(c))) == F.col(c), F.unhex(c)) for c in columns}
    beside = df.withColumns({f"_{c}_bytes": value for c, value in packed.items()})
    return beside.withColumns({c: F.when(F.col(f"_{c}_bytes").isNull(), F.col(c)) for c in columns})


def bytes_to_hex(df: DataFrame, *columns: str) -> DataFrame:
    """The texts that :func:`hex_to_bytes` was given."""
    back = df.withColumns({c: F.coalesce(F.lower(F.hex(f"_{c}_bytes")), F.col(c)) for c in columns})
    return back.drop(*[f"_{c}_bytes" for c in columns])


def left_join_spread_nulls(
    left: DataFrame, right: DataFrame, keys: list[str], spread_by: Column, buckets: int = 4096
) -> DataFrame:
    """Left equi-join in which rows with a NULL key do not all meet in one partition.

    NULL keys never match, yet a shuffle join sends every such row to the same task.
    A second key spreads them: -1 for rows that can match, a hash bucket otherwise.
    """
    any_null = F.lit(False)
    for key in keys:
        any_null = any_null | F.col(key).isNull()
    spread = F.when(any_null, F.pmod(F.xxhash64(spread_by), F.lit(buckets)).cast("int")).otherwise(F.lit(-1))
    return (
        left.withColumn("_spread", spread)
        .join(right.withColumn("_spread", F.lit(-1)), [*keys, "_spread"], "left")
        .drop("_spread")
    )
