"""Structured Streaming form of raw ingest and cross-run dedup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from hammerline import schemas
from hammerline.operators.dedup import new_records
from hammerline.session import CODEC, bytes_to_hex, hex_to_bytes, scratch_scope, shuffles_dropped, write_table
from hammerline.sources.scans import or_empty


def stream_raw(spark: SparkSession, raw_dir: str, max_files: int = 1000) -> DataFrame:
    """S1 as a stream: new NDJSON files below the raw folder, a bounded number per batch."""
    return (
        spark.readStream.schema(schemas.RAW_SALE)
        .option("maxFilesPerTrigger", max_files)
        .option("basePath", raw_dir)
        .json(raw_dir)
    )


def stream_dedup(stream: DataFrame, key: str = "record_hash") -> DataFrame:
    """J8 as keyed state, exact: the first row to arrive of every key, however late copies come.

    The state holds every key ever seen, spread over the state partitions, and a batch
    touches only its own keys. Sessions with long histories should keep it in RocksDB.
    """
    return stream.where(F.col(key).isNotNull()).dropDuplicates([key])


def append_new(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    key: str = "record_hash",
    latest: str = "scraped_at",
    ties: list[str] | None = None,
    prefix: int = 2,
) -> StreamingQuery:
    """J8, exact: every available row whose key no earlier batch has written; of copies
    within a batch the newest.

    The written table itself is the seen set. It is partitioned by the first ``prefix``
    characters of the key, and a batch reads only the key column of the folders its own
    keys fall into. A batch writes its own folders, so a batch repeated after a failure
    replaces its first try. The rows of a prefix are brought together as the batch is stored, and
    written as they lie: a folder has few files, however many tasks a batch has, and rows are shuffled
    once. Shuffle files go with the step that made them.
    """
    spark = stream.sparkSession
    seen_schema = f"{key} string, key_prefix string, batch_id long"
    start = F.substring(F.col(key), 1, prefix)

    def write(batch: DataFrame, batch_id: int) -> None:
        with scratch_scope(spark), shuffles_dropped(batch.sparkSession):
            keyed = hex_to_bytes(batch.where(F.col(key).isNotNull()).withColumn("key_prefix", start), key)
            rows = write_table(bytes_to_hex(keyed.hint("rebalance", "key_prefix"), key).drop("key_prefix"), "batch")
            prefixes = [r[0] for r in rows.select(start).distinct().collect()]  # at most 16 ** prefix of a hash
            seen = or_empty(spark, seen_schema, lambda: spark.read.schema(seen_schema).parquet(path))
            seen = seen.where(F.col("key_prefix").isin(prefixes)).where(F.col("batch_id") < batch_id)
            (
                new_records(rows, seen, key, latest, ties)
                .withColumns({"key_prefix": start, "batch_id": F.lit(batch_id).cast("long")})
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .option("compression", CODEC)
                .partitionBy("key_prefix", "batch_id")
                .parquet(path)
            )

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
