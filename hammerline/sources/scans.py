"""Scans (S1-S6, S8-S11). Every reader declares its schema."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline import fixed, schemas

CORRUPT = "_corrupt_record"
SEED_FILE = os.path.join(os.path.dirname(os.path.abspath(__file__)), "entities.csv")


class Layout:
    """Paths of a data folder: raw records, stages, warehouse, marts, state and logs."""

    def __init__(self, base: str):
        self.base = base.rstrip("/")

    def path(self, *parts: str) -> str:
        return "/".join([self.base, *parts])

    raw = property(lambda self: self.path("raw"))
    ingested = property(lambda self: self.path("processed", "ingested"))
    normalised = property(lambda self: self.path("processed", "normalised"))
    enriched = property(lambda self: self.path("processed", "enriched"))
    benchmarks = property(lambda self: self.path("processed", "benchmarks"))
    benchmark_versions = property(lambda self: self.path("processed", "benchmark_versions"))
    quarantine = property(lambda self: self.path("processed", "quarantine"))
    warehouse = property(lambda self: self.path("warehouse"))
    seen = property(lambda self: self.path("state", "seen_hashes"))
    run_log = property(lambda self: self.path("runs"))
    status = property(lambda self: self.path("status"))

    def mart(self, name: str) -> str:
        return self.path("marts", name)


def or_empty(spark: SparkSession, schema: str, read: Callable[[], DataFrame]) -> DataFrame:
    """What ``read`` returns, or no rows if its path doesn't exist. Any other failure, such
    as a schema that doesn't fit or a folder that may not be read, stays an error."""
    try:
        return read()
    except AnalysisException as failure:
        if failure.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def scan_raw(spark: SparkSession, raw_dir: str, source: str | None = None, hive: bool = True) -> DataFrame:
    """Raw NDJSON with the 17 declared fields, the file name and corrupt lines.

    ``hive`` folders are ``source=x/year=/month=/day=``, so asking for one source prunes
    folders; otherwise the first level is the bare source name and the glob narrows it.
    The file path is taken at the scan, where it is known.
    """
    schema = T.StructType([*schemas.RAW_SALE.fields, T.StructField(CORRUPT, T.StringType(), True)])
    reader = spark.read.schema(schema).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT)
    if hive:
        df = reader.option("basePath", raw_dir).json(raw_dir)
        if source is not None:
            df = df.where(F.col("source") == source)
    else:
        df = reader.json(f"{raw_dir.rstrip('/')}/{source or '*'}/year=*/month=*/day=*/*.ndjson")
    return df.select(*schema.fieldNames(), F.col("_metadata.file_path").alias("source_file"))


def split_corrupt(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed records, and the lines that do not fit the schema.

    Both sides keep all fields, so the same fields are parsed and the same lines fail.
    """
    bad = F.col(CORRUPT).isNotNull()
    return raw.where(~bad).drop(CORRUPT), raw.where(bad).withColumnRenamed(CORRUPT, "line")


def scan_stage(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """S3: a stage's Parquet; a given schema saves reading footers."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def scan_table(spark: SparkSession, warehouse: str, source: str) -> DataFrame:
    """The raw warehouse table of one source, by pruning its partition."""
    return spark.read.parquet(warehouse).where(F.col("source") == source)


def scan_seed(spark: SparkSession, path: str | None = None) -> DataFrame:
    """The alias seed with its casts; lines starting with # are remarks.

    Without a path the built-in seed is used; it is read on the driver (61 lines), as
    package files are not visible to executors.
    """
    if path is not None:
        rows = spark.read.schema(schemas.ENTITY_SEED).option("comment", "#").csv(path, header=True)
    else:
        import csv

        with open(SEED_FILE, encoding="utf-8") as handle:
            lines = csv.DictReader(line for line in handle if not line.startswith("#"))
            names = schemas.ENTITY_SEED.fieldNames()
            rows = spark.createDataFrame([tuple(r[n] for n in names) for r in lines], schemas.ENTITY_SEED)
    return rows.withColumn("active", F.col("active").try_cast("boolean")).withColumn(
        "debut_year", F.col("debut_year").try_cast("long")
    )


def grade_table(spark: SparkSession) -> DataFrame:
    """The literal grade dimension."""
    return spark.createDataFrame(fixed.GRADES, schemas.GRADE_DIM)


def scan_run_log(spark: SparkSession, path: str, documents: bool = True) -> DataFrame:
    """Run summaries; unreadable ones are skipped.

    ``documents``: one JSON document per file. Otherwise one per line, as appended by K6.
    """
    schema = T.StructType([*schemas.RUN_LOG.fields, T.StructField(CORRUPT, T.StringType(), True)])
    docs = (
        spark.read.schema(schema)
        .option("multiLine", documents)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .json(path)
    )
    return (
        docs.where(F.col(CORRUPT).isNull())
        .drop(CORRUPT)
        .withColumn("started_at", F.try_to_timestamp("started_at"))
        .withColumn("completed_at", F.try_to_timestamp("completed_at"))
    )


def scan_titles(spark: SparkSession, path: str) -> DataFrame:
    """Every non-empty listing title below a folder; bad lines are skipped."""
    schema = T.StructType([T.StructField("listing_title", T.StringType(), True)])
    return (
        spark.read.schema(schema)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.*json{,.gz}")
        .json(path)
        .where(F.coalesce(F.col("listing_title"), F.lit("")) != "")
    )


def scan_cert_cache(spark: SparkSession, path: str) -> DataFrame:
    """A JSON map certificate -> record as rows; a missing or malformed file is empty.

    A certificate cached as missing keeps its key with a NULL record.
    """
    cached = F.from_json("value", T.MapType(T.StringType(), schemas.CERT))
    text = or_empty(spark, "value string", lambda: spark.read.text(path, wholetext=True))
    return (
        text.select(F.explode(cached).alias("cert_key", "cert"))
        .where(F.col("cert_key") != "_meta")
        .select("cert_key", "cert")
    )


def scan_seen_json(spark: SparkSession, path: str) -> DataFrame:
    """A JSON array of hashes; a missing or blank file is empty, bad JSON an error."""
    text = or_empty(spark, "value string", lambda: spark.read.text(path, wholetext=True))
    hashes = F.from_json("value", T.ArrayType(T.StringType()), {"mode": "FAILFAST"})
    return (
        text.where(F.trim(F.regexp_replace("value", r"\s", "")) != "")
        .select(F.explode(hashes).alias("record_hash"))
        .distinct()
    )


def scan_seen(spark: SparkSession, path: str) -> DataFrame:
    """The seen-hash table; empty before the first run."""
    schema = "record_hash string"
    return or_empty(spark, schema, lambda: spark.read.schema(schema).parquet(path))
