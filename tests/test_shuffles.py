"""Rows that need not move are not shuffled, and folders get few files."""

import datetime as dt
import glob
from contextlib import contextmanager

import pytest
from conftest import values
from pyspark.sql import functions as F

from bindings import tables as t
from hammerline.operators import dedup, incremental, rolling
from hammerline.session import SHUFFLES_DROPPED, parts_apart, scratch_path
from hammerline.sources import layouts, sinks
from hammerline.sources.versions import Versions
from hammerline.streaming import compact
from hammerline.streaming import ingest as streaming

DAY = dt.date(2024, 1, 30)


@contextmanager
def settings(spark, **wanted):
    wanted = {k.replace("__", "."): v for k, v in wanted.items()}
    before = {k: spark.conf.get(k) for k in wanted}
    for k, v in wanted.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def priced(spark):
    rows = [(f"h{i}", None if i % 7 == 0 else "ab"[i % 2], "PSA 9", "PSA", DAY + dt.timedelta(days=i % 40), i % 11, False) for i in range(200)]
    df = spark.createDataFrame(rows, "record_hash string, fighter_name_canonical string, grade string, grader string, sale_date date, price int, is_outlier boolean")
    return df.withColumn("sale_price_usd", F.col("price").cast("decimal(12,2)")).drop("price")


def test_small_frames_reach_rows_where_they_are(spark, monkeypatch):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        rolled = rolling.rolling_by_date(priced(spark))
        assert "hashpartitioning" not in plan(rolled)
        found = values(rolled)
        monkeypatch.setattr(rolling, "is_small", lambda *_: False)
        shuffled = rolling.rolling_by_date(priced(spark))
        assert "hashpartitioning" in plan(shuffled)
    assert found == values(shuffled) and len(found) == 200


@pytest.mark.parametrize("small", [True, False])
def test_a_refresh_deals_narrow_rows(spark, monkeypatch, small):
    put = []

    def noted(self, table, df, *args, plain=incremental.Change.put, **kw):
        put.append((table, kw.get("deal", True)))
        return plain(self, table, df, *args, **kw)

    monkeypatch.setattr(incremental.Change, "put", noted)
    monkeypatch.setattr(incremental, "is_small", lambda *_: small)
    rows = rolling.eligible(priced(spark))
    store = Versions(spark, scratch_path(spark, "benchmarks"))
    incremental.refresh(rows.where(F.col("sale_date") < F.lit(DAY + dt.timedelta(days=20))), store)
    incremental.refresh(rows, store)
    assert put.count(("benchmarks", not small)) == 2 and ("benchmarks", small) not in put
    wanted = rolling.rolling_by_date(rows)
    assert values(incremental.stored_benchmarks(store).select(wanted.columns)) == values(wanted)


KEYED = "record_hash string, scraped_at int, x int"


@pytest.mark.parametrize("small", [True, False])
def test_only_keys_that_may_be_known_meet_the_seen_ones(spark, monkeypatch, small):
    monkeypatch.setattr(dedup, "is_small", lambda *_: small)
    batch = spark.createDataFrame([(None if i == 50 else f"k{i % 40}", i, i % 3) for i in range(80)], KEYED)
    seen = spark.createDataFrame([(f"k{i}",) for i in range(30, 300)] + [(None,), ("k31",)], "record_hash string")
    fresh = dedup.new_records(batch, seen)
    latest = {f"k{i % 40}": (f"k{i % 40}", i, i % 3) for i in range(80) if i != 50}
    assert values(fresh) == sorted(v for k, v in latest.items() if int(k[1:]) < 30)
    assert "Union" in plan(fresh)  # rows of unknown keys take no part in the anti-join
    assert values(dedup.new_records(batch, seen.limit(0))) == sorted(latest.values())


def test_large_batches_and_merges_are_written_without_a_shuffle(spark, monkeypatch):
    put = []

    def noted(self, table, df, *args, plain=compact.Change.put, **kw):
        folders = plain(self, table, df, *args, **kw)
        put.append((kw.get("deal", True), folders))
        return folders

    monkeypatch.setattr(compact.Change, "put", noted)
    found = {}
    for least, written in ((1, True), (10_000, False)):
        monkeypatch.setattr(compact, "DEALT_ROWS", least)
        put.clear()
        path = scratch_path(spark, "appended")
        write = compact.appender(spark, path, buckets=4, fanout=3, written=written)
        for i in range(4):
            rows = [(f"k{n}", i, n) for n in range(50 * i, 50 * i + 100)]
            write(spark.createDataFrame(rows, KEYED), i)
        found[written] = values(compact.read_appended(spark, path))
        merges = [folders for _, folders in put if len(put) == 5 and folders is put[3][1]]
        assert [deal for deal, _ in put] == [not written] * 3 + [False] + [not written]
        assert len(merges) == 1 and [f.files for f in merges[0]] == [1] * 4
    assert found[True] == found[False] and len(found[True]) == 250


def test_parts_of_a_merge_keep_their_tasks(spark, tmp_path):
    spark.range(10).coalesce(1).write.parquet(str(tmp_path / "x"))
    part = spark.read.parquet(str(tmp_path / "x")).coalesce(1)
    with parts_apart(spark):
        assert part.unionByName(part).rdd.getNumPartitions() == 2


def test_a_prefix_gets_one_file_of_a_batch(spark, tmp_path):
    made = spark.range(4000).select(F.sha2(F.col("id").cast("string"), 256).alias("record_hash"), F.col("id").cast("int").alias("scraped_at"), F.lit(1).alias("x"))
    made.repartition(8).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(KEYED).parquet(str(tmp_path / "in"))
    with settings(spark, spark__sql__adaptive__coalescePartitions__enabled="false"):
        streaming.append_new(stream, str(tmp_path / "out"), str(tmp_path / "state"), prefix=1).awaitTermination()
    files = glob.glob(str(tmp_path / "out" / "*" / "*" / "*.parquet"))
    assert len(files) == 16 and spark.read.parquet(str(tmp_path / "out")).count() == 4000


def test_what_is_derived_and_hex_does_not_go_through_shuffles(spark, tmp_path):
    key = F.md5(F.col("id").cast("string"))
    df = spark.range(300).select("id", (F.col("id") % 5).alias("k"), F.when(F.col("id") % 9 > 0, key).alias("key"), F.date_add(F.lit(DAY), (F.col("id") % 7).cast("int")).alias("day"))
    by = layouts.Buckets(("k",), ("k", "id"), 4)
    path = str(tmp_path / "bucketed")
    layouts.save_bucketed(df.drop("key", "day"), path, by, lambda rows: rows.withColumn("own", F.md5(F.col("id").cast("string"))))
    spark.sql(f"DROP TABLE {layouts._name(path)}")
    assert values(layouts.open_bucketed(spark, path)) == values(df.select("id", "k", key))
    days = df.groupBy("day").agg(F.count("*").alias("rows"))
    layouts.save_clustered(df, str(tmp_path / "days"), "day", days, 50, ["key"], hexed=["key"])
    back = spark.read.parquet(str(tmp_path / "days"))
    assert back.columns == df.columns and values(back) == values(df)
    codecs = {f.split(".")[-2] for folder in ("bucketed", "days") for f in glob.glob(str(tmp_path / folder / "*.parquet"))}
    assert codecs == {"zstd"}


def test_sales_laid_out_by_month_go_to_their_folders_as_they_lie(spark, sf, tmp_path):
    laid = t.ingested(spark, sf, monthly=True)
    assert values(laid.select("record_hash", "l_partkey", "sale_date")) == values(t.ingested(spark, sf).select("record_hash", "l_partkey", "sale_date"))
    stored = t.stored_sales(spark, sf, monthly=True).withColumn("file", F.input_file_name())
    files = stored.groupBy("source", F.trunc("sale_date", "month").alias("month")).agg(F.countDistinct("file").alias("files"))
    assert files.where("files > 1").isEmpty()
    path = str(tmp_path / "out")
    sinks.write_source_tables(laid, path, grain="month", deal=False)
    folders, found = glob.glob(f"{path}/*/*/"), glob.glob(f"{path}/*/*/*.parquet")
    assert len(found) <= 2 * len(folders)  # one of single rows, one of the newest of copies
    back = spark.read.parquet(path)
    assert values(back.select("record_hash", "listing_title", "sale_price_usd")) == values(laid.select("record_hash", "listing_title", "sale_price_usd"))


def test_a_batch_is_stored_by_prefix_and_its_shuffles_go(spark, tmp_path, monkeypatch):
    seen = []

    def noted(rows, *args, plain=streaming.new_records):
        placed = rows.select(F.substring("record_hash", 1, 1).alias("p"), F.input_file_name().alias("file"))
        files = placed.groupBy("p").agg(F.countDistinct("file").alias("files"))
        seen.append((rows.sparkSession.conf.get(SHUFFLES_DROPPED, None), max(r["files"] for r in files.collect())))
        return plain(rows, *args)

    monkeypatch.setattr(streaming, "new_records", noted)
    keys = [f"{k}{i:02d}" for k in ("a", "b", "AB", "zz", "0f1", "") for i in range(50)]
    spark.createDataFrame([(k, i % 3, i) for i, k in enumerate(keys * 2)], KEYED).repartition(8).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(KEYED).parquet(str(tmp_path / "in"))
    streaming.append_new(stream, str(tmp_path / "out"), str(tmp_path / "state"), ties=["x"], prefix=1).awaitTermination()
    assert seen == [("true", 1)]
    whole = spark.read.parquet(str(tmp_path / "in"))
    assert values(spark.read.parquet(str(tmp_path / "out")).select(whole.columns)) == values(dedup.keep_latest(whole, ties=["x"]))


def test_many_frames_are_joined_without_sorting_rows(spark, monkeypatch):
    odd = F.when(F.col("record_hash") == "h1", None).when(F.col("record_hash") == "h2", "").when(F.col("record_hash") == "h3", "AB").when(
        F.col("record_hash") == "h4", "abc").when(F.col("record_hash") == "h5", F.sha2("record_hash", 256)).otherwise(F.col("record_hash"))
    rows = priced(spark).withColumn("record_hash", odd)
    want = values(rolling.rolling_by_date(rows))
    monkeypatch.setattr(rolling, "is_small", lambda *_: False)
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        rolled = rolling.rolling_by_date(rows)
        assert "ShuffledHashJoin" in plan(rolled) and "SortMergeJoin" not in plan(rolled)
        assert values(rolled) == want and rolled.columns[: len(rows.columns)] == rows.columns
