"""Bucketed and clustered tables: plans without a shuffle, files of one size."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import functions as F

from bindings import tables as t
from bindings.queries import _written_marts
from hammerline.plans import marts, serving
from hammerline.session import scratch_path
from hammerline.sources import layouts, sinks


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def layout(spark, sf):
    return _written_marts(spark, sf)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_benchmarks_are_made_without_shuffling_the_fact(spark, layout):
    fact = marts.read_fact(spark, layout)
    assert "Exchange" not in plan(marts.fct_price_benchmarks(fact))
    assert "Exchange" in plan(marts.fct_price_benchmarks(spark.read.parquet(layout.mart("fct_card_sales"))))
    assert values(marts.fct_price_benchmarks(fact)) == values(spark.read.parquet(layout.mart("fct_price_benchmarks")))


def test_star_join_leaves_the_fact_where_it_lies(spark, layout):
    fact, names, grades = marts.read_fact(spark, layout), *(spark.read.parquet(layout.mart(m)) for m in ("dim_fighter", "dim_grade"))
    text = plan(serving.with_labels(fact.withColumnRenamed("sale_date", "benchmark_date"), names, grades))
    assert text.count("Exchange") == text.count("BroadcastExchange") == 2


def test_bucketed_join(spark, sf, no_broadcast):
    dim = t.entities(spark, sf)
    resolved = t.resolved(spark, sf, dim)
    by = layouts.Buckets(tuple(marts.CARD_KEYS), tuple(marts.CARD_KEYS), 8)
    cards, sales = scratch_path(spark, "cards"), scratch_path(spark, "sales")
    layouts.save_bucketed(marts.dim_card(resolved, dim), cards, by)
    layouts.save_bucketed(resolved, sales, by)
    joined = marts.join_card(layouts.open_bucketed(spark, sales), layouts.open_bucketed(spark, cards), co_located=True)
    assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined)
    plain = marts.join_card(spark.read.parquet(sales), spark.read.parquet(cards))
    assert values(joined.select("sale_id", "card_id")) == values(plain.select("sale_id", "card_id"))


def test_a_new_session_knows_the_buckets(spark, layout):
    other = spark.newSession()
    other.sql(f"DROP TABLE {layouts._name(layout.mart('fct_card_sales'))}")
    fact = marts.read_fact(other, layout)
    assert "Exchange" not in plan(marts.fct_price_benchmarks(fact))
    assert fact.count() == spark.read.parquet(layout.mart("fct_card_sales")).count()


def sales(spark, n, per_day, hot=0):
    first = dt.date(2020, 1, 1)
    rows = [(i, first + dt.timedelta(days=i // per_day), Decimal(i)) for i in range(n)]
    rows += [(n + i, first + dt.timedelta(days=3), Decimal(i)) for i in range(hot)] + [(-1, None, Decimal(0))]
    return spark.createDataFrame(rows, "id int, day date, price decimal(12,2)")


def test_files_follow_bytes_not_days(spark):
    df = sales(spark, 3000, 2, hot=2000)  # 1500 thin days, and a busy one
    path = scratch_path(spark, "clustered")
    days = df.groupBy("day").agg(F.count("*").alias("rows"))
    layouts.save_clustered(df, path, "day", days, 10_000)
    _, files = layouts.table_size(spark, path)
    assert files == 1 and values(spark.read.parquet(path)) == values(df)
    placed = {r.day: (r.first, r.files) for r in layouts.clusters(days, 500).collect()}
    assert placed[None] == (0, 1) and placed[dt.date(2020, 1, 4)][1] == 5  # 2002 rows of one day
    firsts = [placed[d][0] for d in sorted(d for d in placed if d)]
    assert firsts == sorted(firsts) and max(firsts) <= 5002 // 500
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4k")
    try:
        layouts.save_clustered(df, path, "day", days, 500)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert 4 <= layouts.table_size(spark, path)[1] <= 24 and values(spark.read.parquet(path)) == values(df)


def test_marts_have_few_files_and_skip_by_day(spark, layout):
    _, files = layouts.table_size(spark, layout.mart("fct_price_benchmarks"))
    assert files <= 4  # some 2,500 days
    bench = spark.read.parquet(layout.mart("fct_price_benchmarks"))
    assert "EqualTo(benchmark_date," in plan(bench.where(F.col("benchmark_date") == F.lit(dt.date(1998, 6, 30))))


def test_bucket_number_grows_with_the_rows():
    assert [layouts.bucket_number(n, 100) for n in (0, 1, 100, 101, 400, 10**12)] == [1, 1, 1, 2, 4, layouts.MOST_BUCKETS]


def test_grain_of_a_mart(spark, tmp_path):
    df = sales(spark, 100, 2)
    for grain, folders in (("day", 51), ("month", 3)):
        sinks.save_mart(df, str(tmp_path / grain), "day", grain)
        names = [p.name for p in (tmp_path / grain).iterdir() if "=" in p.name]
        assert len(names) == folders
        assert values(spark.read.parquet(str(tmp_path / grain)).select("id", "day", "price")) == values(df)
