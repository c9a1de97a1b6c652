"""Cores kept busy, few state calls, and nothing kept or stored that no later step reads."""

import datetime as dt
import os
from types import SimpleNamespace

from pyspark.sql import Row
from pyspark.sql import functions as F

from bindings import queries
from bindings import tables as t
from hammerline import session
from hammerline.plans import ingest, marts
from hammerline.schemas import RAW_SALE
from hammerline.session import scratch_path, scratch_root, shuffles_dropped, spread_evenly, write_table
from hammerline.sources import scans, sinks
from hammerline.streaming import newest

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def test_dear_rows_of_one_row_group_are_spread(spark, tmp_path, sf):
    spark.range(4000).coalesce(1).write.parquet(str(tmp_path / "rows"))
    settings = {"spark.sql.files.maxPartitionBytes": "1000", "spark.sql.files.openCostInBytes": "1"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        scan = spark.read.parquet(str(tmp_path / "rows"))
        filled = lambda df: [r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()]
        assert scan.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
        assert len(filled(scan)) == 1  # splits enough, but one has all rows
        assert len(filled(spread_evenly(scan))) >= 32 and max(filled(spread_evenly(scan))) < 500
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    for name in ("ebay", "varied", "myslabs", "pwcc"):
        made = queries.QUERIES[f"listing_pages_{name}"](spark, sf)
        assert "RoundRobinPartitioning" in made._jdf.queryExecution().executedPlan().toString()


class Handle:
    """State and timers of one bucket; calls are counted."""

    def __init__(self):
        self.kept, self.timers, self.calls = None, set(), 0

    def getValueState(self, name, schema):
        def called(value=None):
            self.calls += 1
            return value

        def update(value):
            called()
            self.kept = value

        return SimpleNamespace(get=lambda: called(self.kept), update=update, clear=lambda: update(None))

    def registerTimer(self, at):
        self.calls += 1
        self.timers.add(at)


def test_a_bucket_takes_three_calls_and_drops_its_rows_one_by_one():
    handle, made = Handle(), newest.Newest(["k", "at"], 0, [1], 1, retention=10)
    made.init(handle)
    row = lambda k, ms: Row(k=k, at=ms * 1000)
    out = list(made.handleInputRows(0, iter([row(f"k{i % 500}", i) for i in range(1000)]), None))
    assert handle.calls == 3 and len(out) == 500 and not any(r.is_replacement for r in out)
    assert {r.k: r.at for r in out} == {f"k{i}": (i + 500) * 1000 for i in range(500)}
    assert list(made.handleInputRows(0, iter([row("k0", 3)]), None)) == []  # older than what is held
    assert [tuple(r) for r in made.handleInputRows(0, iter([row("k0", 2000)]), None)] == [("k0", 2000000, True)]
    now = SimpleNamespace(getCurrentWatermarkInMs=lambda: 900)
    list(made.handleExpiredTimer(0, now, SimpleNamespace(getExpiryTimeInMs=lambda: 510)))
    held = made._held()
    assert len(held) == 1 + sum(i + 500 + 10 >= 900 for i in range(1, 500)) and "k0" in held
    assert min(map(made._expiry, held.values())) in handle.timers


def test_state_has_no_more_partitions_than_cores(spark, tmp_path):
    schema = "record_hash string, scraped_at timestamp"
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text('{"record_hash": "a", "scraped_at": "2024-01-01T00:00:00Z"}')
    before = spark.conf.get(newest.PARTITIONS)
    spark.conf.set(newest.PARTITIONS, "40")
    try:
        rows = spark.readStream.schema(schema).json(str(tmp_path / "in"))
        newest.write_newest(rows, scratch_path(spark, "changes"), str(tmp_path / "state")).awaitTermination()
        assert spark.conf.get(newest.PARTITIONS) == "40"
    finally:
        spark.conf.set(newest.PARTITIONS, before)
    stores = [n for n in os.listdir(tmp_path / "state" / "state" / "0") if n.isdigit()]
    assert len(stores) == spark.sparkContext.defaultParallelism


def test_parsed_rows_and_shuffles_go_with_their_step(spark, tmp_path, monkeypatch):
    layout, seen = scans.Layout(str(tmp_path / "sales")), []
    fixed = {"record_hash": "h", "listing_id": "1", "source": "ebay", "sale_price_usd": "5.00", "sale_date": "2024-01-02", "scraped_at": "2024-01-02 00:00:00"}
    row = [F.lit(fixed.get(f.name)).cast(f.dataType).alias(f.name) for f in RAW_SALE.fields]
    sinks.append_raw(spark.range(3).select(*row), layout.raw, F.lit("2024-01-03").cast("date"))
    kept = f"{scratch_root(spark)}/hammerline"
    parsed = lambda: {n for n in os.listdir(kept) if n.startswith("parsed-")} if os.path.isdir(kept) else set()
    before, plain = parsed(), ingest.normalise

    def normalise(rows):
        seen.append((parsed() - before, spark.conf.get(CLEANUP)))
        return plain(rows)

    monkeypatch.setattr(ingest, "normalise", normalise)
    setting = spark.conf.get(CLEANUP, None)
    report = ingest.run_stages(spark, layout, as_of=dt.datetime(2024, 1, 3))
    assert seen == [(set(), "true")] and spark.conf.get(CLEANUP, None) == setting
    assert report.raw["rows"] == 3 and report.ingested["rows"] == 1
    with shuffles_dropped(spark):  # what is derived from a frame can be acted on after it
        counts = spark.range(100).groupBy(F.col("id") % 7).count()
        assert counts.count() == counts.count() == len(counts.collect())


def test_only_columns_that_are_read_are_stored(spark, sf, monkeypatch):
    stored = {}

    def noted(df, name):
        stored[name] = set(df.columns)
        return write_table(df, name)

    for module in (queries, marts, t):
        monkeypatch.setattr(module, "write_table", noted)
    queries.QUERIES["star_fact_bucketed"](spark, sf)
    assert stored.pop("resolved") == set(marts.RESOLVED_COLUMNS)
    queries.QUERIES["mart_cards"](spark, sf)
    assert stored.pop("resolved") == set(marts.RESOLVED_COLUMNS)
    queries.QUERIES["rolling_rows_blocks"](spark, sf)
    assert stored.pop("fact") == {"fighter_id", "grade_id", "sale_date", "sale_id", "sale_price_usd"}


def test_tables_on_the_way_to_marts_go_once_read(spark, sf, tmp_path, monkeypatch):
    scratch_root(spark)
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    folders = lambda: {n.rsplit("-", 1)[0] for n in os.listdir(tmp_path / "hammerline")}
    seen, build, bench = [], marts.build_marts, marts.fct_price_benchmarks
    setting = spark.conf.get(CLEANUP, None)

    def noted(plain):
        def run(*args, **options):
            seen.append((folders(), spark.conf.get(CLEANUP, None)))
            return plain(*args, **options)

        return run

    monkeypatch.setattr(marts, "build_marts", noted(build))
    monkeypatch.setattr(marts, "fct_price_benchmarks", noted(bench))
    queries.QUERIES["mart_cards"](spark, sf)
    assert seen == [({"layout"}, setting), ({"layout"}, "true")] and folders() == {"layout"}
