"""Quantiles from stored counts against those of the rows, over spans and after changes."""

import datetime as dt
import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from hammerline.operators import quantile_store
from hammerline.operators.outliers import exact_quantiles, iqr_bounds
from hammerline.session import scratch_path
from hammerline.sources.versions import Versions

KEYS = ("source", "grade")
SCHEMA = "source string, grade string, sale_date date, sale_price_usd double, note string"


def made(n, seed):
    rng = random.Random(seed)
    price = lambda: rng.choice([rng.expovariate(1e-2), -rng.random() * 50, float(rng.randrange(5)), 1e-9, 3e300, None])
    return [
        (rng.choice("ab"), rng.choice(["x", None]), None if rng.random() < 0.02 else dt.date(2021, 1, 1) + dt.timedelta(days=rng.randrange(120)), price(), "n")
        for _ in range(n)
    ]


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def shown(df):
    return sorted((str(r.source), str(r.grade), [str(v) for v in r._q]) for r in df.collect())


def test_bins_are_ordered_as_the_values(spark):
    rng = random.Random(3)
    numbers = [0.0, -0.0, 1e-12, 1e308, -1e308, float("inf"), -float("inf"), 5.0, 5.0000001, 31 / (1 << 20), 32 / (1 << 20), 33 / (1 << 20)]
    numbers += [rng.uniform(-1, 1) * 10 ** rng.randrange(-8, 15) for _ in range(2000)]
    numbers += [2.0**k + d for k in range(0, 40) for d in (-(2.0 ** (k - 50)), 0, 0.5)]
    rows = spark.createDataFrame([(v,) for v in numbers], "value double").select("value", quantile_store.bin_of(F.col("value")).alias("bin")).collect()
    ordered = sorted(rows, key=lambda r: r.value)
    assert all(a.bin <= b.bin for a, b in zip(ordered, ordered[1:]))
    wide = {}
    for r in rows:
        if 1 <= r.value < 1e12:
            wide.setdefault(r.bin, []).append(r.value)
    assert max(max(v) / min(v) for v in wide.values()) <= 1 + 1 / 16


SPANS = [(None, None), (dt.date(2021, 1, 20), dt.date(2021, 3, 9)), (None, dt.date(2021, 2, 1)), (dt.date(2021, 3, 1), None), (dt.date(2030, 1, 1), None)]


@pytest.mark.parametrize("grain", ["month", "day"])
def test_spans_and_changes_equal_the_rows(spark, grain):
    store = Versions(spark, scratch_path(spark, "counts"))
    rows = made(300, 1)
    steps = [rows, rows + made(40, 2), [r for r in rows if not r[2] or r[2].month != 2]]
    for step in steps if grain == "month" else steps[1:]:
        df = table(spark, step)
        assert quantile_store.refresh(df, store, grain=grain).changed
        assert quantile_store.refresh(df.withColumn("note", F.lit("other")), store, grain=grain).changed == 0
        for first, last in SPANS if step is rows and grain == "month" else SPANS[:2]:
            part = df if first is None else df.where(F.col("sale_date") >= F.lit(first))
            part = part if last is None else part.where(F.col("sale_date") <= F.lit(last))
            want = exact_quantiles(part, KEYS, "sale_price_usd", (0.0, 0.25, 0.5, 1.0))
            assert shown(quantile_store.exact(store, (0.0, 0.25, 0.5, 1.0), first, last)) == shown(want)
    clean = Versions(spark, scratch_path(spark, "counts"))
    quantile_store.refresh(df, clean, grain=grain)
    assert values(quantile_store.bounds(clean)) == values(iqr_bounds(df))


def test_only_one_bin_is_read_and_changed_periods_written(spark):
    store = Versions(spark, scratch_path(spark, "counts"))
    rows = [("a", "x", dt.date(2021, 1, 1) + dt.timedelta(days=i % 90), float(i), "n") for i in range(2000)]
    quantile_store.refresh(table(spark, rows), store)
    before = {(n, f.name): f.commit for n, t in store.manifest().tables.items() for f in t.folders}
    done = quantile_store.refresh(table(spark, [*rows, ("a", "x", dt.date(2021, 2, 3), 7.0, "n")]), store)
    after = {(n, f.name): f.commit for n, t in store.manifest().tables.items() for f in t.folders}
    changed = {k for k in before if before[k] != after[k] and k[0] != "days"}
    assert done.daily == ("2021-02-01",) and changed == {(t, "period=2021-02-01") for t in ("bins", "values", "sketches")}
    found = quantile_store.exact(store, (0.5,))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(bin), EqualTo(bin," in plan or "In(bin, [" in plan
    assert [r._q for r in found.collect()] == [[999.0]]


def test_sketches_are_close(spark):
    store = Versions(spark, scratch_path(spark, "counts"))
    rows = [("a", "x", dt.date(2021, 1, 1) + dt.timedelta(days=i % 60), float(i), "n") for i in range(5000)]
    quantile_store.refresh(table(spark, rows), store)
    [found] = quantile_store.approximate(store, (0.25, 0.75)).collect()
    assert abs(found._q[0] - 1250) < 200 and abs(found._q[1] - 3750) < 200
