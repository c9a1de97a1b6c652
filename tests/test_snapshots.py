"""Merged snapshots equal those that compare every key, and leave unchanged buckets alone."""

import random

import pytest
from conftest import values
from pyspark.sql import functions as F

from hammerline.operators import scd, snapshots
from hammerline.session import materialise, scratch_path
from hammerline.sources.versions import Versions

SCHEMA = "fighter_id string, grade_id int, vwap_30d double, vwap_7d double, sale_count_30d long, note string"


def state(spark, rows):
    return spark.createDataFrame([(*k, *v) for k, v in rows.items()] + [(None, 1, 1.0, 1.0, 1, "no key")], SCHEMA)


def day(n):
    return F.lit(f"2024-01-{n:02d}").cast("timestamp")


@pytest.mark.parametrize("deletes", [True, False])
def test_any_sequence_equals_comparing_all(spark, deletes):
    rng = random.Random(4)
    value = lambda: (rng.choice([None, 1.0, 2.0]), 3.0, rng.choice([1, 2]), rng.choice("ab"))
    rows = {(f"f{i}", i % 3): value() for i in range(40)}
    store, want = Versions(spark, scratch_path(spark, "snapshot")), None
    for n in range(1, 6 if deletes else 4):
        df = state(spark, rows)
        snapshots.merge_snapshot(store, df, day(n), invalidate_hard_deletes=deletes, buckets=8)
        if want is None:
            want = scd.first_snapshot(df, day(n))
        else:
            want = scd.apply_snapshot(want, df, day(n), invalidate_hard_deletes=deletes)
        want = materialise(want)
        columns = [c for c in want.columns if c != "note"]  # an unchecked column stays as it was
        assert values(snapshots.history(store).select(columns)) == values(want.select(columns))
        for key in rng.sample(sorted(rows), 3):
            rows.pop(key)
        rows |= {(f"n{n}", 1): value()} | {k: value() for k in rng.sample(sorted(rows), 2)}


def test_unchanged_buckets_keep_their_files(spark):
    rows = {(f"f{i}", 1): (1.0, 2.0, 3, "a") for i in range(200)}
    store = Versions(spark, scratch_path(spark, "snapshot"))
    first = snapshots.merge_snapshot(store, state(spark, rows), day(1), buckets=16)
    assert len(first.buckets) == 16
    assert snapshots.merge_snapshot(store, state(spark, rows), day(2)).buckets == () and store.versions() == [1]
    before = {f.name: f.commit for f in store.manifest().tables["open"].folders}
    rows["f5", 1] = (9.0, 2.0, 3, "a")
    done = snapshots.merge_snapshot(store, state(spark, rows), day(3))
    after = {f.name: f.commit for f in store.manifest().tables["open"].folders}
    assert len(done.buckets) == 1 and sum(before[n] != after[n] for n in before) == 1
    found = snapshots.history(store).where("fighter_id = 'f5'").orderBy("dbt_valid_from").collect()
    assert [(r.vwap_30d, r.dbt_valid_to is None) for r in found] == [(1.0, False), (9.0, True)]


def test_wrong_input_changes_nothing(spark):
    rows = {("a", 1): (1.0, 2.0, 3, "a")}
    store = Versions(spark, scratch_path(spark, "snapshot"))
    snapshots.merge_snapshot(store, state(spark, rows), day(1))
    twice = state(spark, rows).unionByName(state(spark, rows))
    with pytest.raises(ValueError):
        snapshots.merge_snapshot(store, twice, day(2))
    with pytest.raises(ValueError):
        snapshots.merge_snapshot(store, state(spark, rows | {("b", 1): (1.0, 2.0, 3, "a")}).drop("note"), day(2))
    assert store.versions() == [1] and snapshots.history(store).count() == 1
