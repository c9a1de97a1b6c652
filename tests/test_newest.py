"""The newest row by keyed state, under any order of arrival, restarts and expiry."""

import datetime as dt
import json
import os
import pickle
import random

import pytest
from conftest import values
from pyspark.sql import Row
from test_spread import Handle

from bindings import queries
from hammerline import session
from hammerline.operators.dedup import keep_latest
from hammerline.session import scratch_path
from hammerline.streaming import newest

SCHEMA = "record_hash string, scraped_at timestamp, price decimal(12,2), day date, note string, seen timestamp"


def lines(rows):
    names = ["record_hash", "scraped_at", "price", "day", "note", "seen"]
    return "\n".join(json.dumps(dict(zip(names, r))) for r in rows)


def stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).option("latestFirst", False).json(str(folder))


def made(rng, n):
    day = lambda: f"2024-01-{rng.randrange(1, 29):02d}"
    return [
        (
            rng.choice([None, *"abcdefgh"]),
            f"{day()}T0{rng.randrange(3)}:00:00.00{rng.randrange(3)}Z" if rng.random() < 0.95 else None,
            rng.randrange(4) / 4,
            rng.choice([None, day()]),
            rng.choice([None, "x", "é", "z"]),
            rng.choice([None, f"{day()}T00:00:00Z"]),
        )
        for _ in range(n)
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_any_order_with_a_restart_equals_the_batch(spark, tmp_path, seed):
    rng = random.Random(seed)
    folder, path, state = tmp_path / "in", scratch_path(spark, "changes"), str(tmp_path / "state")
    folder.mkdir()
    rows = made(rng, 60)
    rng.shuffle(rows)
    for run in range(2):  # the second run starts from the checkpoint of the first
        for n in range(2):
            (folder / f"{run}{n}.json").write_text(lines(rows[(2 * run + n) * 15 :][:15]))
        newest.write_newest(stream(spark, folder), path, state, ties=["price"], lateness="90 days").awaitTermination()
    assert spark.conf.get(newest.PROVIDER, None) != newest.ROCKS
    changes = spark.read.parquet(path)
    got = newest.keep_newest(changes, ties=["price"])
    whole = spark.read.schema(SCHEMA).json(str(folder)).where("scraped_at is not null")
    assert values(got) == values(keep_latest(whole, ties=["price"]))
    # Each change is newer than the one before, and only a key's first one replaces nothing.
    assert changes.where("not is_replacement").count() == got.count() < changes.count()
    last = {}
    for r in changes.orderBy("batch_id").collect():
        assert r.record_hash not in last or r.scraped_at >= last[r.record_hash]
        last[r.record_hash] = r.scraped_at
    assert last == {r.record_hash: r.scraped_at for r in got.collect()}


def test_state_expires_by_event_time(spark, tmp_path):
    folder, path, state = tmp_path / "in", scratch_path(spark, "changes"), str(tmp_path / "state")
    folder.mkdir()

    def arrive(name, key, day):
        (folder / name).write_text(lines([(key, f"{day}T00:00:00Z", 1.0, None, None, None)]))
        newest.write_newest(stream(spark, folder), path, state, lateness="5 days", retention="10 days").awaitTermination()

    for n, (key, day) in enumerate([("a", "2024-01-01"), ("a", "2024-01-02"), ("b", "2024-02-01"), ("b", "2024-02-02")]):
        arrive(f"{n}.json", key, day)
    arrive("4.json", "a", "2024-02-03")  # the state of a has gone with the watermark
    arrive("5.json", "a", "2024-01-05")  # behind the watermark
    got = [(r.record_hash, r.scraped_at.date(), r.is_replacement) for r in spark.read.parquet(path).orderBy("batch_id").collect()]
    day = dt.date
    assert got == [
        ("a", day(2024, 1, 1), False),
        ("a", day(2024, 1, 2), True),
        ("b", day(2024, 2, 1), False),
        ("b", day(2024, 2, 2), True),
        ("a", day(2024, 2, 3), False),
    ]


def test_columns_are_checked(spark, tmp_path):
    rows = spark.readStream.schema("record_hash string, scraped_at string").json(str(tmp_path))
    with pytest.raises(TypeError):
        newest.newest_changes(rows)
    rows = spark.readStream.schema("record_hash string, scraped_at timestamp, many array<int>").json(str(tmp_path))
    with pytest.raises(TypeError):
        newest.newest_changes(rows)


def test_state_is_compressed_and_few_versions_are_kept(spark):
    handle, made = Handle(), newest.Newest(["k", "at", "title"], 0, [1], 1, retention=10)
    made.init(handle)
    rows = [Row(k=f"k{i}", at=i * 1000, title=f"UFC card of the year, PSA 10, number {i}") for i in range(300)]
    assert len(list(made.handleInputRows(0, iter(rows), None))) == 300
    assert len(handle.kept[0]) < len(pickle.dumps([tuple(r) for r in rows])) / 2
    assert made._held() == {r.k: tuple(r) for r in rows}
    before = spark.conf.get(newest.RETAINED)
    with newest._started_with(spark, None):
        assert spark.conf.get(newest.RETAINED) == "2"
    assert spark.conf.get(newest.RETAINED) == before


def test_arrivals_and_state_go_with_the_stream(spark, sf, tmp_path, monkeypatch):
    session.scratch_root(spark)
    monkeypatch.setattr(session, "scratch_root", lambda spark: str(tmp_path))
    queries.QUERIES["stream_newest"](spark, sf)
    assert {n.rsplit("-", 1)[0] for n in os.listdir(tmp_path / "hammerline")} == {"newest"}
