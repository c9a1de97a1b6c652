"""Appending to compacted folders: exact, bounded in files, and seen whole."""

import datetime as dt
import random
import threading

import pytest
from conftest import values

from hammerline.session import scratch_path
from hammerline.sources.versions import Conflict, Folder, Versions
from hammerline.streaming import compact
from hammerline.streaming.ingest import stream_raw


def batch(spark, keys, day=1):
    rows = [(k, dt.datetime(2024, 1, day, 0, n % 60), n) for n, k in enumerate(keys)]
    return spark.createDataFrame(rows, "record_hash string, scraped_at timestamp, n int")


def test_many_batches_keep_few_folders(spark):
    path, rng, seen = scratch_path(spark, "append"), random.Random(1), {}
    write = compact.appender(spark, path, buckets=2, fanout=3, versions_kept=4)
    most = 0
    for b in range(14):
        keys = [None if rng.random() < 0.05 else f"any key / {rng.randrange(70)}" for _ in range(12)]
        write(batch(spark, keys), b)
        for n, k in enumerate(keys):
            if k is not None and k not in seen or (k in seen and seen[k][0] == b and seen[k][1] < n % 60):
                seen[k] = (b, n)
        most = max(most, len(Versions(spark, path).manifest().tables["rows"].folders))
    assert most <= 2 * 3  # two hashes, one size, fewer than the fanout besides those just merged
    got = {r.record_hash: r.n for r in compact.read_appended(spark, path).collect()}
    assert got == {k: n for k, (_, n) in seen.items()} and len(got) == compact.read_appended(spark, path).count()
    store = Versions(spark, path)
    assert len(store.versions()) <= 8
    store.vacuum(1)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(f"{path}/data")
    assert files.count() <= most and compact.read_appended(spark, path).count() == len(got)


def test_repeated_batch_changes_nothing(spark):
    path = scratch_path(spark, "append")
    write = compact.appender(spark, path)
    write(batch(spark, ["a", "b", "b"]), 0)
    before = values(compact.read_appended(spark, path))
    write(batch(spark, ["a", "c"]), 0)  # tried again after its commit
    assert values(compact.read_appended(spark, path)) == before and Versions(spark, path).versions() == [1]
    other = compact.appender(spark, path, name="other")
    other(batch(spark, ["c", "a"], 2), 0)
    assert [r.record_hash for r in compact.read_appended(spark, path).orderBy("record_hash").collect()] == ["a", "b", "c"]
    assert Versions(spark, path).manifest().notes == {"batches": {"stream": 0, "other": 0}}


def test_stream_with_restarts(spark, tmp_path):
    path, state, raw = scratch_path(spark, "append"), str(tmp_path / "state"), tmp_path / "raw"
    for n, hashes in enumerate((["a", "b"], ["b", "c"], ["c", "d", "d"])):
        folder = raw / "source=ebay"
        folder.mkdir(parents=True, exist_ok=True)
        lines = [f'{{"record_hash": "{h}", "listing_id": "{n}", "scraped_at": "2024-01-0{n + 1}T00:00:00Z"}}' for h in hashes]
        (folder / f"{n}.json").write_text("\n".join(lines))
        query = compact.append_compacted(stream_raw(spark, str(raw)), path, state, fanout=2)
        query.awaitTermination()
    got = {(r.record_hash, r.listing_id) for r in compact.read_appended(spark, path).collect()}
    assert got == {("a", "0"), ("b", "0"), ("c", "1"), ("d", "2")}


def test_readers_see_batches_and_merges_whole(spark):
    path = scratch_path(spark, "append")
    write = compact.appender(spark, path, buckets=2, fanout=100)
    for b in range(4):
        write(batch(spark, [f"{b}-{i}" for i in range(10)]), b)
    counts, failures, over = [], [], threading.Event()

    def read():
        try:
            while not over.is_set():
                counts.append(compact.read_appended(spark, path).count())
        except Exception as failure:  # noqa: BLE001
            failures.append(failure)

    thread = threading.Thread(target=read)
    thread.start()
    opened = compact.read_appended(spark, path)
    assert compact.compact(spark, path, fanout=2) == 8 and compact.compact(spark, path, fanout=2) == 0
    write(batch(spark, [f"9-{i}" for i in range(10)]), 9)
    over.set()
    thread.join()
    assert not failures and set(counts) <= {40, 50} and opened.count() == 40
    assert compact.read_appended(spark, path).count() == 50


def test_a_lost_race_is_run_again(spark, monkeypatch):
    path = scratch_path(spark, "append")
    write = compact.appender(spark, path, buckets=1)
    write(batch(spark, ["a"]), 0)
    publish, lost = Versions.publish, []

    def raced(self, manifest):
        if not lost:
            lost.append(1)
            compact.appender(spark, path, name="other", buckets=1)(batch(spark, ["b"], 2), 0)
        return publish(self, manifest)

    monkeypatch.setattr(Versions, "publish", raced)
    write(batch(spark, ["a", "b", "c"], 3), 1)
    got = sorted((r.record_hash, r.scraped_at.day) for r in compact.read_appended(spark, path).collect())
    assert got == [("a", 1), ("b", 2), ("c", 3)]
    monkeypatch.setattr(Versions, "publish", lambda self, manifest: (_ for _ in ()).throw(Conflict("always")))
    with pytest.raises(Conflict):
        write(batch(spark, ["d"]), 2)


def test_folders_of_like_size_are_merged():
    sizes = [10, 20, 30, 5 << 20, 6 << 20, 90 << 20]
    folders = [Folder(str(n), "bucket=0", 1, size) for n, size in enumerate(sizes)] + [Folder("x", "bucket=1", 1, 10)]
    assert [f.commit for f in compact.to_merge(folders, 3)] == ["0", "1", "2"]
    assert [f.commit for f in compact.to_merge(folders, 2)] == ["0", "1", "2", "3", "4"]
