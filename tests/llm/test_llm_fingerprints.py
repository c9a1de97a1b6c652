"""Fingerprints, successors and radius search against plain Python."""

import hashlib

import numpy as np
import pytest
import xxhash

from hammerline.llm import fingerprints as fps
from hammerline.llm.queries import QUERIES


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def pair_hash(words):
    seed = 42
    for w in words:
        seed = xxhash.xxh64_intdigest(w, seed)
    return seed


def plain_print(text):
    words = text.encode().split()
    groups = [words[i : i + 2] for i in range(len(words) - 1)] or [[w] for w in words]
    votes = [0] * 64
    for g in groups:
        weight, h = min(24, sum(len(w.decode()) for w in g)), pair_hash(g)
        for b in range(64):
            votes[b] += weight if h >> b & 1 else -weight
    return sum(1 << b for b in range(64) if votes[b] > 0)


def plain_rows(texts):
    ids = sorted(texts)
    out = {}
    for i, following in zip(ids, ids[1:] + ids[:1]):
        text, after = texts[i] or "", texts[following] or ""
        gone = len(text) // 4
        edited = text[: len(text) - gone] + after[:gone]
        a, b, c = plain_print(text), plain_print(edited), plain_print(after)
        out[i] = (len(text), hashlib.sha256(edited.encode()).hexdigest(), f"{a:016x}", f"{b:016x}",
                  1 - (a ^ b).bit_count() / 64, 1 - (a ^ c).bit_count() / 64)
    return out


@pytest.mark.parametrize("size", [8 << 20, 20_000])
def test_query_matches_plain_python(spark, sf, monkeypatch, size):
    monkeypatch.setattr(fps, "RANGE_BYTES", size)  # one range, and many
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    result = QUERIES["op5_document_fingerprints"](spark, sf)
    rows = result.collect()
    expected = plain_rows(texts)
    assert {r.doc_id: tuple(r)[1:7] for r in rows} == expected
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))
    values = {int(v[2], 16) for v in expected.values()}
    for r in rows:
        own = int(r.fingerprint, 16)
        near = sum((own ^ v).bit_count() <= 3 for v in values) - 1
        assert r.near_prints == (near if r.doc_id % 20 == 0 else None)
    edited, other = np.array([r.near_edited for r in rows]), np.array([r.near_next for r in rows])
    assert edited.mean() > other.mean() + 0.15


@pytest.mark.parametrize("borders", [[], [5], [-3, 0, 9], list(range(-40, 400, 7))])
def test_places_among_borders(spark, borders):
    values = [None, *range(-60, 420)]
    rows = spark.createDataFrame([(v,) for v in values], "v long")
    placed = rows.select("v", fps.place_among(rows.v, borders).alias("at"))
    assert {r.v: r["at"] for r in placed.collect()} == {v: 0 if v is None else sum(b <= v for b in borders) for v in values}
    assert "split(" not in placed._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("radius, blocks", [(3, 6), (2, 4), (1, 2)])
def test_radius_search_is_exact(spark, radius, blocks):
    rng = np.random.default_rng(5)
    centres = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.uint64(sum(1 << int(b) for b in rng.choice(64, k, replace=False))) for k in (1, 2, 3, 4) for _ in range(12)]
    points = np.unique(np.concatenate([centres, *(centres ^ f for f in flips)]))
    rows = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    asked = rows.where("fp % 7 = 0")
    got = {(r.q, r.fp) for r in fps.within_radius(asked, rows, radius, blocks).collect()}
    values = points.view(np.int64).tolist()
    want = {(q, v) for q in values if q % 7 == 0 or -q % 7 == 0 for v in values if ((q ^ v) & (1 << 64) - 1).bit_count() <= radius}
    assert got == want and len(got) > len(points) / 7


def test_edges(spark):
    rows = [(1, None, 0), (2, "", 0), (2, "", 0), (None, "one", 0), (5, "É😀b c " * 30_000, 0), (20, "Same Words", 0), (40, "Same Words", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, range int")
    got = fps.summary(docs).collect()
    by_id = {r.doc_id: r for r in got}
    assert len(got) == len(rows)
    zero = "0" * 16
    assert by_id[1].fingerprint == by_id[2].fingerprint == zero and by_id[None].n_chars == 3
    assert by_id[20].fingerprint == by_id[40].fingerprint == f"{plain_print('Same Words'):016x}"
    assert by_id[20].near_next == 1.0 and by_id[20].near_prints == 0 and by_id[5].near_prints is None
    assert by_id[40].near_next == fps_likeness("Same Words", "one")
    alone = fps.summary(docs.where("doc_id = 5")).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0
    assert fps.summary(docs.limit(0)).count() == 0


def fps_likeness(a, b):
    return 1 - (plain_print(a) ^ plain_print(b)).bit_count() / 64
