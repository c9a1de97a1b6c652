"""Budgets, the knapsack against brute force, and the mixed corpus."""

import itertools
from collections import Counter

import numpy as np
import pytest

from hammerline.llm import mixing
from hammerline.llm.queries import QUERIES


def plain_targets(sizes):
    """The rule as it is stated: share by weight, stop at the cap, share the excess again."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    cap = {s: 2 * sizes[s] for s in sizes}
    left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while True:
        level = left / sum(weight[s] for s in open_) if open_ else 0
        full = {s for s in open_ if level * weight[s] > cap[s]}
        if not full:
            return target | {s: level * weight[s] for s in open_}
        for s in full:
            target[s] = cap[s]
            left -= cap[s]
        open_ -= full


def test_targets_and_budgets(spark, sf):
    rows = QUERIES["op8_mix_sources"](spark, sf).collect()
    docs = {r.doc_id: r for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert len(rows) == len(docs)
    sizes, taken, target = Counter(), Counter(), {}
    for r in rows:
        assert r["size"] == len(docs[r.doc_id].text.encode().split()) and r.taken in (0, r["size"], 2 * r["size"])
        source = docs[r.doc_id].source
        sizes[source] += r["size"]
        taken[source] += r.taken
        target[source] = r.target
    assert all(r.source_size == sizes[docs[r.doc_id].source] for r in rows)
    expected = plain_targets(sizes)
    for s in sizes:
        assert target[s] == pytest.approx(expected[s], rel=1e-9)
        assert abs(taken[s] - target[s]) <= max(3, target[s] / 500)  # ten documents a source
    again = {r.doc_id: r.taken for r in QUERIES["op8_mix_sources"](spark, sf).collect()}
    assert again == {r.doc_id: r.taken for r in rows}


def test_knapsack_is_the_best_sum():
    rng = np.random.default_rng(1)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 40, 4))
        counts = rng.integers(0, 4, len(lengths))
        budget = int(rng.integers(1, 120))
        sums = {sum(n * s for n, s in zip(pick, lengths)) for pick in itertools.product(*(range(c + 1) for c in counts))}
        chosen = mixing.knapsack(lengths, counts, budget)
        assert all(n <= counts[i] for i, n in chosen.items())
        assert sum(n * lengths[i] for i, n in chosen.items()) == max(s for s in sums if s <= budget)


def test_fit_is_bounded_and_near():
    rng = np.random.default_rng(2)
    for _ in range(40):
        lengths = np.unique(rng.integers(0, 3000, 300))
        counts = rng.integers(1, 50, len(lengths))
        budget = int((lengths * counts).sum() * rng.random())
        take = mixing.fit_lengths(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all() and abs(int((take * lengths).sum()) - budget) <= 2


def test_few_long_documents_are_fitted_as_a_whole():
    for scale in (1, 10, 100, 1000, 100_000):
        lengths, counts = np.array([900 * scale, 2000 * scale]), np.array([1, 1])
        assert mixing.plan_units(lengths, counts, 4000.0 * scale).tolist() == [0, 2]
    rng = np.random.default_rng(3)
    for n in (5, 12, 60, 400):
        lengths = np.unique(rng.integers(200_000, 900_000, n))
        counts = rng.integers(1, 3, len(lengths))
        target = 1.4 * int((lengths * counts).sum())
        units = mixing.plan_units(lengths, counts, target)
        assert (units <= 2 * counts).all() and (units >= 0).all()
        assert abs(int((units * lengths).sum()) - target) <= target / (100 if n < 10 else 10_000)


def test_nearest_sum_is_nearest():
    rng = np.random.default_rng(4)
    for _ in range(60):
        lengths = np.unique(rng.integers(1, 40, 4))
        counts = rng.integers(0, 4, len(lengths))
        aim = int(rng.integers(1, 120))
        sums = {sum(n * s for n, s in zip(pick, lengths)) for pick in itertools.product(*(range(c + 1) for c in counts))}
        for places in (mixing.PLACES, 16):
            chosen = mixing.nearest_sum(lengths, counts, aim, 10, places)
            assert all(0 < n <= counts[i] for i, n in chosen.items())
            got = sum(n * lengths[i] for i, n in chosen.items())
            assert got in sums and got <= aim + 10
            if places > 16:
                assert abs(got - aim) == min(abs(s - aim) for s in sums if s <= aim + 10)


def test_edges(spark, monkeypatch):
    schema = "doc_id long, text string, source string, copies int, id string"
    rows = [(1, "a b c", "s", 1, "x"), (1, "a b c", "s", 1, "x"), (2, None, None, 1, "x"), (3, "", "t", 1, "x"),
            (None, "a b", None, 1, "x"), (5, "w " * 9000, "u", 1, "x")]
    docs = spark.createDataFrame(rows, schema)
    got = mixing.mix(docs).collect()
    assert len(got) == len(rows) and all(r.taken <= 2 * r["size"] for r in got)
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0 and mixing.apply_mix(docs.limit(0)).count() == 0


def test_slices_select_as_many(spark, monkeypatch):
    monkeypatch.setattr(mixing, "SLICE", 10)
    docs = spark.range(2000).selectExpr("id as doc_id", "'a b c' as text", "if(id % 3 = 0, 'a', 'b') as source")
    for r in mixing.mix(docs).groupBy("source").agg({"taken": "sum", "target": "max"}).collect():
        assert abs(r["sum(taken)"] - r["max(target)"]) <= 3
