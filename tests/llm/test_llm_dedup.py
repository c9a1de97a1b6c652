"""Exact and near duplicates against brute force, and the defined edge cases."""

import numpy as np
import pytest
import xxhash
from compare import compare, oracle_connection
from pyspark.sql import functions as F

from hammerline.llm import exact_dedup, simhash_vp
from hammerline.llm.queries import ORACLES, QUERIES

EDGES = "doc_id long, text string, source string, digest string, maybe boolean, fp long"


def edge_docs(spark):
    long_text = "word " * 60_000
    rows = [
        (1, None), (2, ""), (3, "Same Text"), (4, "same text"), (4, "same text"), (None, "SAME TEXT"), (7, "one"),
        (8, long_text), (9, long_text.upper()), (10, "É a"), (11, "é A"), (12, " \t "), (13, "\x85 x"),
    ]
    return spark.createDataFrame([(i, t, None, "x", True, 5) for i, t in rows], EDGES)


def test_exact_matches_sql(spark, sf):
    name = "op10_exact_dedup"
    result = QUERIES[name](spark, sf)
    problems, n = compare(result, oracle_connection(sf), ORACLES[name])
    assert not problems and n > 0
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


@pytest.mark.parametrize("bits", [1 << 15, 1 << 18])
def test_filter_never_loses_a_repeat(spark, bits):
    rows = spark.range(4000).select((F.col("id") % 3500).cast("string").alias("h"))
    pages = exact_dedup.repeated_pages(rows, "h", bits)
    probed = exact_dedup.probe(rows, pages, "h", bits).groupBy("h").agg(F.count("*").alias("n"), F.min("maybe").alias("m"))
    assert probed.where("n > 1 and not m").isEmpty()
    assert probed.where("n = 1 and m").count() < (3000 if bits == 1 << 15 else 100)


def test_exact_edges(spark):
    got = {}
    for r in exact_dedup.decide(edge_docs(spark)).collect():
        got.setdefault(r.doc_id, []).append((r.keep_id, r.group_size, r.kept))
    assert got[1] == [(2, 2, False)] and got[2] == [(2, 2, True)]
    assert got[3] == [(4, 4, False)] and got[None] == [(4, 4, False)]
    assert sorted(got[4]) == [(4, 4, False), (4, 4, True)]
    assert got[8] == [(9, 2, False)] and got[10] == [(10, 1, True)] and got[11] == [(11, 1, True)]
    kept = exact_dedup.keep_first(edge_docs(spark))
    assert kept.columns == edge_docs(spark).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 7, 9, 10, 11, 12, 13]
    empty = edge_docs(spark).limit(0)
    assert exact_dedup.decide(empty).count() == 0 and exact_dedup.keep_first(empty).count() == 0


def plain_fingerprint(text, k=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, prints, distance):
    root = {p: p for p in prints}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    distinct = sorted(root)
    a = np.array(distinct, dtype=np.uint64)
    for i, p in enumerate(distinct):
        for j in np.flatnonzero(np.bitwise_count(a[:i] ^ a[i]) <= distance):
            x, y = find(p), find(distinct[j])
            root[max(x, y)] = min(x, y)
    least = {}
    for i, p in zip(ids, prints):
        r = find(p)
        least[r] = min(i, least.get(r, i))
    return {i: least[find(p)] for i, p in zip(ids, prints)}


def test_near_matches_brute_force(spark, sf):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    prints = [plain_fingerprint(t) for t in docs.values()]
    expected = plain_components(list(docs), prints, 2)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op1_simhash_near_dedup"](spark, sf).collect()}
    assert got == {i: (f"{p:016x}", expected[i]) for i, p in zip(docs, prints)}
    assert any(i != c for i, (_, c) in got.items())


@pytest.mark.parametrize("owned, leaf", [(60, 4), (500, 48), (10_000, 3000)])
def test_tree_keeps_every_component(spark, owned, leaf):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    points = np.unique(np.concatenate([centres, *(centres[:60] ^ np.uint64(1 << int(b)) for b in rng.integers(0, 64, 25))]))
    rows = spark.createDataFrame([(int(x),) for x in points.view(np.int64)], "fp long")
    links = simhash_vp.link_fingerprints(rows.repartition(4), 2, owned=owned)
    from hammerline.llm.components import components

    roots = {r.node: r.root for r in components(links).collect()}
    expected = plain_components([int(p) for p in points.view(np.int64)], [int(p) for p in points], 2)
    got = {int(p): roots.get(int(p), int(p)) for p in points.view(np.int64)}
    assert len(set(expected.values())) == len(set(got.values()))
    assert all((expected[a] == expected[b]) == (got[a] == got[b]) for a, b in zip(expected, list(expected)[1:]))
    own = np.ones(len(points), dtype=bool)
    assert len(simhash_vp.link_shard(points, own, 2, leaf)) == len(points) - len(set(expected.values()))


def test_near_edges(spark):
    docs = edge_docs(spark)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_vp.near_components(docs).collect()}
    zero = "0" * 16
    assert got[1] == got[2] == got[12] == (zero, 1)
    assert got[4] == got[None] == got[3] and got[3][1] == 3 and got[8] == got[9] and got[8][1] == 8
    assert simhash_vp.near_components(docs.limit(0)).count() == 0
    kept = simhash_vp.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 3, 7, 8, 10, 11, 13]


def test_chains_and_hubs(spark):
    from hammerline.llm.components import components

    edges = [(i, i + 1) for i in range(200)] + [(1000, 1000 + i) for i in range(1, 300)] + [(5000, 5000)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(roots[i] == 0 for i in range(1, 201)) and all(roots[1000 + i] == 1000 for i in range(1, 300))
