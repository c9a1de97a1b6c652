"""Periodic runs against a plain search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from hammerline.llm import periodic_runs
from hammerline.llm.queries import QUERIES

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def plain_words(doc_id, text):
    words = WORDS.findall(text or "")
    n, h = len(words), zlib.crc32(str(doc_id).encode())
    g = h // 10
    if doc_id is not None and h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
    return words


def plain_runs(words, longest=None):
    """Maximal stretches of every period q; those that a smaller period has as well are left out."""
    n, out = len(words), []
    for q in range(1, min(longest or n, n // 4) + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(6, 4 * q) and not any(
                all(words[k] == words[k + s] for k in range(i, i + length - s)) for s in range(1, q)
            ):
                out.append((i, length, q))
            i = max(i + 1, j)
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(words, longest=None):
    runs = plain_runs(words, longest)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    listing = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for k, w in enumerate(words) if k not in dropped)
    milli = None if best[0] is None else 1000 * best[1] // best[2]
    return (len(runs), *best, milli, *(hashlib.sha256(x.encode()).hexdigest() for x in (listing, kept)))


def digest(rows):
    return [
        (r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) for r in rows
    ]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=80), min_size=1, max_size=4))
def test_runs_of_dense_texts(texts):
    counts = [len(t) for t in texts]
    words = np.array([k * 3 + w for k, t in enumerate(texts) for w in t], dtype=np.int64)
    begins = np.cumsum(counts) - counts
    ends = np.repeat(np.array(begins) + counts, counts)
    want = [(int(b) + s, n, q) for b, t in zip(begins, texts) for s, n, q in plain_runs(t)]
    assert [tuple(r) for r in periodic_runs.runs_of(words, ends).tolist()] == want


def test_nested_and_overlapping_periods():
    inner = ["a"] * 7 + ["b"]
    for text in (inner * 5, inner * 9 + ["c"] * 8, (["x", "y"] * 4 + ["z"]) * 6, list("abcabcabcabcab" * 3), ["w"] * 33):
        found = {w: i for i, w in enumerate(dict.fromkeys(text))}
        got = periodic_runs.runs_of(np.array([found[w] for w in text]), np.full(len(text), len(text)))
        assert [tuple(r) for r in got.tolist()] == plain_runs(text)


def test_query_matches_plain_search(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = QUERIES["op11_periodic_runs"](spark, sf).collect()
    assert len(rows) == len(texts)
    short = [r for r in rows if r.n_words <= 1200]
    assert len(short) > 900 and sum(r.n_runs > 0 for r in short) > 40
    assert digest(short) == [plain_row(plain_words(r.doc_id, texts[r.doc_id])) for r in short]


def test_cases(spark, monkeypatch):
    rng = random.Random(5)
    long = [rng.choice("abc") for _ in range(1000)] + ["period", "of", "three"] * 3000
    cases = {
        1: None,
        2: "",
        3: " \t\n\x0b\x0c\r ",
        4: "one two three",
        5: "a b " * 3,
        6: "é x 😀 " * 4,
        7: "x x x x x",
        8: " ".join(long),
        9: "go on " * 12 + "stop " * 6,
    }
    plain = " ".join(f"w{i}" for i in range(50))
    edited = next(i for i in range(100, 1000) if plain_runs(plain_words(i, plain)))
    cases[edited] = plain
    rows = [(i, t, "s", 1) for i, t in cases.items()] + [(5, cases[5], "s", 1), (None, plain, "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, runs string, id int")
    for lot in (periodic_runs.LOT_BYTES, 40):
        monkeypatch.setattr(periodic_runs, "LOT_BYTES", lot)
        got = periodic_runs.summary(periodic_runs.planted(docs)).collect()
        assert len(got) == len(rows)
        for r in got:
            words = plain_words(r.doc_id, (cases | {None: plain})[r.doc_id])
            assert r.n_words == len(words)
            assert digest([r]) == [plain_row(words, 20)]
        assert next(r.n_runs for r in got if r.doc_id == edited) == 1
    assert periodic_runs.summary(docs.limit(0)).count() == 0
    kept = periodic_runs.find_runs(docs.where("doc_id = 9")).first()
    assert kept.collapsed == "go on stop" and [tuple(r) for r in kept.runs] == [(0, 24, 2), (24, 6, 1)]
