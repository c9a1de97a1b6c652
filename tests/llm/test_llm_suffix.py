"""Repeated passages against a table of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from hammerline.llm import suffix_dedup
from hammerline.llm.queries import QUERIES


def plain(texts, least):
    """{id: (n_bytes, n_removed, n_spans, kept_sha256)} by counting every window."""
    seen = Counter()
    for t in texts.values():
        for s in range(len(t) - least + 1):
            seen[t[s : s + least]] += 1
    out = {}
    for i, t in texts.items():
        gone = np.zeros(len(t) + 2, dtype=bool)
        for s in range(len(t) - least + 1):
            if seen[t[s : s + least]] > 1:
                gone[s + 1 : s + least + 1] = True
        kept = bytes(b for b, g in zip(t, gone[1:]) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum())
        out[i] = (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def test_multikey_sort():
    rng = random.Random(1)
    for _ in range(200):
        strings = ["".join(rng.choice("ab\0") for _ in range(rng.randint(0, 30))).encode() for _ in range(rng.randint(1, 30))]
        order, common = suffix_dedup.multikey_sort(strings)
        ranked = [strings[i] for i in order]
        assert ranked == sorted(strings)
        assert common.tolist() == [0, *(suffix_dedup.common_length(a, b) for a, b in zip(ranked, ranked[1:]))]


def crossing_texts(seed, n=160):
    """Texts made of pieces that others share in different surroundings."""
    rng = random.Random(seed)
    letters = "ab" if seed % 2 else "abcdefgh "
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [word(rng.randint(20, 120)) for _ in range(12)]
    texts = {}
    for i in range(n):
        kind = rng.random()
        if kind < 0.1 and texts:
            texts[i] = texts[rng.choice(list(texts))]
        elif kind < 0.2:
            texts[i] = word(rng.randint(1, 9)) * rng.randint(1, 30)
        elif kind < 0.35 and texts:
            old = texts[rng.choice(list(texts))]
            at = rng.randint(0, len(old))
            texts[i] = old[:at] + word(1) + old[at:]
        else:
            texts[i] = "".join(rng.choice([word(rng.randint(0, 60)), rng.choice(shared)]) for _ in range(rng.randint(0, 6)))
    return texts


@pytest.mark.parametrize(
    "seed, least, lead, bucket, hot",
    [(1, 30, 8, 1 << 20, 9), (2, 30, 8, 1500, 0), (3, 24, 24, 800, 0), (4, 40, 1, 3000, 6), (5, 30, 12, 600, 0), (6, 30, 12, 600, 99)],
)
def test_small_alphabets(spark, monkeypatch, seed, least, lead, bucket, hot):
    monkeypatch.setattr(suffix_dedup, "BUCKET_BYTES", bucket)
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    texts = crossing_texts(seed)
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(5)
    got = {r.doc_id: tuple(r)[1:] for r in suffix_dedup.summary(docs, least=least, lead=lead).collect()}
    want = plain({i: t.encode() for i, t in texts.items()}, least)
    assert got == want and sum(r[1] for r in want.values()) > 1000


def test_long_texts_in_parts(spark, monkeypatch):
    rng = random.Random(9)
    long_text = "".join(rng.choice("abcdefgh") for _ in range(9000))
    scanner = suffix_dedup.Scanner(50, 10, lot=700)
    covered = []
    for _, lo, hi, off, _, _ in scanner.scan([memoryview(t) for t in (b"", long_text.encode(), b"x" * 60)]):
        covered += [(a, b) for a, b in zip(lo.tolist(), hi.tolist())]
        assert (off >= 0).all() and (off <= hi - lo + 40).all()
    assert sum(b - a + 1 for a, b in covered) == 9000 - 49 + 11


def test_query_matches_window_table(spark):
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: (r.text or "").encode() for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op2_suffix_dedup"](spark, sf).collect()}
    hashed = {}
    seen = Counter()
    for i, t in texts.items():
        hashed[i] = [hash(t[s : s + 400]) for s in range(len(t) - 399)]
        seen.update(hashed[i])
    for i, t in texts.items():
        gone = np.zeros(len(t) + 1, dtype=np.int64)
        for s in (s for s, h in enumerate(hashed[i]) if seen[h] > 1):
            gone[s] += 1
            gone[s + 400 if s + 400 < len(gone) else -1] -= 1
        gone = np.cumsum(gone)[: len(t)] > 0
        kept = np.frombuffer(t, np.uint8)[~gone].tobytes()
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum())
        assert got[i] == (len(t), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())


def test_edges(spark):
    long_text = "é" * 300 + "x" + "q" * 90_000
    rows = [(1, None), (2, ""), (3, "short"), (3, "short"), (None, "y" * 399), (5, "z" * 401), (6, long_text), (7, long_text), (8, "w" * 400)]
    docs = spark.createDataFrame([(i, t, "d", 1) for i, t in rows], "doc_id long, text string, digest string, lo int")
    got = {r.doc_id: r for r in suffix_dedup.summary(docs).collect()}
    assert suffix_dedup.summary(docs).count() == len(rows)
    assert got[1].n_bytes == 0 and got[3].n_removed == 0 and got[None].n_removed == 0 and got[8].n_removed == 0
    assert (got[5].n_removed, got[5].n_spans) == (401, 1)
    assert got[6].n_removed == got[6].n_bytes == 90_601 and got[6].kept_sha256 == hashlib.sha256(b"").hexdigest()
    assert suffix_dedup.summary(docs.limit(0)).count() == 0
