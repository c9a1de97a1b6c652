"""License spans against a plain reading of words, diagonal by diagonal."""

import re
from collections import defaultdict

import pytest

from hammerline.llm import licenses
from hammerline.llm.license_texts import BASE, NAMES, NOTICES
from hammerline.llm.queries import QUERIES

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {ord(c): c.lower() for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ"}


def words_of(text):
    return WORD.findall((text or "").translate(UPPER))


TEMPLATES = [(label, words_of(text), n < len(BASE)) for n, (label, text) in enumerate((*BASE, *NAMES, *NOTICES))]


def plain_spans(words):
    out = []
    for label, own, base in TEMPLATES:
        m, places = len(own), [i for i in range(len(words)) if words[i] in own]
        if base or m < licenses.LONG:
            out += [(i, m, label, base, 1.0, True) for i in range(len(words)) if words[i : i + m] == own]
            continue
        at = defaultdict(set)
        for i in places:
            for j in range(m - licenses.LONG_GRAM + 1):
                if words[i : i + licenses.LONG_GRAM] == own[j : j + licenses.LONG_GRAM]:
                    at[i - j].add(j)
        merged = []
        for d in sorted(d for d, js in at.items() if len(js) >= licenses.LEAST_VOTES):
            if merged and d - merged[-1][-1] <= licenses.SHIFT:
                merged[-1].append(d)
            else:
                merged.append([d])
        for ds in merged:
            start = min(d + min(at[d]) for d in ds)
            end = max(d + max(at[d]) for d in ds) + licenses.LONG_GRAM
            stands = [j for j in range(m) if any(start <= d + j < end and words[d + j] == own[j] for d in ds)]
            out.append((start, end - start, label, base, len(stands) / m, False))
    return sorted(out)


def plain_row(text):
    words = words_of(text)
    spans = plain_spans(words)
    base = [s for s in spans if s[3]]
    good = [s for s in spans if s[4] >= (1 if s[5] else licenses.LEAST_SHARE)]
    names = [",".join(sorted({s[2] for s in some})) for some in (base, good)]
    first, last = (min(s[0] for s in base), max(s[0] for s in base)) if base else (None, None)
    return len(words), len(base), first, last, *names, max((s[4] for s in spans), default=0.0)


def rows_of(df):
    return [(r.doc_id, tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))) for r in df.collect()]


def test_query_matches_plain_reading_natively(spark, monkeypatch):
    plans = []
    once = licenses.write_table

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return once(df, name)

    monkeypatch.setattr(licenses, "write_table", watched)
    sf = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    result = QUERIES["op13_license_scan"](spark, sf)
    got = rows_of(result)
    assert len(got) == len(texts) and sum(row[1] for _, row in got) > 10
    for i, row in got:
        assert row == plain_row(texts[i])
    for text in [*plans, result._jdf.queryExecution().executedPlan().toString()]:
        assert not any(x in text for x in ("Python", "Pandas", "Arrow", "Cartesian", "NestedLoop"))


NOTICE = dict(NOTICES)
CASES = {
    1: None,
    2: "",
    3: "The MIT-License, the mit license; MIT licenses and 'MIT  (License)'",
    4: "gnu general public license, General Public\nLicense public license general public license",
    5: NOTICE["mit"],
    6: NOTICE["apache"].replace("applicable", "the most applicable and binding"),
    7: "start " + " ".join(NOTICE["bsd"].split()[:20]),
    8: NOTICE["isc"].replace("fee", "any fee").replace("granted", "now granted") + " text " * 500 + NOTICE["isc"],
    9: "ÉCOLE mit license école 😀 apache license",
    10: "mit license " * 2000,
    11: "words " * 100_000 + "apache license",
    12: "permission is hereby denied to any person",
    13: "Licensed under CC BY-NC 4.0, or the BSD license.",
}


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string, words string, key int, spans int, template int")


def test_cases(spark):
    rows = [(i, t, "s", 1, 2, 3) for i, t in CASES.items()] + [(5, CASES[5], "s", 1, 2, 3), (None, CASES[3], "s", 1, 2, 3)]
    got = rows_of(licenses.summary(table(spark, rows)))
    assert len(got) == len(rows)
    for i, row in got:
        assert row == plain_row((CASES | {None: CASES[3]})[i]), i
    labels = {i: row[5] for i, row in got}
    assert labels[3] == labels[5] == "mit" and labels[6] == "apache" and labels[8] == "isc"
    assert labels[7] == labels[12] == "" and labels[13] == "bsd,cc-by-nc" and labels[4] == "gpl"
    assert dict(got)[10][1] == 2000 and dict(got)[11][2] == 100_000 and 0 < dict(got)[7][6] < 0.8
    assert licenses.summary(table(spark, rows).limit(0)).count() == 0


def test_copies_apart_are_spans_of_their_own(spark):
    spans = licenses.find_licenses(table(spark, [(8, CASES[8], "", 0, 0, 0)])).first().spans
    assert [(s.start, s.share) for s in spans if s.share > 0.8] == [(s[0], s[4]) for s in plain_spans(words_of(CASES[8])) if s[4] > 0.8]
    assert len([s for s in spans if s.label == "isc" and s.share > 0.8]) == 2


def test_templates_are_bounded(spark):
    with pytest.raises(ValueError):
        licenses.find_licenses(table(spark, []), base=[("one", "word")])
    with pytest.raises(ValueError):
        licenses.find_licenses(table(spark, []), others=[("many", "some words " * licenses.MOST_WORDS)])
