"""Held-out accuracy, the grammar's arcs, and the defined edge cases."""

import zlib

import pytest
from pyspark.sql import functions as F

from hammerline.llm import toxicity
from hammerline.llm.queries import QUERIES


@pytest.fixture(scope="module")
def sf01():
    return "/root/testdata/sf0.01"


def test_held_out_accuracy(spark, sf01):
    rows = QUERIES["op6_toxicity_grammar"](spark, sf01).collect()
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf01}/labels.parquet").collect()}
    assert len(rows) == 1000
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    held = [r for r in rows if r.held_out and r.doc_id in labels]
    right = sum(r.predicted == labels[r.doc_id] for r in held)
    assert right / len(held) > 0.93


def test_grammar_arcs():
    scorer = toxicity.Scorer({"idiot$": 4.0, "scum$": 2.0, "vequ": 3.0})
    score = lambda text: scorer.clauses(text)[0]
    assert score("What an idiot, really.") == [4.0]
    assert score("You idiot.") == [pytest.approx(4 * toxicity.TARGETED)]
    assert score("An idiot are you.") == score("You idiot.")
    assert score("This is not an idiot.") == [pytest.approx(4 * toxicity.NEGATED)]
    assert score("He said idiot") == [pytest.approx(4 * toxicity.TARGETED * toxicity.REPORTED)]
    assert score("It is not here in the big house idiot") == [4.0]
    assert score("Not now. Idiot!") == [4.0]
    assert score("idiot scum; vequança") == [6.0, 3.0]
    assert score("idiots and equ") == [] and score("") == []
    assert score("They kill") == [pytest.approx(toxicity.THREAT_WEIGHT * toxicity.TARGETED)]


def test_composition_multiplies_factors():
    machine = toxicity.compose(toxicity.holds(toxicity.NEGATION, 2, 0.5), toxicity.holds(toxicity.TARGET, 0, 2.0))
    state = 0
    seen = []
    for symbol in (toxicity.TARGET, toxicity.NEGATION, toxicity.OTHER, toxicity.OTHER, toxicity.END):
        state = machine.step[state][symbol]
        seen.append(machine.factor[state])
    assert seen == [2.0, 1.0, 1.0, 2.0, 1.0]


def test_edges(spark):
    schema = "doc_id long, text string, score double, toxic int, held_out int"
    rows = [(i, f"you idiot scum {i}" if i % 2 else f"a fine day {i}", 0.0, 0, 0) for i in range(60)]
    rows += [(100, None, 0.0, 0, 0), (None, "idiot", 0.0, 0, 0), (101, "", 0.0, 0, 0), (101, "", 0.0, 0, 0),
             (102, "calm " * 80_000, 0.0, 0, 0)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 0), (None, 1), (7, None)], "doc_id long, toxic int")
    model = toxicity.train(docs, labels)
    got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert got[1].predicted == 1 and got[2].predicted == 0 and got[None].held_out is False
    assert got[100].score == got[101].score < 0.5 and got[102].predicted == 0
    kept = toxicity.keep_clean(docs, model)
    assert kept.columns == docs.columns and kept.where("doc_id % 2 = 1 and doc_id < 60").isEmpty()
    assert kept.where("doc_id = 101").count() == 2
    unlabelled = toxicity.train(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, unlabelled).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0
    one_kind = toxicity.train(docs, labels.where("toxic = 1"))
    assert toxicity.score(docs, one_kind).agg(F.min("score")).first()[0] == 1.0
    with pytest.warns(UserWarning, match="no toxicity model"):
        assert toxicity.keep_clean(docs, one_kind).count() == docs.count()


@pytest.mark.parametrize("kinds", [[1] * 5, [1, 0, 1], [0, 0, 0], []])
def test_few_labels_never_drop_a_corpus(spark, kinds):
    docs = spark.createDataFrame([(i, f"some text {i}") for i in range(50)], "doc_id long, text string")
    labels = spark.createDataFrame(list(enumerate(kinds)), "doc_id long, toxic int")
    assert toxicity.keep_clean(docs, toxicity.train(docs, labels)).count() == 50


def test_held_out_ranking_and_recall(spark):
    """Recall, and the share of (toxic, clean) pairs that the score orders rightly."""
    sf01 = "/root/testdata/sf0.1"  # some 800 held-out labels
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf01}/labels.parquet").collect()}
    rows = QUERIES["op6_toxicity_grammar"](spark, sf01).collect()
    held = [(r.score, r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    toxic, clean = [x for x in held if x[2]], [x for x in held if not x[2]]
    pairs = [(a[0] > b[0]) + 0.5 * (a[0] == b[0]) for a in toxic for b in clean]
    assert len(toxic) > 50 and sum(pairs) / len(pairs) > 0.95 and sum(x[1] for x in toxic) / len(toxic) > 0.9
