"""Toxicity by a weighted finite-state pattern grammar over clauses.

Small transducers read the words of a clause as symbols: the insult and threat transducers pay
the weight of a word, the target transducer raises what stands with an address ("you"), the
negation and reported-speech transducers lower what follows them within a few words. They are
composed into one machine, and a clause scores what its path pays. Nothing is scored outside a
matched clause.

Which words insult or threaten, and how much, is learned: whole words and word beginnings whose
share of toxic documents is high with confidence. A logistic fit turns the clause scores of a
text into a probability. The lexicon that the fit sees comes from other documents than the fit,
so that it isn't taught by words it has picked itself.

Training takes at most ``MAX_LABELLED`` labelled documents, chosen by a hash of the id, never of
the held-out fold (crc32 of the id as text divisible by 5). Language, source and id are not
inputs of a score.

Defined cases: NULL text is the empty text and gets the score of a text without a match; ids
without a number (NULL) are not held out; of several labels of an id the highest counts; without
labels of both kinds every score is the share of toxic ones (0 without labels); repeated rows
score alike; empty tables give an empty result.
"""

from __future__ import annotations

import math
import warnings
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline.llm.texts import filled
from hammerline.session import write_table

MAX_LABELLED = 20_000
FOLDS = 5
# A form needs so many toxic documents, and this log-odds at the lower confidence bound.
SUPPORT = 4
LEAST_WEIGHT = 1.5
CONFIDENCE = 1.64
LEXICON = 5_000
PREFIXES = (4, 5, 6, 7)
SEED = 11
# Words whose class is remembered by a task, and texts whose forms are counted together.
REMEMBERED = 200_000
COUNTED_TOGETHER = 200

OTHER, INSULT, THREAT, TARGET, NEGATION, REPORT, END = range(7)
# Function words of the grammar, by class, in English, German, French and Spanish.
GRAMMAR = {
    TARGET: "you your yours yourself u ur du dich dir dein deine ihr euch sie tu te toi vous ton ta tes vos "
    "tú ti usted ustedes vosotros tus he she they him her them",
    NEGATION: "not no never none neither nor without isn aren wasn don doesn didn nicht kein keine nie niemals "
    "ohne ne pas jamais aucun sans nunca sin ni ningún jamás",
    REPORT: "said says say told tells claimed claims wrote writes quoted according sagte sagt schrieb laut "
    "behauptet dit disait écrit selon affirme dijo dice escribió según afirma",
    THREAT: "kill hurt destroy burn murder shoot stab beat töten umbringen verletzen vernichten tuer frapper "
    "détruire matar herir destruir golpear",
}
# Arc weights: what an address, a negation and reported speech do to a word's weight, and for
# how many words the last two hold.
TARGETED, NEGATED, REPORTED = 1.3, 0.6, 0.7
REACH = 3
THREAT_WEIGHT = 1.0
TOKEN = re.compile(r"[^\W\d_]+|[.!?;:,\n\"“”«»]")


@dataclass(frozen=True)
class Transducer:
    """States 0..n-1 from 0; ``step[state][symbol]`` is the next state, ``factor`` what the
    state multiplies a paid weight by, and ``pays`` the symbols whose words pay their weight."""

    step: tuple[tuple[int, ...], ...]
    factor: tuple[float, ...]
    pays: frozenset[int] = frozenset()


def holds(symbol: int, reach: int, factor: float) -> Transducer:
    """In force for ``reach`` words after a symbol, or to the end of the clause if 0."""
    n = reach + 1 if reach else 2
    step = []
    for state in range(n):
        onward = state - 1 if reach and state else state
        step.append(tuple(n - 1 if s == symbol else 0 if s == END else onward for s in range(7)))
    return Transducer(tuple(step), (1.0, *[factor] * (n - 1)))


def pays(symbol: int) -> Transducer:
    return Transducer(((0,) * 7,), (1.0,), frozenset([symbol]))


def compose(*parts: Transducer) -> Transducer:
    """The product machine: all parts read each symbol, and their factors multiply."""
    states = list(product(*(range(len(p.step)) for p in parts)))
    number = {s: i for i, s in enumerate(states)}
    step = tuple(
        tuple(number[tuple(p.step[x][symbol] for p, x in zip(parts, s))] for symbol in range(7)) for s in states
    )
    factor = tuple(float(np.prod([p.factor[x] for p, x in zip(parts, s)])) for s in states)
    return Transducer(step, factor, frozenset().union(*(p.pays for p in parts)))


def grammar() -> Transducer:
    return compose(
        pays(INSULT), pays(THREAT), holds(TARGET, 0, TARGETED), holds(NEGATION, REACH, NEGATED), holds(REPORT, REACH, REPORTED)
    )


@dataclass
class Model:
    lexicon: dict[str, float] = field(default_factory=dict)
    coefficients: tuple[float, ...] | None = None
    share: float = 0.0


def forms(word: str) -> list[str]:
    """A word as a whole (marked by $) and its beginnings."""
    return [word + "$", *(word[:k] for k in PREFIXES if len(word) > k)]


class Scorer:
    """Runs the grammar over texts."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.machine = lexicon, grammar()
        self.fixed = {w: c for c, words in GRAMMAR.items() for w in words.split()}
        self.classes: dict[str, int] = {}
        self.weights: dict[str, float] = {}

    def classify(self, word: str) -> int:
        if not word[0].isalpha():
            return END
        weight = max((self.lexicon.get(f, 0.0) for f in forms(word)), default=0.0)
        if weight:
            self.weights[word] = weight
            return INSULT
        kind = self.fixed.get(word, OTHER)
        if kind == THREAT:
            self.weights[word] = THREAT_WEIGHT
        return kind

    def clauses(self, text: str) -> tuple[list[float], int]:
        """The scores of the matched clauses, and the number of words."""
        tokens = TOKEN.findall(text.lower())
        if len(self.classes) > REMEMBERED:
            self.classes, self.weights = {}, {}
        known = self.classes
        for word in set(tokens).difference(known):
            known[word] = self.classify(word)
        symbols = bytes(map(known.__getitem__, tokens))
        words = len(symbols) - symbols.count(END)
        scores = []
        start = 0
        # Clauses without a word that pays are passed over.
        while (first := self.next_match(symbols, start)) >= 0:
            begin = symbols.rfind(END, 0, first) + 1
            end = symbols.find(END, first)
            end = len(symbols) if end < 0 else end
            scores.append(self.run(symbols[begin:end], tokens[begin:end]))
            start = end
        return scores, words

    @staticmethod
    def next_match(symbols: bytes, start: int) -> int:
        found = [p for p in (symbols.find(INSULT, start), symbols.find(THREAT, start)) if p >= 0]
        return min(found, default=-1)

    def run(self, symbols: bytes, words: list[str]) -> float:
        """What a clause's path pays. An address after the word counts as well: the clause is
        read with the target part already in force if it has one."""
        machine, state, paid = self.machine, 0, 0.0
        if TARGET in symbols:
            state = machine.step[state][TARGET]
        for symbol, word in zip(symbols, words):
            if symbol in machine.pays:
                paid += self.weights[word] * machine.factor[state]
            state = machine.step[state][symbol]
        return paid

    def features(self, text: str) -> np.ndarray:
        """1, log of the sum, log of the best clause, log of matched clauses, density."""
        scores, words = self.clauses(text)
        total = sum(scores)
        best = max(scores, default=0.0)
        return np.array([1.0, np.log1p(total), np.log1p(best), np.log1p(len(scores)), np.log1p(100 * total / max(words, 20))])


def held_out(id_col: Column) -> Column:
    """Whether crc32 of the id as text is divisible by 5."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % FOLDS == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, most: int = MAX_LABELLED) -> DataFrame:
    """(fold, text, toxic) of at most about ``most`` labelled documents outside the held-out
    fold, equal texts once. Labels are thinned first, which bounds what is broadcast."""
    label = labels.select(F.col(id_col).alias("id"), F.col("toxic").cast("int").alias("toxic"))
    label = label.where("id is not null and toxic is not null").where(~held_out(F.col("id")))
    label = label.groupBy("id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, most / max(1, label.count()))
    label = label.where(F.pmod(F.xxhash64("id", F.lit(SEED)), F.lit(1 << 20)) < F.lit(int(share * (1 << 20))))
    texts = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    chosen = texts.join(F.broadcast(label), "id")
    fold = F.crc32(F.col("id").cast("string").cast("binary")) % FOLDS
    chosen = chosen.select(fold.alias("fold"), "text", "toxic", F.xxhash64("text").alias("mark"))
    return chosen.dropDuplicates(["mark"]).drop("mark")


def forms_of(text: str) -> set[str]:
    """All forms of the words of a text."""
    return {f for w in set(TOKEN.findall(text.lower())) if w[0].isalpha() for f in forms(w)}


def count_forms(sample: DataFrame, known: frozenset[str] | None = None) -> DataFrame:
    """(form, n): in how many texts of the sample each form, or each known one, occurs.

    Counts are handed on every few texts, so that a task holds the forms of those only.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), COUNTED_TOGETHER):
                seen: Counter[str] = Counter()
                for text in batch["text"].iloc[start : start + COUNTED_TOGETHER]:
                    found = forms_of(text)
                    seen.update(found if known is None else found & known)
                if seen:
                    yield pd.DataFrame({"form": list(seen.keys()), "n": list(seen.values())})

    counted = sample.select("text").mapInPandas(count, "form string, n long")
    return counted.groupBy("form").agg(F.sum("n").alias("n"))


def learn_lexicon(sample: DataFrame) -> dict[str, float]:
    """Forms with their weights: log-odds of a toxic document, less its uncertainty.

    Forms are sought in the toxic texts; in the others only forms with enough support are
    counted. What the driver gets of either is bounded by the words of the sample.
    """
    toxic, clean = sample.where("toxic > 0"), sample.where("toxic <= 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    support = {r["form"]: r["n"] for r in count_forms(toxic).where(F.col("n") >= SUPPORT).collect()}
    against = {r["form"]: r["n"] for r in count_forms(clean, frozenset(support)).collect()}
    weights = {}
    for form, n in support.items():
        other = against.get(form, 0)
        odds = math.log((n + 0.5) / (n_toxic + 1)) - math.log((other + 0.5) / (n_clean + 1))
        weight = odds - CONFIDENCE * math.sqrt(1 / (n + 0.5) + 1 / (other + 2))
        if weight >= LEAST_WEIGHT:
            weights[form] = weight
    best = sorted(weights.items(), key=lambda item: (-item[1], item[0]))
    return dict(best[:LEXICON])


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, rounds: int = 50) -> np.ndarray:
    """Newton's method for a logistic fit with a small penalty; the kinds weigh as they occur."""
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        gradient = x.T @ (y - p) - penalty * beta
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(hessian, gradient)
        beta += step / max(1.0, np.abs(step).max() / 5)
        if np.abs(step).max() < 1e-7:
            break
    return beta


def rising_logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """A logistic fit in which no feature lowers the score: falling ones are left out in turn."""
    used = list(range(x.shape[1]))
    while True:
        beta = logistic(x[:, used], y)
        worst = int(np.argmin(beta[1:])) + 1 if len(used) > 1 else 0
        if worst == 0 or beta[worst] >= 0:
            out = np.zeros(x.shape[1])
            out[used] = beta
            return out
        used.pop(worst)


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model:
    """Learn the lexicon and fit the scores; what reaches the driver is bounded by LEXICON rows
    and by MAX_LABELLED rows of five numbers."""
    sample = write_table(labelled_sample(docs, labels, id_col, text_col), "labelled")
    counts = {r["toxic"] > 0: r["n"] for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    share = counts.get(True, 0) / max(1, sum(counts.values()))
    if len(counts) < 2:
        return Model(share=share)
    first = learn_lexicon(sample.where("fold in (1, 2)"))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(first)
        for batch in batches:
            yield pd.DataFrame({"x": [scorer.features(t) for t in batch["text"]], "y": (batch["toxic"] > 0).astype("int32")})

    fit = sample.where("fold in (3, 4)").select("text", "toxic").mapInPandas(measure, "x array<double>, y int").toPandas()
    if fit["y"].nunique() < 2:
        return Model(share=share)
    beta = rising_logistic(np.array(fit["x"].tolist()), fit["y"].to_numpy(float))
    if not beta[1:].any():
        return Model(share=share)  # no clause tells the kinds apart
    return Model(learn_lexicon(sample), tuple(map(float, beta)), share)


def score_column(text: Column, model: Model) -> Column:
    """The probability of label 1 for each text."""

    @F.pandas_udf("double")
    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        scorer = Scorer(model.lexicon)
        for batch in batches:
            if model.coefficients is None:
                yield pd.Series(np.full(len(batch), model.share))
                continue
            x = np.array([scorer.features(t) for t in batch]).reshape(-1, 5)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ np.array(model.coefficients), -30, 30))))

    return udf(filled(text))


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, score, predicted."""
    scored = docs.select(
        F.col(id_col).alias("id"), held_out(F.col(id_col)).alias("held_out"), score_column(F.col(text_col), model).alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int")).withColumnRenamed("id", id_col)


def keep_clean(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The documents that the grammar doesn't reject, with all their columns.

    Rejected is what scores 0.5 or more and more than a text in which no clause matches, so
    mostly toxic labels reject nothing by themselves. A model that could not be fitted, as there were too few labels of either kind, tells no
    document from another: then all of them pass, with a warning.
    """
    if model.coefficients is None:
        warnings.warn("no toxicity model: too few labels of either kind; all documents pass", stacklevel=2)
        return docs
    whole = docs.select(F.struct("*").alias("doc"), score_column(F.col(text_col), model).alias("score"))
    unmatched = 1 / (1 + math.exp(-model.coefficients[0]))
    return whole.where(F.col("score") < max(0.5, math.nextafter(unmatched + 1e-12, 2))).select("doc.*")
