"""Periodic stretches of words, by a dictionary of basic factors.

A run is a maximal stretch of consecutive words with smallest period q that is at least
``LEAST_WORDS`` words and ``LEAST_POWER`` periods long. The dictionary names the factors of
every power-of-two length: equal names, equal words. The name of a factor of 2L words is the
pair of names of its halves, and only factors that occur again in their text are carried on.

Per length L the occurrences of a name, in order, give each position its successor. Occurrences
that follow within twice the length (a distance up to L, so that both lie in 2L words) form
arithmetic progressions, whose common difference proposes a period. A period q is read at the
length with L/2 < q <= L, where the successor of a run's factor stands exactly q further, since
a nearer one would, overlapping by q words and more, give the run a smaller period. A
progression is extended by the positions beside it that propose the same period: neighbouring
factors share all but one word, so the extended stretch is the maximal one, and the
progressions of one run become one row.

Texts are independent, so the work is a map over the documents: no shuffle, and a text's cost is
a sort per length. Lots of ``LOT_BYTES`` bound what a task holds beyond its longest text.

Defined cases: NULL text is the empty text, which has no words and no runs; words are runs of
anything but ASCII blanks; repeated rows and NULL ids are documents of their own; texts of any
length are read whole; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hammerline.llm.texts import WORD, filled

LEAST_WORDS, LEAST_POWER = 6, 4
# Texts handled at once, in bytes; a longer text is a lot of its own.
LOT_BYTES = 4 << 20

RUN = T.StructType([T.StructField(name, T.LongType(), False) for name in ("start", "length", "period")])


def _named(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Dense names of the keys, their stable order, and where the next in order is equal."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    names = np.empty(len(keys), dtype=np.int64)
    names[order] = np.concatenate([[0], np.cumsum(~same)])
    return names, order, same


def runs_of(words: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Rows (start, length, period) in order of start and period.

    ``words`` are numbers that differ between texts, ``ends`` says per word where its text ends;
    starts count from the first word of all.
    """
    at, keys, size, found = np.arange(len(words)), words, 1, []
    while len(at) > 1:
        names, order, same = _named(keys)
        step = np.zeros(len(at), dtype=np.int64)
        step[order[:-1]] = np.where(same, at[order[1:]] - at[order[:-1]], 0)
        proposed = np.flatnonzero((2 * step > size) & (step <= size))
        if len(proposed):
            start, period = at[proposed], step[proposed]
            first = np.flatnonzero(np.diff(start, prepend=-2) + np.abs(np.diff(period, prepend=0)) != 1)
            last = np.append(first[1:], len(start)) - 1
            start, period, length = start[first], period[first], start[last] - start[first] + size + period[first]
            good = length >= np.maximum(LEAST_WORDS, LEAST_POWER * period)
            found.append(np.stack([start, length, period], axis=1)[good])
        # The next length: both halves occur again, and the whole factor ends within its text.
        again = np.zeros(len(at), dtype=bool)
        again[order[:-1]] = same
        again[order[1:]] |= same
        at, names = at[again], names[again]
        half = np.searchsorted(at, at + size)
        whole = at + 2 * size <= ends[at]
        whole &= at[np.minimum(half, len(at) - 1)] == at + size
        at, keys = at[whole], names[whole] * len(words) + names[half[whole]]
        size *= 2
    runs = np.unique(np.concatenate(found), axis=0) if found else np.empty((0, 3), dtype=np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _lot(texts: list[str]) -> tuple[list[int], list[list[dict[str, int]]], list[str]]:
    """Per text: number of words, runs, and the words that stay."""
    words = [text.encode().split() for text in texts]
    counts = np.array([len(w) for w in words], dtype=np.int64)
    begins = np.cumsum(counts) - counts
    text_of = np.repeat(np.arange(len(texts)), counts)
    known: dict[bytes, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for ws in words for w in ws), np.int64, int(counts.sum()))
    runs = runs_of(text_of * len(known) + ids, (begins + counts)[text_of])
    bounds = np.searchsorted(runs[:, 0], np.append(begins, counts.sum()))
    listed, kept = [], []
    for i, own in enumerate(words):
        rows = runs[bounds[i] : bounds[i + 1]] - np.array([begins[i], 0, 0])
        if len(rows):
            covered = np.zeros(len(own) + 1, dtype=np.int64)
            np.add.at(covered, rows[:, 0] + rows[:, 2], 1)
            np.add.at(covered, rows[:, 0] + rows[:, 1], -1)
            own = [own[k] for k in np.flatnonzero(np.cumsum(covered[:-1]) == 0)]
        listed.append([dict(zip(RUN.names, row)) for row in rows.tolist()])
        kept.append(b" ".join(own).decode())
    return counts.tolist(), listed, kept


def _map(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    run = pa.struct([(name, pa.int64()) for name in RUN.names])
    for batch in batches:
        sizes = pa.compute.binary_length(batch.column(1)).to_numpy(zero_copy_only=False)
        lots = np.cumsum(sizes) // LOT_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(lots)) + 1).tolist(), batch.num_rows]
        for a, b in zip(cuts, cuts[1:]):
            counts, runs, kept = _lot(batch.column(1).slice(a, b - a).to_pylist())
            columns = [pa.array(counts, pa.int64()), pa.array(runs, pa.list_(run)), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), *columns], ["id", "n_words", "runs", "collapsed"])


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str | Column = "text") -> DataFrame:
    """One row per document: id, n_words, ``runs`` (start, length, period) by start and period,
    and ``collapsed``: the words outside every run's repetitions, joined by one space.

    Of each run its first period stays; a word that any run repeats goes.
    """
    narrow = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", narrow.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(RUN)),
            T.StructField("collapsed", T.StringType()),
        ]
    )
    return narrow.mapInArrow(_map, schema).withColumnRenamed("id", id_col)


def planted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, text) with a stated tenth of the texts made periodic from one word on.

    With h the CRC-32 of the decimal id and g = h / 10: where h ends in 0, the words from
    a = g % n on repeat the p = 1 + (n - a) / (3 + g % 8) words at a. Other texts, and those
    without words or id, stay as they are.
    """
    h = F.crc32(F.col(id_col).cast("string").cast("binary"))
    chosen = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"), F.floor(h / 10).alias("g"), (h % 10).alias("h"))
    words = F.when(F.col("h") == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    chosen = chosen.withColumn("words", words).withColumn("n", F.size("words").cast("long"))
    chosen = chosen.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")))
    chosen = chosen.withColumn("p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8)))
    block = F.slice("words", (F.col("a") + 1).cast("int"), F.col("p").cast("int"))
    times = F.ceil((F.col("n") - F.col("a")) / F.col("p")).cast("int")
    whole = F.concat(F.slice("words", F.lit(1), F.col("a").cast("int")), F.flatten(F.array_repeat(block, times)))
    edited = F.array_join(F.slice(whole, F.lit(1), F.col("n").cast("int")), " ")
    return chosen.select(F.col("id").alias(id_col), F.when(F.col("a").isNotNull(), edited).otherwise(F.col("text")).alias("text"))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: number of runs, the greatest one, digests of all and of what stays."""
    found = find_runs(docs, id_col, text_col)
    # The greatest run has the least (-length, start, period).
    found = found.withColumn(
        "best", F.array_min(F.transform("runs", lambda r: F.struct((-r["length"]).alias("l"), r["start"], r["period"])))
    )
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    length, period = -F.col("best.l"), F.col("best.period")
    return found.select(
        id_col,
        F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(length * 1000 / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )
