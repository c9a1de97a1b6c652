"""Mixing sources to target weights by subset-sum budget fitting.

Each source's budget is met in words. Whole copies of the source cover the full multiples of
its size; for the rest, documents are counted by exact length, the budget is shared over the
lengths in proportion, a bounded-knapsack dynamic programme over the remaining counts closes
the gap, and so many documents of each length are selected in a seeded order.

Only counts by (source, length) are planned; a source's plan holds its distinct lengths, never
its documents. Within a length, documents are ranked in seeded slices of about ``SLICE`` rows,
so that one source and length with a third of all rows is not one task.

Defined cases: NULL text has size 0; NULL source is a source of its own, last in order; empty
documents are never repeated (0 words); repeated rows are documents of their own; an empty
table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerline.llm.texts import filled, word_count
from hammerline.session import write_table

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
# Budgets up to so many words are closed exactly by the dynamic programme.
EXACT_WORDS = 16_384
# Sums that the fit of a whole source keeps apart; exact for targets of up to so many words.
PLACES = 1 << 18
SLICE = 10_000
SEED = 17


def source_targets(
    sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, share: float = SHARE, most: float = MOST
) -> DataFrame:
    """(source, weight, source_size, target) from rows of (source, size).

    Targets are ``level * weight``, stopped at ``most`` times the size. The level at which they
    add up to the share of all words follows from the sources in order of cap over weight. The
    windows run over one row per source, the mixing recipe itself.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (rank % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    every = Window.partitionBy()
    before = Window.orderBy(F.col("_cap") / F.col("weight"), F.col("source").asc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    per = per.withColumns(
        {
            "_total": F.sum("source_size").over(every) * F.lit(float(share)),
            "_capped": F.coalesce(F.sum("_cap").over(before), F.lit(0.0)),
            "_left": F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(before), F.lit(0.0)),
        }
    )
    level = (F.col("_total") - F.col("_capped")) / F.col("_left")
    # The first source, in that order, whose cap the level doesn't reach fixes the level.
    fits = F.when(level * F.col("weight") <= F.col("_cap"), level)
    per = per.withColumn("_level", F.max(fits).over(every))
    target = F.least(F.col("_cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("_cap")))
    return per.select("source", "weight", "source_size", target.alias("target"))


def fit_lengths(lengths: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length to take so that their words come to the budget.

    ``counts`` bounds each length. Shares proportionally, then rounds up where it fits, then
    closes what is left by dynamic programming over the spare counts.
    """
    total = int((lengths * counts).sum())
    if budget <= 0 or total == 0:
        return np.zeros(len(lengths), dtype=np.int64)
    if budget >= total:
        return counts.astype(np.int64)
    exact = counts * (budget / total)
    take = np.floor(exact).astype(np.int64)
    rest = budget - int((take * lengths).sum())
    for i in np.argsort(-(exact - take), kind="stable"):
        if rest <= EXACT_WORDS:
            break
        if lengths[i] and take[i] < counts[i] and lengths[i] <= rest:
            take[i] += 1
            rest -= int(lengths[i])
    for i in np.argsort(-lengths, kind="stable"):
        if rest <= EXACT_WORDS:
            break
        if lengths[i]:
            more = min(int(counts[i] - take[i]), (rest - EXACT_WORDS // 2) // int(lengths[i]))
            take[i] += max(0, more)
            rest -= max(0, more) * int(lengths[i])
    for i, more in knapsack(lengths, counts - take, rest).items():
        take[i] += more
        rest -= more * int(lengths[i])
    spare = np.flatnonzero((counts > take) & (lengths > 0))
    if len(spare) and 2 * rest > lengths[spare].min():  # one more is nearer than none
        take[spare[lengths[spare].argmin()]] += 1
    return take


def knapsack(lengths: np.ndarray, spare: np.ndarray, budget: int) -> dict[int, int]:
    """The largest sum up to the budget, as {index: number}; sums are bits of one integer.

    After each length the reachable sums are kept, from which the choice is read backwards.
    """
    mask = (1 << (budget + 1)) - 1
    reach, steps = 1, []
    for i in np.flatnonzero((spare > 0) & (lengths > 0) & (lengths <= budget)):
        steps.append((int(i), reach))
        left, chunk, size = min(int(spare[i]), budget // int(lengths[i])), 1, int(lengths[i])
        while left > 0:  # 1, 2, 4, ... copies reach every number up to the bound
            step = min(chunk, left)
            reach |= (reach << (step * size)) & mask
            left, chunk = left - step, chunk * 2
        if reach >> budget & 1:
            break
    at, chosen = reach.bit_length() - 1, {}
    for i, before in reversed(steps):
        size = int(lengths[i])
        n = 0
        while not before >> at & 1:
            at, n = at - size, n + 1
        if n:
            chosen[i] = n
    return chosen


def nearest_sum(lengths: np.ndarray, spare: np.ndarray, aim: int, over: int, places: int = PLACES) -> dict[int, int]:
    """A sum near the aim, at most ``over`` above it, as {index: number}.

    Sums up to ``places`` are all found. Beyond that, of the sums that share a place, one is kept with
    its exact value, so the work grows with the number of lengths and not with the aim.
    """
    top = aim + over
    scale = min(1.0, places / max(top, 1))
    sums = np.full(int(top * scale) + 2, -1, dtype=np.int64)
    sums[0] = 0
    came, index, number = (np.zeros(len(sums), dtype=np.int64) for _ in range(3))
    near = max(1, aim / EXACT_WORDS)

    def best() -> int:
        found = np.flatnonzero(sums >= 0)
        return int(found[np.abs(sums[found] - aim).argmin()])

    for i in np.flatnonzero((spare > 0) & (lengths > 0) & (lengths <= top))[::-1]:
        left, chunk, size = min(int(spare[i]), top // int(lengths[i])), 1, int(lengths[i])
        while left > 0:  # 1, 2, 4, ... copies reach every number up to the bound
            step = min(chunk, left)
            held = np.flatnonzero((sums >= 0) & (sums <= top - step * size))
            at = ((sums[held] + step * size) * scale).astype(np.int64)
            free = sums[at] < 0
            at, first = np.unique(at[free], return_index=True)
            held = held[free][first]
            sums[at], came[at], index[at], number[at] = sums[held] + step * size, held, i, step
            left, chunk = left - step, chunk * 2
        if abs(int(sums[best()]) - aim) < near:
            break
    at, chosen = best(), {}
    while at:
        chosen[int(index[at])] = chosen.get(int(index[at]), 0) + int(number[at])
        at = int(came[at])
    return chosen


def plan_units(lengths: np.ndarray, counts: np.ndarray, target: float) -> np.ndarray:
    """Copies to deal out over each length's documents, at most MOST times their number.

    Whole copies of all documents first, then a fitted part of one more. A source of too few
    documents for that to come out within a word, or a small share of a larger target, is fitted as
    a whole if that is nearer, giving up the even coverage.
    """
    size = int((lengths * counts).sum())
    copies = min(MOST, int(target / size + 1e-9)) if size else 0
    units = copies * counts
    if copies < MOST:
        units = units + fit_lengths(lengths, counts, round(target - copies * size))
    gap = abs(int((units * lengths).sum()) - target)
    if gap > max(1, target / EXACT_WORDS):
        whole = np.zeros_like(units)
        for i, n in nearest_sum(lengths, MOST * counts, round(target), int(gap)).items():
            whole[i] = n
        if abs(int((whole * lengths).sum()) - target) < gap:
            return whole
    return units


def _plan(pdf: pd.DataFrame) -> pd.DataFrame:
    pdf = pdf.sort_values("size")
    lengths, counts = pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64)
    units = plan_units(lengths, counts, float(pdf["target"].iloc[0]))
    return pd.DataFrame(
        {"key": pdf["key"], "size": lengths, "n": counts, "copies": units // counts, "extra": units % counts}
    )


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: int = SEED,
) -> DataFrame:
    """One row per document: row, id, source, size, source_size, target, copies, taken.

    ``row`` numbers the rows of the input as read; ``copies`` is 0 to 2 and ``taken`` the words.
    """
    text = filled(F.col(text_col))
    narrow = write_table(
        docs.select(
            F.col(id_col).alias("id"),
            F.col(source_col).cast("string").alias("source"),
            word_count(text).alias("size"),
            F.xxhash64(F.col(id_col), F.xxhash64(text), F.lit(seed)).alias("order"),
        ),
        "sizes",
    ).withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit("")))
    targets = write_table(source_targets(narrow), "targets")
    targets = targets.withColumn("key", F.coalesce(F.concat(F.lit("s"), F.col("source")), F.lit(""))).drop("source")
    lengths = narrow.groupBy("key", "size").agg(F.count("*").alias("n")).join(targets, "key")
    plan = write_table(
        lengths.groupBy("key").applyInPandas(_plan, "key string, size long, n long, copies long, extra long"), "plan"
    )
    rows = narrow.join(plan, ["key", "size"])
    slices = F.ceil(F.col("n") / SLICE)
    rows = rows.withColumn("slice", F.pmod(F.col("order"), slices))
    per_slice = (
        rows.where(F.col("n") > SLICE)
        .where(F.col("extra") > 0)
        .groupBy("key", "size", "slice", "extra")
        .agg(F.count("*").alias("m"))
    )
    earlier = Window.partitionBy("key", "size").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    quota = per_slice.select(
        "key", "size", "slice", (F.col("extra") - F.coalesce(F.sum("m").over(earlier), F.lit(0))).alias("quota")
    )
    ranked = rows.where(F.col("extra") > 0).join(quota, ["key", "size", "slice"], "left")
    rank = F.row_number().over(Window.partitionBy("key", "size", "slice").orderBy("order", "id"))
    ranked = ranked.withColumn("more", (rank <= F.coalesce("quota", "extra")).cast("int")).drop("quota")
    plain = rows.where("extra = 0").withColumn("more", F.lit(0))
    out = plain.unionByName(ranked).withColumn("copies", F.col("copies") + F.col("more"))
    return (
        out.join(targets, "key")
        .select("id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"), "order")
        .withColumnRenamed("id", id_col)
    )


def order_key(id_col: Column, text: Column, seed: int = SEED) -> Column:
    """The seeded key by which :func:`mix` orders documents; equal only for equal id and text."""
    return F.xxhash64(id_col, F.xxhash64(filled(text)), F.lit(seed))


def apply_mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """The mixed corpus: each row as often as the mix takes it, with the input's columns.

    Rows are matched by id and seeded key. Rows alike in both are interchangeable, so their
    copies are added up and dealt over them evenly.
    """
    alike = ["order", "id", "source"]
    chosen = mix(docs, id_col, text_col, source_col).withColumnRenamed(id_col, "id").groupBy(*alike).agg(
        F.sum("copies").alias("copies"), F.count("*").alias("alike")
    )
    chosen = chosen.select(*(F.col(c).alias(f"_{c}") for c in alike), "copies", "alike")
    rows = docs.select(
        F.struct("*").alias("doc"),
        F.col(id_col).alias("id"),
        F.col(source_col).cast("string").alias("source"),
        order_key(F.col(id_col), F.col(text_col)).alias("order"),
    )
    same = F.col("order") == F.col("_order")
    joined = rows.join(
        chosen, same & F.col("id").eqNullSafe(F.col("_id")) & F.col("source").eqNullSafe(F.col("_source"))
    )
    once = joined.where("alike = 1").select("doc", F.col("copies").alias("n"))
    nth = F.row_number().over(Window.partitionBy(*alike).orderBy("order"))
    many = joined.where("alike > 1").withColumn("nth", nth)
    share = F.floor(F.col("copies") / F.col("alike")) + (F.col("nth") <= F.col("copies") % F.col("alike")).cast("long")
    spread = once.unionByName(many.select("doc", share.alias("n"))).where("n > 0")
    return spread.select("doc", F.explode(F.sequence(F.lit(1), F.col("n").cast("int")))).select("doc.*")
