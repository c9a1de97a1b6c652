"""Document fingerprints: weighted SimHash, and radius search in permuted block tables.

A text's terms are its adjacent word pairs (its only word, if it has one). A term votes on 64
signed bits with the weight of its length, longer terms being rarer; the fingerprint has the bits
that the votes make positive. Votes are summed in whole-stage code, two bits to a number, in the
partition that already holds the text.

The radius search cuts fingerprints into blocks. Two fingerprints within the radius agree in all
but at most ``radius`` blocks, so each way to choose the agreeing blocks makes a table whose key
is those blocks, moved to the front; equal keys are the candidates, and the distance decides.

All expressions are SQL functions. Defined cases: NULL text is the empty text; a text without
words has fingerprint zero; a NULL id comes first in the order of documents, rows with one id
are ordered by a hash of the text; after the last document comes the first, which is its own
successor if it is alone; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerline.llm.texts import WORD, filled
from hammerline.session import write_table

BITS = 64
HEAVIEST = 24
RADIUS = 3
BLOCKS = 6
# Text bytes that a range of documents should hold, and the most ranges.
RANGE_BYTES = 8 << 20
MAX_RANGES = 100_000
# Votes of bits i and i + 32 are summed in the halves of one long.
LANES = (1 << 32) + 1


def terms(text: Column) -> Column:
    """array of (hash, weight): the word pairs of a text, or its only word."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))

    def term(*parts: Column) -> Column:
        size = reduce(lambda a, b: a + b, (F.length(p) for p in parts))
        return F.struct(F.xxhash64(*parts).alias("hash"), F.least(size, F.lit(HEAVIEST)).cast("long").alias("weight"))

    return F.when(F.size(words) < 2, F.transform(words, lambda w: term(w))).otherwise(
        F.zip_with(F.slice(words, F.lit(1), F.size(words) - 1), F.slice(words, F.lit(2), F.size(words) - 1), lambda a, b: term(a, b))
    )


def _votes() -> list[Column]:
    """Sums over rows of (hash, weight); without terms they are NULL."""
    lane = lambda i: F.shiftrightunsigned("hash", i).bitwiseAND(F.lit(LANES))
    return [F.sum(F.col("weight") * lane(i)).alias(f"v{i}") for i in range(BITS // 2)] + [F.sum("weight").alias("votes")]


def _bits() -> Column:
    """The fingerprint: bits whose votes are over half of all. NULL sums give zero."""

    def bit(votes: Column, i: int) -> Column:
        return F.shiftleft(F.coalesce((2 * votes > F.col("votes")).cast("long"), F.lit(0)).cast("long"), i)

    low = [bit(F.col(f"v{i}").bitwiseAND(F.lit((1 << 32) - 1)), i) for i in range(BITS // 2)]
    high = [bit(F.shiftrightunsigned(f"v{i}", 32), i + 32) for i in range(BITS // 2)]
    return reduce(lambda a, b: a.bitwiseOR(b), low + high)


def fingerprints(texts: DataFrame, keys: list[str], text_col: str = "text") -> DataFrame:
    """The keys with ``fp``, one row per distinct keys; terms of rows with equal keys vote together.

    Partial sums leave each task once per key; nothing is shuffled if the rows already lie
    together by some of the keys.
    """
    each = texts.select(*keys, F.explode_outer(terms(filled(text_col))).alias("term"))
    each = each.select(*keys, F.col("term.hash").alias("hash"), F.col("term.weight").alias("weight"))
    return each.groupBy(*keys).agg(*_votes()).select(*keys, _bits().alias("fp"))


def hex16(value: Column) -> Column:
    return F.lpad(F.lower(F.hex(value)), 16, "0")


def likeness(a: Column, b: Column) -> Column:
    """The share of bits two fingerprints have in common."""
    return 1 - F.bit_count(a.bitwiseXOR(b)) / F.lit(float(BITS))


def _ranges(rows: DataFrame) -> Column:
    """A range number for each id, so that ranges follow the order of ids and hold about
    RANGE_BYTES of text each, or a MAX_RANGES-th of it. The borders become a literal."""
    total = rows.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    n = min(MAX_RANGES, -(-total // RANGE_BYTES))
    if n < 2:
        return F.lit(0)
    cuts = [i / n for i in range(1, n)]
    borders = rows.agg(F.percentile_approx("id", cuts, max(10_000, 10 * n))).first()[0]
    return place_among(F.col("id"), sorted(set(borders or [])))


def _numbers(values: list[int]) -> Column:
    """An array that the planner folds into one literal, however long it is."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<long>")


def place_among(value: Column, borders: list[int]) -> Column:
    """How many of the sorted borders a number reaches, 0 for NULL.

    Looks at every so many-th border first and then at those up to the next, about twice the
    root of their number in all.
    """
    if not borders:
        return F.lit(0)
    step = math.isqrt(len(borders)) + 1
    reached = lambda array: F.coalesce(F.size(F.filter(array, lambda b: b <= value)), F.lit(0))
    block = F.greatest(reached(_numbers(borders[::step])), F.lit(1)) - 1
    return block * step + reached(F.slice(_numbers(borders), block * step + 1, F.lit(step)))


def with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(range, nth, guest, id, text, next_text), in order of ids within each range.

    Texts are shuffled once, by range. Each range also gets the first document of the one after
    it as a guest in its last place, which closes the gaps; guests have no successor.
    """
    rows = docs.select(F.col(id_col).alias("id"), filled(text_col).alias("text"))
    rows = rows.withColumns({"range": _ranges(rows), "mark": F.xxhash64("text")})
    heads = rows.groupBy("range").agg(F.min(F.struct("id", "mark")).alias("head"))
    # One row per range, at most MAX_RANGES: the window and the broadcast are bounded by that.
    order = Window.orderBy("range")
    ends = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    heads = write_table(
        heads.withColumn("to", F.coalesce(F.lag("range").over(order), F.max("range").over(ends))), "heads"
    )
    first = F.broadcast(heads.select(F.col("range").alias("_range"), "head", "to"))
    guests = rows.join(
        first,
        (F.col("range") == F.col("_range")) & F.col("id").eqNullSafe(F.col("head.id")) & (F.col("mark") == F.col("head.mark")),
    )
    guests = guests.dropDuplicates(["range"]).select("id", "text", F.col("to").alias("range"), "mark")
    both = rows.withColumn("guest", F.lit(False)).unionByName(guests.withColumn("guest", F.lit(True)))
    order = Window.partitionBy("range").orderBy("guest", "id", "mark")
    return both.select(
        "range", F.row_number().over(order).alias("nth"), "guest", "id", "text", F.lead("text").over(order).alias("next_text")
    )


def with_edit(ordered: DataFrame) -> DataFrame:
    """Adds n_chars and the edited text: its last quarter gives way to the next text's start."""
    size = F.length("text")
    gone = F.floor(size / 4).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), size - gone), F.substring(F.coalesce("next_text", F.lit("")), F.lit(1), gone))
    return ordered.withColumns({"n_chars": size.cast("long"), "edited": edited})


def _masks(radius: int, blocks: int) -> list[int]:
    """For each choice of blocks that must agree, their bits as a signed number."""
    cuts = [round(i * BITS / blocks) for i in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    chosen = (sum(block[i] for i in kept) for kept in combinations(range(blocks), blocks - radius))
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in chosen]


def within_radius(queries: DataFrame, prints: DataFrame, radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """(q, fp): all fingerprints of ``prints`` within the radius of each of ``queries``, each
    pair once. Both should hold distinct values in column ``fp``.

    Keys keep ``blocks - radius`` blocks, half of the bits by default. A pair is reported by the
    first of the tables that hold it.
    """
    masks = _masks(radius, blocks)
    table = lambda df, name: df.select(
        F.col("fp").alias(name),
        F.posexplode(F.array(*(F.col("fp").bitwiseAND(F.lit(m)) for m in masks))).alias("table", "key"),
    )
    left, right = table(queries, "q"), table(prints, "fp")
    apart = F.col("q").bitwiseXOR(F.col("fp"))
    first = F.coalesce(*(F.when(apart.bitwiseAND(F.lit(m)) == 0, F.lit(i)) for i, m in enumerate(masks)))
    same = (left["table"] == right["table"]) & (left["key"] == right["key"])
    close = (F.bit_count(apart) <= radius) & (first == left["table"])
    # Each row became one per table, which the planner's sizes don't see: no broadcast here.
    return left.join(right.hint("merge"), same & close).select("q", "fp")


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", every: int = 20, radius: int = RADIUS) -> DataFrame:
    """One row per document: id, n_chars, edited_sha256, both fingerprints, near_edited,
    near_next, and near_prints: for ids divisible by ``every`` the number of other distinct
    fingerprints in the table within the radius, NULL for the rest."""
    edited = with_edit(with_next(docs, id_col, text_col))
    keys = ["range", "nth", "guest", "id", "n_chars", "edited_sha256"]
    versions = F.explode(F.array(F.struct(F.lit(0).alias("v"), "text"), F.struct(F.lit(1).alias("v"), F.col("edited").alias("text"))))
    texts = edited.withColumn("edited_sha256", F.sha2("edited", 256)).select(*keys, versions.alias("of"))
    prints = fingerprints(texts.select(*keys, "of.v", "of.text"), [*keys, "v"])
    side = lambda v: F.max(F.when(F.col("v") == v, F.col("fp")))
    prints = prints.groupBy(*keys).agg(side(0).alias("fp"), side(1).alias("edited_fp"))
    after = F.lead("fp").over(Window.partitionBy("range").orderBy("nth"))
    prints = prints.withColumn("next_fp", after).where("not guest").drop("range", "nth", "guest")
    prints = write_table(prints, "prints")

    distinct = write_table(prints.select("fp").distinct(), "distinct")
    asked = prints.where(F.col("id").cast("long") % every == 0).select("fp").distinct()
    found = within_radius(asked, distinct, radius).where("q != fp").groupBy("q").agg(F.count("*").alias("near"))
    out = prints.join(found, prints["fp"] == found["q"], "left")
    count = F.when(F.col("id").cast("long") % every == 0, F.coalesce("near", F.lit(0)))
    return out.select(
        F.col("id").alias(id_col),
        "n_chars",
        "edited_sha256",
        hex16(F.col("fp")).alias("fingerprint"),
        hex16(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
        count.alias("near_prints"),
    )
