"""Entity resolution from aliases and free text."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.functions.text import WHITESPACE, match_key
from hammerline.session import is_small, left_join_spread_nulls, materialise, write_table

# A dictionary up to this many aliases is written into the plan as literals.
INLINE_ALIASES = 256
# Length of the text pieces that aliases of at least that length are looked up by.
GRAM = 3


def alias_rows(aliases: dict[str, str] | None = None) -> list[tuple[int, str, str]]:
    """(priority, alias, canonical) of a dictionary in its normal form, order kept."""
    source = fixed.ALIASES if aliases is None else aliases
    return normal_rows((i, alias, name) for i, (alias, name) in enumerate(source.items()))


def normal_rows(aliases: Iterable[tuple[int, str | None, str | None]]) -> list[tuple[int, str, str]]:
    """What :func:`normal_aliases` does, for a dictionary known when the plan is built."""
    kept: dict[str, tuple[int, str, str]] = {}
    complete = [(priority, alias, name) for priority, alias, name in aliases if alias is not None and name is not None]
    for priority, alias, name in sorted(complete):
        key = alias.strip(WHITESPACE).lower()
        if key:
            kept.setdefault(key, (priority, key, name))
    return list(kept.values())


def alias_table(spark: SparkSession, aliases: dict[str, str] | None = None) -> DataFrame:
    return spark.createDataFrame(alias_rows(aliases), "priority long, alias string, canonical string")


def normal_aliases(aliases: DataFrame) -> DataFrame:
    """The one form of a dictionary that every way to resolve reads: (priority, alias,
    canonical), aliases trimmed and in lower case, each once with its lowest priority.

    Aliases that are NULL or empty once trimmed, and rows without a canonical name, name
    nobody and are left out; :func:`unusable_aliases` counts them.
    """
    first = F.min(F.struct("priority", "canonical"))
    named = aliases.select("priority", match_key("alias").alias("alias"), "canonical")
    usable = named.where((F.col("alias") != "") & F.col("canonical").isNotNull())
    kept = usable.groupBy("alias").agg(first.alias("_first"))
    return kept.select("_first.priority", "alias", "_first.canonical")


def unusable_aliases(aliases: DataFrame) -> DataFrame:
    """One row: how many rows of a dictionary :func:`normal_aliases` leaves out or merges."""
    key = match_key("alias")
    usable = F.coalesce(key != "", F.lit(False)) & F.col("canonical").isNotNull()
    return aliases.agg(
        F.count_if(~usable).alias("without_name"),
        (F.count_if(usable) - F.count_distinct(F.when(usable, key))).alias("repeated"),
    )


def resolve_inline(
    df: DataFrame, name: Column | str, title: str, aliases: Iterable[tuple[int, str, str]], out: str
) -> DataFrame:
    """P4 as native expressions, for a dictionary known when the plan is built.

    1) exact alias of the trimmed lower-case name, 2) the first alias, in dictionary
    order, contained in the lower-case title, 3) NULL. The substring tests form one CASE,
    which compiles to plain code; an array filter over the same aliases is interpreted
    and took ten times as long. ``aliases`` are in their normal form.
    """
    exact = {alias: canonical for _, alias, canonical in sorted(aliases)}
    if not exact:
        return df.withColumn(out, F.lit(None).cast("string"))
    table = F.create_map(*[F.lit(x) for pair in exact.items() for x in pair])
    by_title = F
    for alias, canonical in exact.items():
        by_title = by_title.when(F.contains(F.col("_text"), F.lit(alias)), F.lit(canonical))
    return (
        df.withColumns({"_name": match_key(name), "_text": F.lower(title)})
        .withColumn(out, F.coalesce(F.try_element_at(table, F.col("_name")), by_title))
        .drop("_name", "_text")
    )


def exact_alias(df: DataFrame, aliases: DataFrame, name: str, out: str = "canonical") -> DataFrame:
    """Canonical name by equality of trimmed lower-case name and alias.

    ``aliases`` must be materialised; it is broadcast only when measured small.
    """
    right = normal_aliases(aliases).select(F.col("alias").alias("_key"), F.col("canonical").alias(out))
    left = df.withColumn("_key", match_key(name))
    if is_small(aliases):
        return left.join(F.broadcast(right), "_key", "left").drop("_key")
    return left_join_spread_nulls(left, right, ["_key"], F.struct(*df.columns)).drop("_key")


def _grams(text: Column, n: int) -> Column:
    """Distinct substrings of length ``n``; none when the text is shorter."""
    starts = F.when(F.length(text) >= n, F.sequence(F.lit(1), F.length(text) - (n - 1)))
    return F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, n)))


def _file_under(n: int) -> Column:
    """Whether an alias belongs to the class of ``n``-character pieces."""
    return F.length("alias") >= GRAM if n == GRAM else F.length("alias") == n


def _matches_of_class(texts: DataFrame, text: str, aliases: DataFrame, broadcast: bool, n: int) -> DataFrame:
    """Matches of one length class. Shorter aliases are pieces themselves; of a longer one
    the piece that is rarest in the dictionary is looked up, and the hit verified."""
    looked_up = texts.withColumn("gram", F.explode(_grams(F.col(text), n)))
    own = aliases.where(_file_under(n))
    if n < GRAM:
        anchors = own.withColumn("gram", F.col("alias"))
    else:
        pieces = own.withColumn("gram", F.explode(_grams(F.col("alias"), n)))
        rarity = pieces.groupBy("gram").agg(F.count("*").alias("uses"))
        anchors = (
            pieces.join(rarity, "gram")
            .groupBy("priority", "alias", "canonical")
            .agg(F.min_by("gram", F.struct("uses", "gram")).alias("gram"))
        )
    hits = looked_up.join(F.broadcast(anchors) if broadcast else anchors, "gram")
    if n == GRAM:
        hits = hits.where(F.contains(F.col(text), F.col("alias")))
    return hits.select(text, "priority", "alias", "canonical")


def substring_matches(texts: DataFrame, text: str, aliases: DataFrame, broadcast: bool) -> DataFrame:
    """(text, priority, alias, canonical) for every alias contained in a text.

    An equi-join on pieces of the text instead of comparing all pairs. Aliases are filed by
    length, so one short alias does not shorten the pieces of the others; texts are only
    cut into pieces of the lengths that occur, at most GRAM of them. ``aliases`` are in
    their normal form.
    """
    least = F.least(F.length("alias"), F.lit(GRAM))
    classes = sorted(r[0] for r in aliases.select(least).distinct().collect())
    found = [_matches_of_class(texts, text, aliases, broadcast, n) for n in classes]
    if not found:
        return texts.join(aliases, F.lit(False)).select(text, "priority", "alias", "canonical")
    return reduce(DataFrame.unionByName, found)


def substring_alias(df: DataFrame, aliases: DataFrame, title: str, out: str = "canonical") -> DataFrame:
    """The canonical name of the first alias, by priority, contained in the title.

    Each distinct title is resolved once, however many copies it has; the answers are written,
    measured, and joined back, by broadcast where they are small. Of a table larger than that
    only the rows with a title are shuffled. ``aliases`` must be materialised; ``df`` is read
    twice. Works for a dictionary of any size.
    """
    aliases = materialise(normal_aliases(aliases))
    left = df.withColumn("_text", F.lower(title))
    texts = left.select("_text").where(F.col("_text").isNotNull()).distinct()
    best = write_table(
        substring_matches(texts, "_text", aliases, is_small(aliases))
        .groupBy("_text")
        .agg(F.min_by("canonical", "priority").alias(out)),
        "titles",
    )
    if is_small(best):
        return left.join(F.broadcast(best), "_text", "left").drop("_text")
    # Rows without a title to look up stay where they are.
    asked, other = left.where(F.col("_text").isNotNull()), left.where(F.col("_text").isNull())
    found = asked.join(best, "_text", "left").select(*df.columns, out)
    return found.unionByName(other.select(*df.columns, F.lit(None).cast("string").alias(out)))


def resolve_entities(
    df: DataFrame,
    aliases: DataFrame,
    name: str = "fighter_name",
    title: str = "listing_title",
    out: str = "fighter_name_canonical",
    inline: int = INLINE_ALIASES,
) -> DataFrame:
    """P4 for a dictionary held in a table (priority, alias, canonical).

    A small dictionary becomes literals of one map-only expression; a larger one is
    joined: by equality on the name, then by substring on the titles still unresolved. Both
    read the same normal form, so the size of the dictionary does not change an answer. ``df``
    is read twice for a dictionary that is joined by broadcast, and should be cheap to read.
    """
    aliases = materialise(normal_aliases(aliases))
    head = aliases.limit(inline + 1).collect()
    if len(head) <= inline:
        return resolve_inline(df, name, title, [tuple(r) for r in head], out)
    named = exact_alias(df, aliases, name, "_by_name")
    if not is_small(aliases):  # the titles still open and the join back read the named rows
        named = write_table(named, "named")
    open_title = named.withColumn("_title", F.when(F.col("_by_name").isNull(), F.col(title)))
    both = substring_alias(open_title, aliases, "_title", "_by_title")
    return both.withColumn(out, F.coalesce("_by_name", "_by_title")).select(*df.columns, out)


def resolve_fixed(
    df: DataFrame,
    name: str = "fighter_name",
    title: str = "listing_title",
    out: str = "fighter_name_canonical",
    aliases: Sequence[tuple[int, str, str]] | None = None,
) -> DataFrame:
    """P4 with the built-in dictionary."""
    return resolve_inline(df, name, title, alias_rows() if aliases is None else normal_rows(aliases), out)


def resolve_dim(df: DataFrame, entities: DataFrame, name: str = "fighter_name") -> DataFrame:
    """J2 against the entity dimension: key, sport and nationality by alias.

    The dimension's canonical name replaces the row's own where an alias matched.
    ``entities`` must be materialised, one row per alias.
    """
    right = entities.select(
        match_key("fighter_name_alias").alias("_key"),
        "fighter_id",
        F.col("fighter_name_canonical").alias("_canonical"),
        F.col("sport").alias("fighter_sport"),
        "nationality",
    )
    left = df.withColumn("_key", match_key(name))
    if is_small(right):
        joined = left.join(F.broadcast(right), "_key", "left")
    else:
        joined = left_join_spread_nulls(left, right, ["_key"], F.struct(*df.columns))
    return joined.withColumn(
        "fighter_name_canonical", F.coalesce("_canonical", "fighter_name_canonical")
    ).drop("_key", "_canonical")
