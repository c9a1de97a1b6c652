"""License phrases and notices, by diagonal voting of word k-grams.

The hashes of all rolling word k-grams of all texts are joined to the positions of the same
grams in the templates. A hit at word i of a text and word j of a template votes for the diagonal
i - j: a copy of the template puts all its votes on one diagonal, and a copy with words put in or
left out on a few neighbouring ones. Votes are counted per text, template and diagonal, hits being
gathered in each task first. Diagonals of a notice at most ``SHIFT`` apart are merged.

Merged spans are then verified word by word: a word of the template counts if the text has it on
one of the span's diagonals, inside the span. Short templates must be there whole and on one
diagonal, notices with ``LEAST_SHARE`` of their words. Only texts that have a span come back for
that: a bounded bitmap of their keys lets all others pass.

Templates are a parameter of at most ``MOST_WORDS`` words, which bounds their broadcast. Rows are
known by a digest of id and text, so a lost executor changes nothing; equal rows have equal
results.

All expressions are SQL functions. Defined cases: NULL text is the empty text; words are runs of
ASCII letters and digits and all letters beyond ASCII, A-Z lower-cased; places may overlap;
repeated rows and NULL ids are documents of their own; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hammerline.llm.exact_dedup import filter_bits, probe, repeated_pages
from hammerline.llm.license_texts import BASE, NAMES, NOTICES
from hammerline.llm.texts import filled, lower_ascii
from hammerline.session import write_table

# Runs of anything but the ASCII characters other than 0-9 and a-z. Java looks a class of single
# characters up in a table and tries ranges one by one, so they are listed.
WORD = "[^" + "".join(f"\\x{c:02X}" for c in range(128) if chr(c) not in string.digits + string.ascii_lowercase) + "]+"
# Words of a gram, for templates shorter than LONG words and for the others.
SHORT_GRAM, LONG_GRAM, LONG = 2, 4, 8
SHIFT, LEAST_VOTES, LEAST_SHARE = 8, 2, 0.8
MOST_WORDS = 50_000

Template = tuple[str, str]


def words_of(text: Column) -> Column:
    return F.regexp_extract_all(lower_ascii(text), F.lit(WORD), F.lit(0))


def _grams(numbers: str, size: int) -> Column:
    """array of (at, size, gram): the hash of every ``size`` consecutive words."""
    each = F.transform(
        F.col(numbers),
        lambda first, at: F.struct(
            at.alias("at"),
            F.lit(size).alias("size"),
            F.xxhash64(first, *(F.get(F.col(numbers), at + n) for n in range(1, size))).alias("gram"),
        ),
    )
    return F.slice(each, F.lit(1), F.greatest(F.size(numbers) - (size - 1), F.lit(0)))


def _hashed(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def template_table(spark: SparkSession, base: Sequence[Template], others: Sequence[Template]) -> DataFrame:
    """(template, label, is_base, words, m, size): templates numbered as listed.

    Templates of fewer than two words have no gram and are refused, as are too many words.
    """
    listed = [(*t, True) for t in base] + [(*t, False) for t in others]
    if sum(len(text) // 2 for _, text, _ in listed) > 20 * MOST_WORDS:
        raise ValueError(f"templates are to have at most {MOST_WORDS} words")
    one = [
        F.struct(F.lit(n).alias("template"), F.lit(label).alias("label"), F.lit(first).alias("is_base"), F.lit(text).alias("text"))
        for n, (label, text, first) in enumerate(listed)
    ]
    table = spark.range(1).select(F.inline(F.array(*one))).withColumn("words", words_of(F.col("text"))).drop("text")
    table = table.withColumn("m", F.size("words"))
    total = table.agg(F.sum("m").alias("words"), F.min("m").alias("least")).first()
    if total["words"] > MOST_WORDS or total["least"] < 2:
        raise ValueError(f"templates are to have two words or more each and at most {MOST_WORDS} in all")
    return table.withColumn("size", F.when((F.col("m") < LONG) | F.col("is_base"), SHORT_GRAM).otherwise(LONG_GRAM))


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, key, text): the key is a strong digest of id and text, NULL ids apart from all others."""
    name = F.coalesce(F.concat(F.lit("="), F.col(id_col).cast("string"), F.lit(" ")), F.lit("- "))
    text = filled(text_col)
    return docs.select(F.col(id_col).alias("id"), F.unhex(F.sha2(F.concat(name, text), 256)).alias("key"), text.alias("text"))


def votes(rows: DataFrame, templates: DataFrame) -> DataFrame:
    """(key, template, diagonal, at): the template positions that vote for each diagonal."""
    places = templates.withColumn("numbers", _hashed(F.col("words")))
    grams = F.when(F.col("size") == SHORT_GRAM, _grams("numbers", SHORT_GRAM)).otherwise(_grams("numbers", LONG_GRAM))
    places = places.select("template", F.inline(grams)).withColumnRenamed("at", "j")
    texts = rows.select("key", _hashed(words_of(F.col("text"))).alias("numbers"))
    both = F.concat(_grams("numbers", SHORT_GRAM), _grams("numbers", LONG_GRAM))
    hits = texts.select("key", F.inline(both)).join(F.broadcast(places), ["gram", "size"])
    return hits.groupBy("key", "template", (F.col("at") - F.col("j")).alias("diagonal")).agg(
        F.sort_array(F.collect_set("j")).alias("at")
    )


def spans(voted: DataFrame, templates: DataFrame) -> DataFrame:
    """(key, template, diagonals, start, end): whole short templates, merged diagonals of notices."""
    known = voted.join(F.broadcast(templates.select("template", "m", "size")), "template")
    known = known.withColumns(
        {"start": F.col("diagonal") + F.col("at")[0], "end": F.col("diagonal") + F.element_at("at", -1) + F.col("size")}
    )
    short = known.where((F.col("size") == SHORT_GRAM) & (F.size("at") == F.col("m") - SHORT_GRAM + 1))
    short = short.select("key", "template", F.array("diagonal").alias("diagonals"), "start", "end")
    long = known.where((F.col("size") != SHORT_GRAM) & (F.size("at") >= LEAST_VOTES))
    order = Window.partitionBy("key", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(order) > SHIFT, F.lit(True))
    long = long.withColumn("apart", apart.cast("int")).withColumn("merged", F.sum("apart").over(order))
    long = long.groupBy("key", "template", "merged").agg(
        F.sort_array(F.collect_list("diagonal")).alias("diagonals"), F.min("start").alias("start"), F.max("end").alias("end")
    )
    return short.unionByName(long.drop("merged"))


def verified(rows: DataFrame, found: DataFrame, base: Sequence[Template], others: Sequence[Template]) -> DataFrame:
    """(key, spans): start, length, label, is_base, share and whole, read word by word.

    The share is of the template's words that stand on one of the span's diagonals.
    """
    bits = filter_bits(found.count())
    pages = write_table(repeated_pages(found.select("key").distinct(), "key", bits, least=1), "pages")
    texts = probe(rows.select("key", "text"), pages, "key", bits).where("maybe").dropDuplicates(["key"])
    gathered = found.groupBy("key").agg(F.collect_list(F.struct("template", "diagonals", "start", "end")).alias("spans"))
    gathered = write_table(gathered, "spans")
    texts = texts.join(gathered, "key").select("key", words_of(F.col("text")).alias("words"), "spans")
    # The templates as one constant, in the order of their numbers.
    listed = F.array(
        *(
            F.struct(F.lit(label).alias("label"), F.lit(n < len(base)).alias("is_base"), words_of(F.lit(text)).alias("own"))
            for n, (label, text) in enumerate((*base, *others))
        )
    )

    def read(span: Column) -> Column:
        template = F.get(listed, span["template"])
        stands = F.filter(
            F.sequence(F.lit(0), F.size(template["own"]) - 1),
            lambda j: F.exists(
                span["diagonals"],
                lambda d: (d + j >= span["start"]) & (d + j < span["end"]) & (F.get(F.col("words"), d + j) == F.get(template["own"], j)),
            ),
        )
        return F.struct(
            span["start"].cast("long").alias("start"),
            (span["end"] - span["start"]).cast("long").alias("length"),
            template["label"].alias("label"),
            template["is_base"].alias("is_base"),
            (F.size(stands) / F.size(template["own"])).alias("share"),
            (template["is_base"] | (F.size(template["own"]) < LONG)).alias("whole"),
        )

    return texts.select("key", F.transform("spans", read).alias("spans"))


def find_licenses(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    base: Sequence[Template] = BASE,
    others: Sequence[Template] = (*NAMES, *NOTICES),
) -> DataFrame:
    """One row per document: id, n_words, and ``spans`` (start, length, label, is_base, share, whole)
    in order of start: words from 0, the share of the template that was read there.

    ``whole`` spans are findings with a share of 1, others from LEAST_SHARE on; those below
    are kept for the score.
    """
    templates = write_table(template_table(docs.sparkSession, base, others).coalesce(1), "templates")
    rows = keyed(docs, id_col, text_col)
    narrow = write_table(
        rows.select("id", "key", F.regexp_count(lower_ascii(F.col("text")), F.lit(WORD)).cast("long").alias("n_words")), "words"
    )
    found = write_table(spans(write_table(votes(rows, templates), "votes"), templates), "found")
    read = write_table(verified(rows, found, base, others), "verified")
    none = F.array().cast(read.schema["spans"].dataType)
    joined = narrow.join(read, "key", "left")
    return joined.select(F.col("id").alias(id_col), "n_words", F.sort_array(F.coalesce("spans", none)).alias("spans"))


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, the base places, all labels, and the greatest share."""
    found = find_licenses(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["is_base"] & (s["share"] == 1))
    good = F.filter("spans", lambda s: s["share"] >= F.when(s["whole"], F.lit(1.0)).otherwise(F.lit(LEAST_SHARE)))
    starts = F.transform(base, lambda s: s["start"])

    def labels(which: Column) -> Column:
        return F.array_join(F.sort_array(F.array_distinct(F.transform(which, lambda s: s["label"]))), ",")

    return found.select(
        id_col,
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        labels(base).alias("base_labels"),
        labels(good).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"),
    )
