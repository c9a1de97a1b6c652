"""Secrets in texts, and credentials whose parts stand apart.

Base kinds (assignments, access identifiers, long hexadecimal runs) are found by pattern. Three
weak kinds (named identifiers, opaque mixed tokens, endpoints) mean little alone: one is reported
only when its complementary parts lie within SCOPE code points of it. An identifier needs a
secret, a secret an identifier, an endpoint both. Base spans count as parts and always stay.

The interval join is done in order: spans are sorted by their start, and running extremes give
each span the nearest identifier and secret before and behind it, so the work stays in proportion
to the spans however many a text has. Texts are read once; what is kept of them are lengths.

All expressions are SQL functions. Defined cases: NULL text is the empty text; positions are code
points, ends exclusive; repeated rows and NULL ids are documents of their own; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hammerline.llm.texts import filled
from hammerline.session import write_table

SCOPE = 300
# The patterns of the base kinds, in their order.
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
LEAST_VALUE = 8
# The weak kinds: a named identifier, an opaque token of mixed letters and digits, an endpoint.
IDENTIFIER = r"""(?i:client|account|tenant|user|access[_-]?key)[_-]?(?i:id|name)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{4,}"""
TOKEN = r"""(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[A-Z])(?=[A-Za-z0-9+/_=-]*[a-z])(?=[A-Za-z0-9+/_=-]*[0-9])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])"""
ENDPOINT = r"""(?i:https?|s3|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqps?)://[^\x20\x09-\x0D"'<>]+"""
KINDS = {"assign": ASSIGN, "access": ACCESS, "hex": HEX, "identifier": IDENTIFIER, "secret": TOKEN, "endpoint": ENDPOINT}
BASE = ("assign", "access", "hex")
IDENTIFIES, HIDES = ("access", "identifier"), ("assign", "hex", "secret")


def _matches(text: Column, kind: str) -> Column:
    """array of (gap, size, ok): each match's distance from the one before, in code points.

    Between the matches lie the pieces of the text split by the same pattern, which gives
    positions without a position function. Failing matches use up their text, but are not ok.
    """
    pattern = KINDS[kind]
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.transform(F.split(text, pattern, -1), lambda piece: F.length(piece))
    sizes = F.transform(whole, lambda match: F.length(match))
    if kind == "assign":
        good = F.transform(F.regexp_extract_all(text, F.lit(pattern), F.lit(2)), lambda v: F.length(v) >= LEAST_VALUE)
    else:
        good = F.transform(whole, lambda _: F.lit(True))
    zipped = F.arrays_zip(F.slice(gaps, 1, F.size(sizes)).alias("gap"), sizes.alias("size"), good.alias("ok"))
    none = F.array().cast("array<struct<gap:int,size:int,ok:boolean>>")
    return F.when(F.regexp_like(text, F.lit(pattern)), zipped).otherwise(none)


def _among(kinds: tuple[str, ...]) -> Column:
    return F.col("kind").isin(*(list(KINDS).index(k) for k in kinds))


def _near(kinds: tuple[str, ...]) -> Column:
    """Whether a span of these kinds lies within the scope before or behind."""
    order = Window.partitionBy("row").orderBy("start", "kind")
    before = F.max(F.when(_among(kinds), F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.min(F.when(_among(kinds), F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    return F.coalesce(F.col("start") - before <= SCOPE, F.lit(False)) | F.coalesce(
        behind - F.col("end") <= SCOPE, F.lit(False)
    )


def link_parts(spans: DataFrame) -> DataFrame:
    """Base spans, and the weak ones that the interval join confirms.

    Spans are (row, start, end, kind), kinds numbered as listed. An identifier or opaque token
    that overlaps a base span is dropped first, so that it can't confirm another. Endpoints confirm
    nothing, so they stay, and base spans inside them are their parts.
    """
    order = Window.partitionBy("row").orderBy("start", "kind")
    base = _among(BASE)
    before = F.max(F.when(base, F.col("end"))).over(order.rowsBetween(Window.unboundedPreceding, -1))
    behind = F.min(F.when(base, F.col("start"))).over(order.rowsBetween(1, Window.unboundedFollowing))
    clear = F.coalesce(before <= F.col("start"), F.lit(True)) & F.coalesce(behind >= F.col("end"), F.lit(True))
    spans = spans.withColumn("clear", base | _among(("endpoint",)) | clear).where("clear").drop("clear")
    spans = spans.withColumns({"near_identifier": _near(IDENTIFIES), "near_secret": _near(HIDES)})
    confirmed = (
        (_among(("identifier",)) & F.col("near_secret"))
        | (_among(("secret",)) & F.col("near_identifier"))
        | (_among(("endpoint",)) & F.col("near_identifier") & F.col("near_secret"))
    )
    return spans.where(base | confirmed).select("row", "start", "end", "kind")


def spans_of(matched: DataFrame) -> DataFrame:
    """(row, start, end, kind) from the match arrays; starts are running sums of the gaps."""
    each = F.array(*(F.struct(F.lit(n).alias("kind"), F.col(k).alias("found")) for n, k in enumerate(KINDS)))
    parts = matched.select("row", F.explode(each).alias("of")).where(F.size("of.found") > 0)
    parts = parts.select("row", "of.kind", F.posexplode("of.found").alias("at", "m"))
    reached = F.sum(F.col("m.gap") + F.col("m.size")).over(
        Window.partitionBy("row", "kind").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    )
    parts = parts.withColumn("end", reached).where("m.ok")
    return parts.select("row", (F.col("end") - F.col("m.size")).alias("start"), "end", "kind")


def find_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id and ``spans``, an array of (start, kind, end, name) in order."""
    text = filled(text_col)
    matched = write_table(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id_col).alias("id"),
            *(_matches(text, kind).alias(kind) for kind in KINDS),
        ),
        "matches",
    )
    # A weak kind alone can confirm nothing: texts without a second kind keep base spans only.
    any_of = lambda kinds: reduce(lambda a, b: a | b, (F.size(k) > 0 for k in kinds))
    found = matched.where(any_of(BASE) | (any_of(IDENTIFIES) & any_of(HIDES)))
    linked = link_parts(spans_of(found))
    name = F.element_at(F.array(*(F.lit(k) for k in KINDS)), F.col("kind") + 1)
    grouped = linked.groupBy("row").agg(
        F.sort_array(F.collect_list(F.struct("start", "kind", "end", name.alias("name")))).alias("spans")
    )
    return (
        matched.select("row", "id")
        .join(grouped, "row", "left")
        .select(
            F.col("id").alias(id_col),
            F.coalesce("spans", F.array().cast(grouped.schema["spans"].dataType)).alias("spans"),
        )
    )


def listing(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["name"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def summary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, counts of the base kinds, digest of their listing, all spans."""
    found = find_spans(docs, id_col, text_col)
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(number: int) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == number)).cast("long").alias(f"n_{BASE[number]}")

    counts = [count(n) for n in range(len(BASE))]
    return found.select(id_col, *counts, F.sha2(listing(base), 256).alias("base_sha256"), listing(F.col("spans")).alias("spans"))


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """The text with every span replaced; overlapping spans become one mark."""
    pieces = F.aggregate(
        spans,
        F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out")),
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(
                s["start"] >= acc["at"],
                F.concat(acc["out"], F.substring(text, (acc["at"] + 1).cast("int"), (s["start"] - acc["at"]).cast("int")), F.lit(mark)),
            ).otherwise(acc["out"]).alias("out"),
        ),
    )
    return F.concat(pieces["out"], F.substring(text, (pieces["at"] + 1).cast("int"), F.length(text)))
