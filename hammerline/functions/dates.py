"""Dates in free text by a grammar of tokens (P14), telling what could not be read.

A text is cut into tokens, each of a class: a year of four digits (Y), a number of one or two
digits (N), a month's name (M), or anything else (x). Ordinal endings, weekday names, "of" and "the"
are left out; times of day, amounts of money and longer numbers are no tokens of a date. The classes
make one word, in which the orders of a table are looked up: so a new spelling is a row of the
table, and punctuation, case and language of the words around don't matter.

Everything is SQL functions over the tokens of one text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The months as they begin, and words that a date may hold besides.
MONTHS = "jan feb mar apr may jun jul aug sep oct nov dec".split()
FULL_MONTHS = "january february march april may june july august september october november december".split()
WEEKDAYS = "monday tuesday wednesday thursday friday saturday sunday".split()
FILLERS = [
    *"st nd rd th of the".split(), "tues", "thur", "thurs", *WEEKDAYS, *(d[:3] for d in WEEKDAYS),
]
# Orders of token classes, the surest first: the class word, and where year, month and day stand
# (-1: none, the first of the month). A word may have several readings, tried in turn.
ORDERS = (
    ("YNN", 0, 1, 2),
    ("YMN", 0, 1, 2),
    ("MNY", 2, 0, 1),
    ("NMY", 2, 1, 0),
    ("NNY", 2, 0, 1),
    ("NNY", 2, 1, 0),
    ("NYM", 1, 2, 0),
    ("MNN", 2, 0, 1),
    ("NMN", 2, 1, 0),
    ("NNN", 2, 0, 1),
    ("NNN", 2, 1, 0),
    ("MY", 1, 0, -1),
    ("YM", 0, 1, -1),
)
# Not tokens: times of day with their zone, amounts with a currency, numbers of five digits or more.
NOISE = (
    r"(?i)t?\b\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:\s*[ap]\.?m\b\.?|z\b|\s*[+-]\d{2}:?\d{2})?|t\d{1,2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:z|[+-]\d{2}:?\d{2})?"
    r"|[$€£¥]\s*\d[\d,.]*|\d[\d,]*\.\d{2}\s*(?:usd|eur|gbp)\b|\d{5,}|\b\d{3}\b"
)
TOKEN = r"\d{4}|\d{1,2}|\p{L}+|[^\s\d\p{L},./'()\[\]-]"
CENTURY_FROM = 70
READ, AMBIGUOUS, UNREAD, BLANK = "read", "ambiguous", "unread", "blank"


def _classified(raw: Column) -> Column:
    """array of (text, class) of the tokens that count."""
    cleaned = F.regexp_replace(F.lower(raw), NOISE, " | ")
    words = F.regexp_extract_all(cleaned, F.lit(TOKEN), F.lit(0))
    kept = F.filter(words, lambda w: ~w.isin(FILLERS))
    names = list(dict.fromkeys([*MONTHS, *FULL_MONTHS, "sept"]))
    kind = lambda w: (
        F.when(w.isin(names), "M")
        .when(w.rlike(r"^(?:19|20)\d{2}$"), "Y")
        .when(w.rlike(r"^\d{1,2}$"), "N")
        .otherwise("x")
    )
    return F.transform(kept, lambda w: F.struct(w.alias("text"), kind(w).alias("kind")))


def _year(text: Column) -> Column:
    number = text.cast("int")
    return F.when(F.length(text) > 2, number).otherwise(number + F.when(number < CENTURY_FROM, 2000).otherwise(1900))


def _month(token: Column) -> Column:
    """The number of a month given by name or number."""
    name = F.substring(token["text"], 1, 3)
    position = F.array_position(F.array(*map(F.lit, MONTHS)), name).cast("int")
    return F.when(token["kind"] == "M", position).otherwise(token["text"].try_cast("int"))


def read_date(raw: Column | str, month_first: bool = True) -> Column:
    """struct(date, how): the date of the surest order found in the text, and whether it was
    ``read``, is ``ambiguous`` (another order of two numbers is a different date), could not be
    read (``unread``), or the text is ``blank``.

    Of two numbers the month comes first, or the day with ``month_first=False``; only the order
    that makes a date counts where there is one.
    """
    raw = F.col(raw) if isinstance(raw, str) else raw
    orders = list(ORDERS)
    if not month_first:
        for word in ("NNY", "NNN"):
            a, b = (i for i, o in enumerate(orders) if o[0] == word)
            orders[a], orders[b] = orders[b], orders[a]

    def readings(text: Column) -> Column:
        tokens, word = text["tokens"], text["word"]

        def one(order: tuple[str, int, int, int]) -> Column:
            pattern, year, month, day = order
            at = F.locate(pattern, word)
            token = lambda place: F.get(tokens, at - 1 + place)
            number = F.lit(1) if day < 0 else token(day)["text"].try_cast("int")
            text = F.concat_ws("-", _year(token(year)["text"]), _month(token(month)), number)
            return F.when(at > 0, F.struct(F.lit(pattern).alias("order"), F.try_to_timestamp(text, F.lit("y-M-d")).cast("date").alias("date")))

        return F.filter(F.array(*map(one, orders)), lambda r: r.isNotNull() & r["date"].isNotNull())

    # One-element arrays bind what is used more than once.
    classed = F.transform(
        F.array(_classified(raw)),
        lambda ts: F.struct(ts.alias("tokens"), F.array_join(F.transform(ts, lambda t: t["kind"]), "").alias("word")),
    )
    found = F.transform(classed, readings)[0]
    return F.transform(
        F.array(found),
        lambda all_: F.struct(
            F.get(all_, F.lit(0))["date"].alias("date"),
            F.when(F.trim(F.coalesce(raw, F.lit(""))) == "", BLANK)
            .when(F.size(all_) == 0, UNREAD)
            .when(
                F.exists(
                    all_,
                    lambda r: (r["order"] == F.get(all_, F.lit(0))["order"]) & (r["date"] != F.get(all_, F.lit(0))["date"]),
                ),
                AMBIGUOUS,
            )
            .otherwise(READ)
            .alias("how"),
        ),
    )[0]


def reading_counts(how: Column) -> dict[str, Column]:
    """Conditions by name, for :func:`hammerline.operators.measured.measure`: how texts were read."""
    return {name: how == name for name in (READ, AMBIGUOUS, UNREAD, BLANK)}
