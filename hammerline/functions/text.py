"""Text expressions (inventory P12-P20)."""

from __future__ import annotations

from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.schemas import PRICE

# Everything Unicode calls white space, and the four ASCII separators.
WHITESPACE = (
    " \t\n\r\f\x0b\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: Column) -> Column:
    return F.when(c != "", c)


def strip(c: Column | str) -> Column:
    """Trim every kind of whitespace, not only spaces."""
    return F.btrim(_col(c), F.lit(WHITESPACE))


def match_key(c: Column | str) -> Column:
    """The form names and aliases are compared in."""
    return F.lower(strip(c))


def title_case(c: Column | str) -> Column:
    """Trim and capitalise each run of letters; blank becomes NULL.

    ``initcap`` alone only capitalises after whitespace, so "o'malley" is cut into
    letter runs and separators first.
    """
    runs = F.regexp_extract_all(strip(c), F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return blank_to_null(F.concat_ws("", F.transform(runs, F.initcap)))


def grade_from_title(title: Column | str) -> Column:
    """struct(grade, grader, grade_numeric) read from a listing title."""
    title = _col(title)
    grader = F.upper(F.regexp_extract(title, fixed.GRADE_PATTERN, 1))
    number = F.regexp_extract(title, fixed.GRADE_PATTERN, 2)
    graded = F.struct(
        F.concat_ws(" ", grader, number).alias("grade"),
        grader.alias("grader"),
        number.try_cast("double").alias("grade_numeric"),
    )
    raw = F.struct(
        F.lit("Raw").alias("grade"), F.lit("Raw").alias("grader"), F.lit(None).cast("double").alias("grade_numeric")
    )
    none = F.struct(
        F.lit(None).cast("string").alias("grade"),
        F.lit(None).cast("string").alias("grader"),
        F.lit(None).cast("double").alias("grade_numeric"),
    )
    return (
        F.when(title.rlike(fixed.GRADE_PATTERN), graded)
        .when(title.rlike(fixed.RAW_WORD_PATTERN), raw)
        .otherwise(none)
    )


def price_from_text(raw: Column | str) -> Column:
    """Keep digits and dots; NULL when nothing numeric is left."""
    return blank_to_null(F.regexp_replace(_col(raw), r"[^0-9.]", "")).try_cast(PRICE)


# The closed list of date spellings P14 reads, tried in this order: where the text has the
# year (y), the month (m), its name (n) and the day (d).
_MONTH = r"(?:jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)"
_YEAR = r"(\d{4}|\d{2})\b(?![:.]\d)"
DATE_SPELLINGS = [
    (r"\b(\d{4})[-/.](\d{1,2})[-/.](\d{1,2})", "ymd"),
    (rf"(?i)\b({_MONTH})[a-z]*\.?[\s-]+(\d{{1,2}})(?:st|nd|rd|th)?(?:,\s*|[\s-]+){_YEAR}", "ndy"),
    (rf"(?i)\b(\d{{1,2}})(?:st|nd|rd|th)?[\s-]+({_MONTH})[a-z]*\.?(?:,\s*|[\s-]+){_YEAR}", "dny"),
    (rf"\b(\d{{1,2}})/(\d{{1,2}})/{_YEAR}", "mdy"),
    (rf"\b(\d{{1,2}})\.(\d{{1,2}})\.{_YEAR}", "mdy"),
    (rf"\b(\d{{1,2}})-(\d{{1,2}})-{_YEAR}", "mdy"),
    (rf"(?i)\b({_MONTH})[a-z]*\.?,?\s+(\d{{4}})\b", "ny"),
]
# Two-digit years from here on belong to the last century.
CENTURY_FROM = "70"


def date_from_text(raw: Column | str, default: Column | None = None) -> Column:
    """The first spelling found anywhere in the text, else ``default``.

    Numbers are read month first, or day first where only that is a date. A month without a
    day is its first day.
    """
    raw = _col(raw)
    parsed = []
    for pattern, places in DATE_SPELLINGS:
        part = {place: F.regexp_extract(raw, pattern, i) for i, place in enumerate(places, 1)}
        century = F.when(part["y"] < CENTURY_FROM, "20").otherwise("19")
        year = F.when(F.length(part["y"]) == 2, F.concat(century, part["y"])).otherwise(part["y"])
        month, day = part.get("n", part.get("m")), part.get("d", F.lit("1"))
        layout = F.lit("MMM d yyyy" if "n" in part else "M d yyyy")
        orders = [(month, day), (day, month)] if places == "mdy" else [(month, day)]
        for first, second in orders:
            text = F.when(raw.rlike(pattern), F.concat_ws(" ", first, second, year))
            parsed.append(F.try_to_timestamp(text, layout).cast("date"))
    if default is not None:
        parsed.append(default)
    return F.coalesce(*parsed)


def first_number(raw: Column | str) -> Column:
    """The first number in a grade description."""
    return F.regexp_extract(_col(raw), fixed.NUMBER_PATTERN, 1).try_cast("double")


def strip_zeros(c: Column) -> Column:
    stripped = F.ltrim(c, F.lit("0"))
    return F.when(stripped == "", F.lit("0")).otherwise(stripped)


def cert_numbers(text: Column | str) -> Column:
    """Certificate numbers in order of appearance, without leading zeros."""
    hits = F.regexp_extract_all(_col(text), F.lit(fixed.CERT_PATTERN), F.lit(0))
    return F.array_distinct(F.transform(hits, lambda m: strip_zeros(F.regexp_extract(m, "([0-9]+)$", 1))))


def sold_line(line: Column | str) -> Column:
    """struct(sale_date, sale_type) of a "Sold on D in T" line."""
    line = _col(line)
    wording = F.lower(F.regexp_extract(line, fixed.SOLD_PATTERN, 2))
    kind = F.lit("buy_it_now")
    for key, value in reversed(fixed.SOLD_LINE_TYPES):
        kind = F.when(wording.contains(key), F.lit(value)).otherwise(kind)
    return F.struct(
        date_from_text(F.regexp_extract(line, fixed.SOLD_PATTERN, 1)).alias("sale_date"),
        kind.alias("sale_type"),
    )


def item_id_from_url(url: Column | str) -> Column:
    """P20: text after the last ``/itm/`` up to ``?``, else the last 20 characters."""
    url = _col(url)
    return F.when(
        url.contains("/itm/"), F.substring_index(F.substring_index(url, "/itm/", -1), "?", 1)
    ).otherwise(F.right(url, F.lit(20)))


def last_path_segment(url: Column | str) -> Column:
    """P20: the last segment of a path, ignoring trailing slashes."""
    return F.substring_index(F.rtrim(_col(url), F.lit("/")), "/", -1)


# --- fixed values: the usual named character references, looked up before HTML's full table ---
ENTITIES = [
    ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&apos;", "'"), ("&nbsp;", "\xa0"), ("&ndash;", "–"), ("&mdash;", "—"),
    ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"), ("&rdquo;", "”"), ("&hellip;", "…"), ("&bull;", "•"),
    ("&middot;", "·"), ("&copy;", "©"), ("&reg;", "®"), ("&trade;", "™"), ("&deg;", "°"), ("&frac12;", "½"),
    ("&times;", "×"), ("&euro;", "€"), ("&pound;", "£"), ("&cent;", "¢"), ("&yen;", "¥"), ("&agrave;", "à"),
    ("&aacute;", "á"), ("&acirc;", "â"), ("&atilde;", "ã"), ("&auml;", "ä"), ("&ccedil;", "ç"), ("&egrave;", "è"),
    ("&eacute;", "é"), ("&ecirc;", "ê"), ("&euml;", "ë"), ("&iacute;", "í"), ("&icirc;", "î"), ("&iuml;", "ï"),
    ("&ntilde;", "ñ"), ("&oacute;", "ó"), ("&ocirc;", "ô"), ("&otilde;", "õ"), ("&ouml;", "ö"), ("&uacute;", "ú"),
    ("&uuml;", "ü"), ("&szlig;", "ß"), ("&Eacute;", "É"), ("&Ouml;", "Ö"), ("&Uuml;", "Ü"), ("&Auml;", "Ä"),
    ("&amp;", "&"),
]
ALL_ENTITIES = sorted((f"&{name}", chars) for name, chars in html5.items() if name.endswith(";"))
REFERENCE = r"&(?:#(?:[xX][0-9a-fA-F]{1,6}|[0-9]{1,7})|[A-Za-z][A-Za-z0-9]{1,31});"


def _character(reference: Column) -> Column:
    """The character of a numeric reference; the replacement character if there is none."""
    digits = F.regexp_extract(reference, r"([0-9a-fA-F]+);", 1)
    point = F.when(F.lower(reference).startswith("&#x"), F.conv(digits, 16, 10)).otherwise(digits).cast("long")
    real = point.between(1, 0xD7FF) | point.between(0xE000, 0x10FFFF)
    return F.when(real, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise("\ufffd")


def _named(reference: Column) -> Column:
    """The characters of a named reference: the usual names first, then HTML's full table."""
    usual, full = (
        F.str_to_map(F.lit("\x01".join(f"{k}\x02{v}" for k, v in names)), F.lit("\x01"), F.lit("\x02"))
        for names in (ENTITIES, ALL_ENTITIES)
    )
    return F.coalesce(F.try_element_at(usual, reference), F.try_element_at(full, reference), reference)


def references(text: Column) -> Column:
    """The text with its character references decoded, each once; unknown ones and those without
    a semicolon stay as written."""
    between = F.split(text, REFERENCE, -1)
    found = F.transform(
        F.regexp_extract_all(text, F.lit(REFERENCE), F.lit(0)),
        lambda r: F.when(r.startswith("&#"), _character(r)).otherwise(_named(r)),
    )
    pairs = F.zip_with(between, found, lambda a, b: F.concat(a, F.coalesce(b, F.lit(""))))
    return F.when(text.rlike(REFERENCE), F.array_join(pairs, "")).otherwise(text)


def html_text(fragment: Column) -> Column:
    """Visible text of an HTML fragment: tags removed, character references decoded, trimmed."""
    return strip(references(F.regexp_replace(fragment, r"(?s)<[^>]*>", "")))
