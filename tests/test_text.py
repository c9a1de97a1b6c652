import datetime as dt
from decimal import Decimal
from html.entities import html5

import pytest
from pyspark.sql import functions as F

from hammerline.functions import dates
from hammerline.functions import sales as fs
from hammerline.functions import text as tx
from hammerline.operators.measured import measure
from hammerline.session import write_table


def evaluate(spark, values, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r["o"] for r in df.select("i", expr(F.col("v")).alias("o")).orderBy("i").collect()]


def test_title_case(spark):
    given = ["  conor mcgregor  ", "sean o'malley", "x-y", "  ", "", None, "ÉMILE zola", "\tJON  JONES\n"]
    wanted = ["Conor Mcgregor", "Sean O'Malley", "X-Y", None, None, None, "Émile Zola", "Jon  Jones"]
    assert evaluate(spark, given, tx.title_case) == wanted


@pytest.mark.parametrize(
    "title, wanted",
    [
        ("UFC psa10 x", ("PSA 10", "PSA", 10.0)),
        ("card BGS 9.5 mint", ("BGS 9.5", "BGS", 9.5)),
        ("PSA 10.5", ("PSA 10", "PSA", 10.0)),
        ("sgc   7", ("SGC 7", "SGC", 7.0)),
        ("card raw", ("Raw", "Raw", None)),
        ("RAW psa 3", ("PSA 3", "PSA", 3.0)),
        ("drawn", (None, None, None)),
        ("PSA 11", (None, None, None)),
        ("PSA 0", (None, None, None)),
        ("", (None, None, None)),
        (None, (None, None, None)),
    ],
)
def test_grade_from_title(spark, title, wanted):
    [got] = evaluate(spark, [title], tx.grade_from_title)
    assert tuple(got) == wanted


def test_price_from_text(spark):
    given = ["$1,234.50", "US $99", "n/a", "", None, "1.2.3", ".", "0.01", "12 to 15"]
    wanted = [Decimal("1234.50"), Decimal("99.00"), None, None, None, None, None, Decimal("0.01"), Decimal("1215.00")]
    assert evaluate(spark, given, tx.price_from_text) == wanted


def test_html_text(spark):
    given = ["a &amp;lt; b", "&#233;&#xE9;&#x1F600;", "&#0;&#xD800;&#1114112;", "<b>x</b> &eacute;&rsquo;&nbsp;", "&#12", "&amp;#233;", None]
    wanted = ["a &lt; b", "éé😀", "\ufffd\ufffd\ufffd", "x é’", "&#12", "&#233;", None]
    assert evaluate(spark, given, tx.html_text) == wanted


def test_every_named_reference(spark):
    given = ["&oslash;&aring;&Aacute;&scaron;", "&#38;lt; &amp;amp; &nosuchname; &NotEqualTilde;x", "a&copy=1&amp;b"]
    wanted = ["øåÁš", "&lt; &amp; &nosuchname; \u2242\u0338x", "a&copy=1&b"]
    assert evaluate(spark, given, tx.html_text) == wanted
    names = sorted(n for n in html5 if n.endswith(";"))
    assert evaluate(spark, [f".&{n}." for n in names], tx.html_text) == [f".{html5[n]}." for n in names]


def test_unicode_blanks(spark):
    assert evaluate(spark, ["\u00a0Name\u3000", "\x85a b\u2009"], tx.match_key) == ["name", "a b"]
    grades = evaluate(spark, ["PSA\u00a010", "bgs\u20099.5"], lambda c: tx.grade_from_title(c)["grade"])
    assert grades == ["PSA 10", "BGS 9.5"]


def test_date_from_text(spark):
    day = dt.date(2026, 5, 31)
    given = [
        "2026-05-31",
        "2026-05-31T23:59:59Z",
        "2026-05-31T23:59:59.000+02:00",
        "Sold May 31, 2026",
        "Sold on May 31, 2026 in Buy Now",
        "Sun 31 May 2026",
        "5/31/2026",
        "may 31st, 2026",
    ]
    assert evaluate(spark, given, tx.date_from_text) == [day] * len(given)
    assert evaluate(spark, ["", None, "soon", "13/45/2026", "Feb 30, 2026"], tx.date_from_text) == [None] * 5
    day = dt.date(2024, 6, 1)
    given = ["6/1/24", "06.01.2024", "2024/06/01", "2024.6.1", "01-Jun-24", "1-Jun-2024", "Jun-01-2024", "June 1st, 2024",
             "Sold Jun 1, 24", "06-01-24", "ended Jun 2024"]
    assert evaluate(spark, given, tx.date_from_text) == [day] * len(given)
    assert evaluate(spark, ["13.6.2024", "31/12/99", "Jun 1 12:30"], tx.date_from_text) == [dt.date(2024, 6, 13), dt.date(1999, 12, 31), None]
    today = F.lit(dt.date(2026, 1, 1))
    assert evaluate(spark, ["soon"], lambda c: tx.date_from_text(c, today)) == [dt.date(2026, 1, 1)]


def test_cert_numbers(spark):
    given = [
        "PSA 10 cert #0123456",
        "12345678",
        "123456789",
        "certificate: 1234567890",
        "a 12345678 b 12345678 c 87654321",
        "cert 00000000",
        "cert 12345",
        "PSAcert:555666",
        "x" * 5000 + " 13572468",
        None,
    ]
    wanted = [
        ["123456"],
        ["12345678"],
        [],
        ["123456789"],
        ["12345678", "87654321"],
        ["0"],
        [],
        ["555666"],
        ["13572468"],
        None,
    ]
    assert evaluate(spark, given, tx.cert_numbers) == wanted


def test_sold_line(spark):
    got = evaluate(
        spark,
        [
            "Sold on May 31, 2026 in Buy Now",
            "Sold on May 31, 2026 in Weekly Auction",
            "Sold on May 31, 2026 in Premier",
            "Sold on May 31, 2026 in Elsewhere",
            "Listed",
        ],
        tx.sold_line,
    )
    day = dt.date(2026, 5, 31)
    assert [tuple(g) for g in got] == [
        (day, "buy_it_now"),
        (day, "auction"),
        (day, "auction"),
        (day, "buy_it_now"),
        (None, "buy_it_now"),
    ]


def test_url_ids(spark):
    urls = ["https://www.x.com/itm/123456?hash=9", "https://x.com/a/itm/b/itm/77", "https://x.com/12345678901234567890"]
    assert evaluate(spark, urls, tx.item_id_from_url) == ["123456", "77", "12345678901234567890"]
    assert evaluate(spark, ["/slab/view/99/", "https://y/p/uuid-1"], tx.last_path_segment) == ["99", "uuid-1"]


def test_first_number(spark):
    assert evaluate(spark, ["GEM MT 10", "NM 7.5", "none", "", None], tx.first_number) == [10.0, 7.5, None, None, None]


def test_record_hash(spark):
    df = spark.createDataFrame([("abc123", "ebay")], "listing_id string, source string")
    [row] = df.select(fs.record_hash().alias("h")).collect()
    assert row["h"] == "25eca1e35a1e5881e8150ebd0f1571ff64e73839de092c63d176ad5452e9b5c5"


def test_surrogate_key_null_placeholder(spark):
    import hashlib

    df = spark.createDataFrame([("a", None, 3)], "x string, y string, z int")
    [row] = df.select(fs.surrogate_key("x", "y", "z").alias("k")).collect()
    assert row["k"] == hashlib.md5(b"a-_dbt_utils_surrogate_key_null_-3").hexdigest()


def test_divisions(spark):
    df = spark.createDataFrame([(10.0, 4.0), (1.0, 0.0), (1.0, None)], "a double, b double")
    rows = df.select(fs.safe_divide("a", "b").alias("d"), fs.pct_deviation(F.col("a"), F.col("b")).alias("p")).collect()
    assert [tuple(r) for r in rows] == [(2.5, 150.0), (None, None), (None, None)]


def test_sale_type_and_premium(spark):
    assert evaluate(spark, ["auction", "buy_it_now", "best_offer", "other", None], fs.normalised_sale_type) == [
        "AUCTION",
        "BUY_IT_NOW",
        "BUY_IT_NOW",
        "UNKNOWN",
        "UNKNOWN",
    ]
    assert evaluate(spark, ["pwcc", "myslabs", "ebay", None], fs.stage_premium) == [True, False, False, False]


def test_sport(spark):
    df = spark.createDataFrame(
        [("2023 Prizm UFC", None), ("2023 Prizm", "X"), ("", "PFL star"), (None, None), ("Topps", "Chrome")],
        "card_set string, name string",
    )
    got = [r[0] for r in df.select(fs.sport("card_set", "name")).collect()]
    assert got == ["MMA", "BOXING", "MMA", "UNKNOWN", "BOXING"]


def test_epoch_is_independent_of_session_zone(spark):
    df = spark.createDataFrame([(dt.date(1970, 1, 2),)], "d date")
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        assert df.select(fs.epoch_seconds("d")).first()[0] == 86400
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def readings(spark, given, **options):
    return [(r["date"], r["how"]) for r in evaluate(spark, given, lambda c: dates.read_date(c, **options))]


def test_date_grammar(spark):
    day = dt.date(2026, 5, 31)
    given = [
        "2026-05-31", "2026-05-31T23:59:59Z", "2026-05-31T23:59:59.000+02:00", "Sold May 31, 2026", "Sold on May 31, 2026 in Buy Now",
        "Sun 31 May 2026", "5/31/2026", "may 31st, 2026", "31.5.26", "the 31st of May 2026, 10:30 a.m.", "2026 May 31",
        "Lot 12: $1,200.00 | sold Sunday, 31-MAY-26 at 9:05 PM (id 1234567)", "31 2026 may",
    ]
    assert readings(spark, given) == [(day, "read")] * len(given)
    first = dt.date(2024, 6, 1)
    given = ["2024/06/01", "2024.6.1", "01-Jun-24", "Jun-01-2024", "June 1st, 2024", "Sold Jun 1, 24", "ended Jun 2024", "sept", "2024 june"]
    want = [(first, "read")] * 7 + [(None, "unread"), (first, "read")]
    assert readings(spark, given) == want
    unread = ["soon", "13/45/2026", "Feb 30, 2026", "Jun 1 12:30", "12:30", "$12.50", "123 4567 89", "in 2024", "May"]
    assert readings(spark, unread) == [(None, "unread")] * len(unread)
    assert readings(spark, ["", None, "  "]) == [(None, "blank")] * 3


def test_ambiguous_dates(spark):
    given = ["6/1/24", "06.01.2024", "06-01-24", "6/6/2024", "13.6.2024", "31/12/99"]
    how = ["ambiguous"] * 3 + ["read"] * 3
    june, sixth = dt.date(2024, 6, 1), dt.date(2024, 1, 6)
    rest = [dt.date(2024, 6, 6), dt.date(2024, 6, 13), dt.date(1999, 12, 31)]
    assert readings(spark, given) == list(zip([june] * 3 + rest, how))
    assert readings(spark, given, month_first=False) == list(zip([sixth] * 3 + rest, how))


def test_readings_are_counted_while_writing(spark):
    texts = ["May 31, 2026", "6/1/24", "soon", "", None, "5/31/2026"]
    df = spark.createDataFrame([(x,) for x in texts], "raw string").withColumn("found", dates.read_date("raw"))
    rows, taken = measure(df, dates.reading_counts(F.col("found.how")))
    write_table(rows, "dates")
    assert taken.counts() == {"rows": 6, "read": 2, "ambiguous": 1, "unread": 1, "blank": 2}
