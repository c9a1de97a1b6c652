"""Outliers, entity resolution and rolling benchmarks against brute force."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from conftest import values
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.functions.sales import SECONDS_PER_DAY, epoch_seconds
from hammerline.operators import outliers, resolve, rolling

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


# --- outliers -----------------------------------------------------------------------------


def test_outliers_keep_null_groups(spark):
    rows = [("ebay", "PSA 10", float(p)) for p in (10, 11, 12, 13, 1000)] + [("ebay", None, 1.0), ("ebay", None, 9999.0)]
    df = spark.createDataFrame(rows, "source string, grade string, sale_price_usd double")
    flags = {(r["grade"], r["sale_price_usd"]): r["is_outlier"] for r in outliers.flag_outliers(df).collect()}
    assert flags.pop(("PSA 10", 1000.0)) is True
    assert not any(flags.values())
    assert outliers.flag_outliers(df).columns == [*df.columns, "is_outlier"]


def test_outliers_null_safe_option(spark):
    rows = [("ebay", None, float(p)) for p in (10, 11, 12, 13, 1000)]
    df = spark.createDataFrame(rows, "source string, grade string, sale_price_usd double")
    assert outliers.flag_outliers(df, null_safe=True).where("is_outlier").count() == 1


def test_outliers_by_shuffle_join_agree(spark, monkeypatch):
    rows = [(f"s{i % 3}", None if i % 7 == 0 else f"g{i % 4}", float(i % 50 if i % 91 else 5000)) for i in range(1000)]
    df = spark.createDataFrame(rows, "source string, grade string, sale_price_usd double")
    small = values(outliers.flag_outliers(df))
    monkeypatch.setattr(outliers, "is_small", lambda kept: False)
    assert values(outliers.flag_outliers(df)) == small


@pytest.mark.parametrize("accuracy", [5, 30, 10_000])
def test_quartiles_are_exact_beyond_the_sketch(spark, accuracy):
    """Whatever the sketch can tell apart, ties and NULL groups included."""
    rng = random.Random(7)
    rows = [("s", None if i % 5 == 0 else f"g{i % 3}", float(int(rng.paretovariate(1.2) * 20) / 4)) for i in range(3000)]
    rows += [("s", "flat", 1.0)] * 50 + [("s", "none", None), ("s", "one", 7.0)]
    df = spark.createDataFrame(rows, "source string, grade string, sale_price_usd double").repartition(6)
    got = {r["grade"]: (r["q1"], r["q3"]) for r in outliers.iqr_bounds(df, accuracy=accuracy).collect()}
    groups = {}
    for _, grade, price in rows:
        groups.setdefault(grade, []).extend([] if price is None else [price])
    for grade, prices in groups.items():
        prices.sort()
        at = [prices[max(1, -(-len(prices) * k // 4)) - 1] if prices else None for k in (1, 3)]
        assert got[grade] == tuple(at), grade
    sketch = outliers.iqr_bounds(df, accuracy=accuracy, exact=False)
    assert sketch.columns == outliers.iqr_bounds(df).columns


# --- resolution ---------------------------------------------------------------------------

PRIORITY = [(0, "conor mcgregor", "A"), (1, "mcgregor", "B"), (2, "volk", "C"), (3, "mighty mouse", "D"), (4, "ufc", "E")]


def brute(name, title, aliases):
    exact = {a: c for _, a, c in reversed(aliases)}
    if name is not None and name.strip().lower() in exact:
        return exact[name.strip().lower()]
    for _, alias, canonical in aliases:
        if title is not None and alias in title.lower():
            return canonical
    return None


CASES = [
    (" McGregor\t", "volk"),
    ("nobody", "Notorious MCGREGOR vs Volk"),
    (None, "conor mcgregor"),
    (None, "Volkswagen card"),
    (None, "ONE Mighty Mouse"),
    ("", "plain"),
    (None, None),
    ("volk", None),
    (None, "uf"),
] + [("nobody", "UFC hot title")] * 40


@pytest.mark.parametrize("inline", [256, 0])
def test_resolution_matches_brute_force(spark, inline):
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(CASES)], "i int, fighter_name string, listing_title string")
    aliases = spark.createDataFrame(PRIORITY, "priority long, alias string, canonical string")
    got = resolve.resolve_entities(df, aliases, inline=inline)
    assert got.columns == [*df.columns, "fighter_name_canonical"]
    found = {r["i"]: r["fighter_name_canonical"] for r in got.collect()}
    assert found == {i: brute(n, t, PRIORITY) for i, (n, t) in enumerate(CASES)}


ODD = [(0, " foo ", "Foo"), (1, "", "Empty"), (2, None, "Missing"), (3, "AB", "Two"), (4, "z", "One"), (5, "bar", "Bar"),
       (6, "foo", "Later"), (7, "\u00a0baz\u2003", "Baz"), (8, "nobody", None), (9, " ", "Blank")]


def test_odd_aliases_give_one_answer(spark):
    """Padded, empty, missing, repeated and very short aliases, inline and joined."""
    aliases = spark.createDataFrame(ODD, "priority long, alias string, canonical string")
    cases = [("foo", "x"), ("FOO\u00a0", None), (None, "ab card here"), (None, "a bar"), (None, "fizz"), (None, "plain text"),
             ("baz", None), (None, "my baz"), ("nobody", "has a bar"), ("", ""), (None, "food and bar")]
    df = spark.createDataFrame([(i, *c) for i, c in enumerate(cases)], "i int, fighter_name string, listing_title string")
    expected = ["Foo", "Foo", "Two", "Bar", "One", None, "Baz", "One", "Bar", None, "Foo"]
    for inline in (0, 256):
        got = {r["i"]: r["fighter_name_canonical"] for r in resolve.resolve_entities(df, aliases, inline=inline).collect()}
        assert [got[i] for i in range(len(cases))] == expected, inline
    rows = resolve.normal_rows(ODD)
    assert rows == sorted((r["priority"], r["alias"], r["canonical"]) for r in resolve.normal_aliases(aliases).collect())
    assert resolve.unusable_aliases(aliases).collect()[0].asDict() == {"without_name": 4, "repeated": 1}


def test_substring_join_on_random_text(spark):
    rng = random.Random(5)
    aliases = [(i, "".join(rng.choice("abc") for _ in range(rng.randint(1, 4))), f"n{i}") for i in range(40)]
    titles = ["".join(rng.choice("abcx ") for _ in range(rng.randint(0, 25))) for _ in range(300)]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(titles)], "i int, title string")
    table = spark.createDataFrame(aliases, "priority long, alias string, canonical string")
    got = {r["i"]: r["canonical"] for r in resolve.substring_alias(df, table, "title").collect()}
    assert got == {i: brute(None, t, aliases) for i, t in enumerate(titles)}


def test_fixed_dictionary(spark):
    df = spark.createDataFrame(
        [(None, "ONE mighty mouse rookie"), ("The Notorious ", ""), (None, "Sean O'Malley"), (None, "Volkswagen")],
        "fighter_name string, listing_title string",
    )
    got = [r["fighter_name_canonical"] for r in resolve.resolve_fixed(df).collect()]
    assert got == ["Demetrious Johnson", "Conor McGregor", "Sean O'Malley", "Alexander Volkanovski"]


# --- rolling ------------------------------------------------------------------------------

SALES = "sale_id string, fighter_id string, grade_id int, sale_date date, sale_price_usd decimal(12,2)"


def one_window_per_row(df, keys):
    """Time frames as one window over raw sales."""
    by_time = W.partitionBy(*keys).orderBy(epoch_seconds("sale_date"))
    frame = lambda d: by_time.rangeBetween(-d * SECONDS_PER_DAY, 0)
    price = F.col("sale_price_usd")
    mean = lambda d: F.sum(price).over(frame(d)).cast("double") / F.nullif(F.count(price).over(frame(d)), F.lit(0)).cast("double")
    return df.select(
        "*",
        *[mean(d).alias(f"vwap_{d}d") for d in fixed.MEAN_WINDOWS],
        *[F.count("*").over(frame(d)).alias(f"sale_count_{d}d") for d in fixed.COUNT_WINDOWS],
    )


@pytest.mark.parametrize("kind", ["double", "float"])
def test_frames_refuse_floats(spark, kind):
    """Differences of running totals are wrong on floats: 1e17 earlier swallows later prices."""
    df = some_sales(spark, 10)[0].withColumn("sale_price_usd", F.col("sale_price_usd").cast(kind))
    with pytest.raises(TypeError, match=kind):
        rolling.rolling_by_date(df, ["fighter_id"])
    with pytest.raises(TypeError, match=kind):
        rolling.rolling_by_rows(df)
    exact = df.withColumn("sale_price_usd", F.lit(10).cast("decimal(12,2)"))
    assert rolling.rolling_by_date(exact.dropna(), ["fighter_id"]).where("vwap_7d != 10.0 or vwap_7d is null").isEmpty()


def some_sales(spark, n=600, seed=3):
    """A third of all sales in one group; NULL keys; many sales per day."""
    import hashlib

    rng = random.Random(seed)
    rows = []
    for i in range(n):
        key = ("hot", 1) if i % 3 == 0 else rng.choice([("a", 1), ("a", 2), ("b", None), (None, None)])
        price = Decimal(rng.randint(1, 10_000_000)) / 100
        rows.append((hashlib.md5(str(i).encode()).hexdigest(), *key, day(rng.randint(0, 60)), price))
    return spark.createDataFrame(rows, SALES), rows


def mean(prices):
    return float(sum(prices)) / len(prices)


def test_row_frames_match_brute_force(spark):
    df, rows = some_sales(spark)
    wanted = {}
    for key in {(r[1], r[2]) for r in rows}:
        group = sorted((r for r in rows if (r[1], r[2]) == key), key=lambda r: (r[3], r[0]))
        for i, r in enumerate(group):
            prices = [g[4] for g in group[: i + 1]]
            wanted[r[0]] = (mean(prices[-7:]), mean(prices[-30:]), mean(prices[-90:]), min(i + 1, 7), min(i + 1, 30))
    for hot_rows in (5_000_000, 100, 1):
        rolled = rolling.rolling_by_rows(df, hot_rows=hot_rows)
        got = {r["sale_id"]: tuple(r)[5:] for r in rolled.collect()}
        assert got == wanted, hot_rows


def test_time_frames_match_brute_force_and_per_row_form(spark):
    df, rows = some_sales(spark, 300)
    df = df.dropna(subset=["fighter_id", "grade_id"])
    keys = ["fighter_id", "grade_id"]
    rolled = rolling.rolling_by_date(df, keys)
    assert values(rolled) == values(one_window_per_row(df, keys))
    for r in rolled.collect():
        peers = [x for x in rows if x[1] == r["fighter_id"] and x[2] == r["grade_id"] and x[3] <= r["sale_date"]]
        week = [x[4] for x in peers if (r["sale_date"] - x[3]).days <= 7]
        assert r["vwap_7d"] == mean(week) and r["sale_count_7d"] == len(week)


def test_time_frame_edges(spark):
    rows = [("a", day(0), 10), ("a", day(7), 20), ("a", day(8), 30), ("a", day(8), 50)]
    df = spark.createDataFrame(rows, "k string, sale_date date, sale_price_usd int").withColumn(
        "sale_price_usd", F.col("sale_price_usd").cast("decimal(12,2)")
    )
    got = rolling.rolling_by_date(df, ["k"], mean_days=[7], count_days=[7])
    assert [tuple(r)[2:] for r in got.orderBy("sale_date", "sale_price_usd").collect()] == [
        (Decimal("10.00"), 10.0, 1),
        (Decimal("20.00"), 15.0, 2),
        (Decimal("30.00"), 100 / 3, 3),
        (Decimal("50.00"), 100 / 3, 3),
    ]


def test_eligibility_needs_every_key(spark):
    rows = [("n", "g", "PSA", 1.0, False), (None, "g", "PSA", 1.0, True), ("n", None, "PSA", 1.0, False), ("n", "g", "PSA", 1.0, True)]
    df = spark.createDataFrame(
        rows, "fighter_name_canonical string, grade string, grader string, sale_price_usd double, is_outlier boolean"
    )
    assert rolling.eligible(df).count() == 1


def test_deviation_needs_a_base(spark):
    df = spark.createDataFrame([(10.0, 8.0, 0.0), (10.0, None, 5.0)], "sale_price_usd double, vwap_7d double, vwap_30d double")
    got = [tuple(r)[3:] for r in rolling.with_deviation(df).collect()]
    assert got == [(25.0, None), (None, 100.0)]
