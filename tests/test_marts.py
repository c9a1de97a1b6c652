"""Star schema, serving, snapshots, checks, parsing, streaming and plan shape."""

import datetime as dt
from decimal import Decimal

import pytest
from conftest import column, values
from pyspark.sql import functions as F

from bindings import tables as t
from bindings.queries import QUERIES
from hammerline import fixed
from hammerline.operators import checks, dedup, scd
from hammerline.plans import certs, ingest, marts, parsing, serving
from hammerline.sources import scans, sinks
from hammerline.streaming import ingest as streaming



def as_of():
    return F.lit(dt.date(2024, 6, 30))


# --- dimensions ---------------------------------------------------------------------------


def test_seed_and_literals(spark, tmp_path):
    seed = scans.scan_seed(spark)
    assert seed.count() == 61
    assert seed.select("fighter_name_canonical").distinct().count() == 32
    assert scans.scan_seed(spark, scans.SEED_FILE).exceptAll(seed).count() == 0
    results = checks.run_checks(marts.dim_fighter(seed), checks.MART_TESTS["dim_fighter"])
    assert column(results.where("not success")) == []
    grades = marts.dim_grade(spark)
    assert grades.count() == 6 and checks.grades_out_of_range(grades).count() == 0
    assert checks.suite_result(checks.run_checks(grades, checks.MART_TESTS["dim_grade"])).first()["success"]


def test_grade_join_defaults(spark):
    rows = [(" psa ", 10.0), ("PSA", None), ("Raw", None), ("CGC", 10.0), (None, None)]
    df = spark.createDataFrame(rows, "grader string, grade_numeric double")
    grades = marts.dim_grade(spark)
    assert [r["grade_id"] for r in marts.join_grade(df, grades).collect()] == [1, None, None, None, None]
    assert [r["grade_id"] for r in marts.join_grade(df, grades, raw_match=True).collect()] == [1, None, 6, None, None]


def test_card_key_repeats_per_entity_only(spark):
    resolved = spark.createDataFrame(
        [(2008, "s", "1", "f1"), (2008, "s", "1", "f2"), (2008, "s", "1", "f1"), (None, "s", "1", "f1")],
        "card_year int, card_set string, card_number string, fighter_id string",
    )
    entities = spark.createDataFrame([("f1", 2008), ("f2", 2010)], "fighter_id string, debut_year int")
    pairs = marts.dim_card(resolved, entities, per_fighter=True)
    assert sorted(column(pairs, "is_rookie")) == [False, True]
    failed = {r["check"]: r["failed"] for r in checks.run_checks(pairs, checks.MART_TESTS["dim_card"]).collect()}
    assert failed == {"unique_keys": 1, "not_null": 0}
    cards = marts.dim_card(resolved, entities)
    assert column(cards, "is_rookie") == [True]
    joined = values(marts.join_card(resolved, cards).select("fighter_id", "card_id"))
    assert joined == values(marts.derive_card(resolved).select("fighter_id", "card_id"))


def test_future_guard_per_source(spark):
    base = dict.fromkeys([b for _, b, _ in marts.STAGING])
    rows = [
        {**base, "listing_id": "1", "sale_price_usd": 5.0, "sale_date": dt.date(2024, 7, 1), "is_outlier": False},
        {**base, "listing_id": "2", "sale_price_usd": 0.0, "sale_date": dt.date(2024, 6, 1), "is_outlier": False},
        {**base, "listing_id": "3", "sale_price_usd": 5.0, "sale_date": dt.date(2024, 6, 1), "is_outlier": True},
        {**base, "listing_id": "4", "sale_price_usd": 5.0, "sale_date": dt.date(2024, 6, 1), "is_outlier": False},
    ]
    kinds = {"sale_price_usd": "double", "sale_date": "date", "is_outlier": "boolean"}
    schema = ", ".join(f"{c} {kinds.get(c, 'string')}" for c in base)
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema)
    kept = {s: sorted(column(marts.staged(df, s, as_of()), "source_listing_id")) for s in fixed.STAGED_SOURCES}
    assert kept == {"ebay": ["1", "4"], "pwcc": ["4"], "myslabs": ["4"]}


def test_build_marts_from_tables(spark, tmp_path):
    """Entry point B on disk, from raw files to the benchmark mart."""
    from test_records import sales

    from hammerline.operators.validate import validate_sales

    layout = scans.Layout(str(tmp_path))
    rows = sales(
        spark,
        *[
            {
                "listing_id": str(i),
                "source": ["ebay", "pwcc", "goldin"][i % 3],
                "fighter_name": "Jon Jones",
                "card_year": 2008,
                "card_set": "Topps",
                "card_number": "1",
                "grade": "PSA 10",
                "grader": "PSA",
                "grade_numeric": 10.0,
                "sale_date": dt.date(2024, 6, 1) + dt.timedelta(days=i),
                "sale_price_usd": Decimal(100 + i),
            }
            for i in range(12)
        ],
    )
    sinks.append_raw(validate_sales(rows, 2024).drop("errors"), layout.raw, as_of())
    ingest.run_stages(spark, layout, as_of=dt.datetime(2024, 6, 30))
    sinks.write_source_tables(spark.read.parquet(layout.enriched), layout.warehouse)
    marts.build_marts(spark, layout, as_of())
    fact = spark.read.parquet(layout.mart("fct_card_sales"))
    assert fact.count() == 8 and fact.where("card_id is null or fighter_id is null or grade_id != 1").count() == 0
    bench = spark.read.parquet(layout.mart("fct_price_benchmarks"))
    entities = spark.read.parquet(layout.mart("dim_fighter"))
    grades = spark.read.parquet(layout.mart("dim_grade"))
    last = F.lit(dt.date(2024, 6, 11))
    [row] = serving.market_overview(bench, entities, grades, last).collect()
    assert (row["fighter_name"], row["grade_label"], row["sale_count_30d"]) == ("Jon Jones", "PSA 10", 8)
    scan = plan(serving.market_overview(bench, entities, grades, last))
    assert "PartitionFilters: [isnotnull(benchmark_date" in scan.replace("\n", "") and "benchmark_date#" in scan
    [mover] = serving.top_movers(bench, entities, grades, last, "up").collect()
    assert mover["price_pct_change_7d"] > 0
    assert serving.top_movers(bench, entities, grades, last, "down").count() == 0
    [detail] = serving.fighter_detail(bench, fact, entities, grades, last, row["fighter_id"]).collect()
    assert len(detail["price_history"]) == 8 and len(detail["recent_sales"]) == 8
    assert [p["date"] for p in detail["price_history"]] == sorted(p["date"] for p in detail["price_history"])
    assert detail["recent_sales"][0]["sale_date"] == dt.date(2024, 6, 11)
    none = serving.search_fighters(bench, entities, "khabib", last).collect()
    assert len(none) == 2 and {r["vwap_30d"] for r in none} == {None}
    assert serving.search_fighters(bench, entities, "%", last).count() == 0
    assert serving.search_fighters(bench, entities, "%", last, like=True).count() == 20


def test_snapshot_refuses_ambiguous_input(spark):
    from hammerline.operators import scd

    rows = spark.createDataFrame([("f", 1, 1.0, 2.0, 3)], "fighter_id string, grade_id int, vwap_7d double, vwap_30d double, sale_count_30d int")
    first = scd.first_snapshot(rows, as_of().cast("timestamp"))
    with pytest.raises(ValueError, match="repeat"):
        scd.apply_snapshot(first, rows.unionByName(rows), as_of())
    with pytest.raises(ValueError, match="lack vwap_7d"):
        scd.apply_snapshot(first, rows.drop("vwap_7d"), as_of())


def test_parameter_limits(spark):
    with pytest.raises(ValueError):
        serving.top_movers(None, None, None, as_of(), "sideways")
    with pytest.raises(ValueError):
        serving.top_movers(None, None, None, as_of(), "up", 21)
    with pytest.raises(ValueError):
        serving.search_fighters(None, None, "", as_of())


# --- snapshot -----------------------------------------------------------------------------

BENCH = "fighter_id string, grade_id int, vwap_7d double, vwap_30d double, sale_count_30d long"


def snap_rows(df):
    return sorted(
        (r["fighter_id"], r["vwap_30d"], str(r["dbt_valid_from"])[:10], str(r["dbt_valid_to"])[:10]) for r in df.collect()
    )


def test_snapshot_periods(spark):
    d1, d2, d3 = (F.lit(x).cast("timestamp") for x in ("2024-01-01", "2024-01-02", "2024-01-03"))
    one = spark.createDataFrame([("same", 1, 1.0, 1.0, 1), ("moved", 1, 1.0, 1.0, 1), ("gone", 1, 1.0, None, 1), (None, 1, 1.0, 1.0, 1)], BENCH)
    two = spark.createDataFrame([("same", 1, 1.0, 1.0, 1), ("moved", 1, 1.0, 2.0, 1), ("new", 1, 1.0, 1.0, 1)], BENCH)
    first = scd.first_snapshot(one, d1)
    second = scd.apply_snapshot(first, two, d2)
    assert snap_rows(second) == [
        ("gone", None, "2024-01-01", "2024-01-02"),
        ("moved", 1.0, "2024-01-01", "2024-01-02"),
        ("moved", 2.0, "2024-01-02", "None"),
        ("new", 1.0, "2024-01-02", "None"),
        ("same", 1.0, "2024-01-01", "None"),
    ]
    assert snap_rows(scd.apply_snapshot(second, two, d3)) == snap_rows(second)
    kept = scd.apply_snapshot(first, two, d2, invalidate_hard_deletes=False)
    assert ("gone", None, "2024-01-01", "None") in snap_rows(kept)
    back = scd.apply_snapshot(second, one, d3)
    assert ("gone", None, "2024-01-03", "None") in snap_rows(back)
    assert back.where("dbt_valid_to is null").count() == 3
    assert back.select("dbt_scd_id").distinct().count() == back.count()


# --- checks -------------------------------------------------------------------------------


def test_checks_report_each_failure(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 5), (None, 9), (None, 2)], "k string, v int")
    suite = [
        checks.row_count(1, 4),
        checks.column_exists("missing"),
        checks.not_null("missing"),
        checks.not_null("v", "warn"),
        checks.between("v", 1, 5),
        checks.in_set("v", [1, 5, 9]),
        checks.matches("k", "^a$"),
        checks.unique_rows("k"),
        checks.unique_keys("k"),
    ]
    got = [(r["check"], r["evaluated"], r["failed"]) for r in checks.run_checks(df, suite).collect()]
    assert sorted(got) == [
        ("between", 5, 1),
        ("column_exists", 1, 1),
        ("in_set", 5, 1),
        ("matches", 5, 1),
        ("not_null", 1, 1),
        ("not_null", 5, 1),
        ("row_count", 5, 1),
        ("unique_keys", 5, 1),
        ("unique_rows", 5, 2),
    ]
    warned = checks.suite_result(checks.run_checks(df, [checks.not_null("v", "warn")])).first()
    assert warned.asDict() == {"evaluated_checks": 1, "failed_checks": 1, "warnings": 1, "success": True}


def test_freshness_of_absent_source_is_an_error(spark):
    now = F.lit("2024-01-02 00:00:00").cast("timestamp")
    df = spark.createDataFrame([("ebay", dt.datetime(2024, 1, 1, 17)), ("pwcc", dt.datetime(2024, 1, 1, 13))], "source string, ingested_at timestamp")
    status = {r["source"]: r["status"] for r in checks.freshness(df, now).collect()}
    assert status == {"ebay": "warn", "pwcc": "pass", "myslabs": "error"}


# --- parsing ------------------------------------------------------------------------------


def test_api_edge_items(spark):
    payloads = [
        '{"itemSummaries": [{"itemId": "1", "title": "UFC PSA 9", "price": {"value": "10.00"}, "itemWebUrl": "https://x/1"}]}',
        '{"itemSummaries": [{"itemId": "2", "title": "t", "price": {"value": "10", "currency": "EUR"}, "itemWebUrl": "https://x/2"}]}',
        '{"itemSummaries": [{"itemId": "3", "title": "t", "price": {"value": ""}, "itemWebUrl": "https://x/3"}]}',
        '{"itemSummaries": [{"title": "no id", "price": {"value": "1"}, "itemWebUrl": "https://x/4"}]}',
        '{"itemSummaries": []}',
        "not json",
    ]
    df = spark.createDataFrame([(p,) for p in payloads], "payload string")
    [row] = parsing.api_sales(df, "payload", as_of()).collect()
    assert (row["listing_id"], row["grade"], row["sale_date"], row["sale_type"]) == ("1", "PSA 9", dt.date(2024, 6, 30), "buy_it_now")


def test_pages_as_sites_write_them(spark):
    """Nested spans, single quotes, character references, relative links, text before the link."""
    item = """<li class='s-item'><div class='s-item__title'><span role="heading"><span class="LIGHT_HIGHLIGHT">New Listing</span>{}</span>
      </div><span class='s-item__price'><span>$</span>5.00</span><a class='s-item__link' href='{}'></a></li>"""
    html = "<ul>" + item.format("UFC Jos&#233; &eacute; O&#x27;Neil PSA&nbsp;10", "https://e/itm/1") + item.format("Relative PSA 9", "/itm/12")
    df = spark.createDataFrame([(html,)], "html string")
    [row] = parsing.page_sales(df, "html", as_of(), parsing.EBAY_PAGE).collect()
    assert (row["listing_id"], row["listing_title"]) == ("1", "New ListingUFC José é O'Neil PSA\xa010")
    assert (row["grade"], row["sale_price_usd"]) == ("PSA 10", Decimal("5.00"))

    card = """<div class="card"><p class='chakra-text'>$%d.00</p><p class="chakra-text">Card %d PSA 9</p>
      <a href='https://www.fanaticscollect.com/buy-now/id%d'><b>see</b></a><p class="chakra-text">Sold on Jun 1, 2024 in Buy Now</p></div>"""
    grid = "<div class='grid'>" + "".join(card % (i, i, i) for i in (1, 2, 3)) + "</div>"
    rows = parsing.page_sales(spark.createDataFrame([(grid,)], "html string"), "html", as_of(), parsing.PWCC_PAGE).collect()
    assert sorted((r["listing_id"], r["listing_title"], int(r["sale_price_usd"])) for r in rows) == [
        (f"id{i}", f"Card {i} PSA 9", i) for i in (1, 2, 3)
    ]
    long = "<ul>" + item.format("x <i>y</i> " * 5000 + "PSA 8", "https://e/itm/3")
    [row] = parsing.page_sales(spark.createDataFrame([(long,)], "html string"), "html", as_of(), parsing.EBAY_PAGE).collect()
    assert row["grade"] == "PSA 8"


@pytest.mark.parametrize("depth", [4, 32])
def test_deeply_nested_titles(spark, depth):
    nested = lambda text: "<span>" * depth + text + "</span>" * depth
    item = (f"<ul><li class='s-item'><div class='s-item__title'><span>{nested('S&oslash;ren PSA 9')}</span></div>"
            f"<span class='s-item__price'>{nested('$5.00')}</span><a class='s-item__link' href='https://e/itm/1'></a></li></ul>")  # fmt: skip
    [row] = parsing.page_sales(spark.createDataFrame([(item,)], "html string"), "html", as_of(), parsing.EBAY_PAGE).collect()
    assert (row["listing_title"], row["sale_price_usd"]) == ("Søren PSA 9", Decimal("5.00"))


def test_page_items_without_essentials_are_dropped(spark):
    html = """<ul><li class="s-item"><div class="s-item__title"><span>Shop on eBay</span></div>
      <span class="s-item__price">$1</span><a class="s-item__link" href="https://e/itm/0"></a></li>
    <li class="s-item"><div class="s-item__title"><span>A &amp; B <b>PSA</b> 10</span></div>
      <span class="s-item__price">$1,250.00</span><a class="s-item__link" href="https://e/itm/11?x=1"></a>
      <span class="s-item__ended-date">Sold Jan 5, 2024</span></li>
    <li class="s-item"><div class="s-item__title"><span>No price</span></div><a class="s-item__link" href="https://e/itm/12"></a></li>
    <li class="s-item"><div class="s-item__title"><span>No link</span></div><span class="s-item__price">$2</span></li></ul>"""
    df = spark.createDataFrame([(html,), (html * 1,), ("<html></html>",), (None,)], "html string")
    rows = parsing.page_sales(df.limit(1), "html", as_of(), parsing.EBAY_PAGE).collect()
    assert [(r["listing_id"], r["listing_title"], r["sale_price_usd"], r["grade"], r["sale_date"]) for r in rows] == [
        ("11", "A & B PSA 10", Decimal("1250.00"), "PSA 10", dt.date(2024, 1, 5))
    ]
    assert parsing.page_sales(df, "html", as_of(), parsing.EBAY_PAGE).count() == 2


def test_cert_worklist_quota(spark):
    df = spark.createDataFrame([(i, f"cert {100000 + i} and cert 100000") for i in range(1, 150)], "i int, title string")
    cache = spark.createDataFrame([("100005", None)], "cert_key string, cert string")
    flagged = certs.with_cached(certs.found_certs(df, "title", "i"), cache)
    assert tuple(certs.cert_totals(flagged).first()) == (150, 1, 149)
    work = column(certs.worklist(flagged, used_today=97), "cert_number")
    assert work == ["100001", "100000", "100002"]
    assert certs.worklist(flagged, used_today=120).count() == 0
    assert certs.preview(flagged).count() == 20


# --- streaming ----------------------------------------------------------------------------


def test_stream_continues_across_runs(spark, tmp_path):
    from test_records import sales

    from hammerline.operators.validate import validate_sales

    raw, out, state = (str(tmp_path / x) for x in ("raw", "out", "state"))

    def land(*ids):
        rows = validate_sales(sales(spark, *[{"listing_id": i} for i in ids]), 2024).drop("errors")
        sinks.append_raw(rows, raw, as_of())

    def run():
        streaming.append_new(streaming.stream_raw(spark, raw), out, state).awaitTermination()
        return sorted(column(spark.read.parquet(out), "listing_id"))

    land("a", "b", "b")
    assert run() == ["a", "b"]
    land("b", "c")
    assert run() == ["a", "b", "c"]
    assert run() == ["a", "b", "c"]
    # Keyed state agrees, however late a copy comes.
    kept, own = str(tmp_path / "kept"), str(tmp_path / "own")

    def run_keyed():
        writer = streaming.stream_dedup(streaming.stream_raw(spark, raw)).select("listing_id").writeStream.format("parquet")
        writer.option("path", kept).option("checkpointLocation", own).trigger(availableNow=True).start().awaitTermination()
        return sorted(column(spark.read.parquet(kept), "listing_id"))

    assert run_keyed() == ["a", "b", "c"]
    late = {"listing_id": "a", "scraped_at": dt.datetime(2019, 1, 1)}, {"listing_id": "d", "scraped_at": dt.datetime(2019, 1, 1)}
    sinks.append_raw(validate_sales(sales(spark, *late), 2024).drop("errors"), raw, as_of())
    assert run_keyed() == run() == ["a", "b", "c", "d"]


# --- plans --------------------------------------------------------------------------------


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_profile_scans_once(spark, sf):
    assert plan(QUERIES["profile_counts"](spark, sf)).count("FileScan parquet") == 2  # lineitem and part, once each


def test_staging_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "rows")
    base = [b for _, b, _ in marts.STAGING]
    kinds = {"sale_price_usd": "double", "sale_date": "date", "is_outlier": "boolean"}
    spark.createDataFrame([], ", ".join(f"{c} {kinds.get(c, 'string')}" for c in base)).write.parquet(path)
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    text = plan(marts.staged(spark.read.parquet(path), "pwcc", as_of()).select("sale_price_usd"))
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "GreaterThan(sale_price_usd,0.0)" in text and "LessThanOrEqual(sale_date,2024-06-30)" in text
    assert "listing_title" not in text.split("ReadSchema")[1]


def test_top_n_per_key_limits_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), "id")
    text = plan(dedup.first_per_key(df, ["k"], [F.col("id").desc()], 5))
    assert text.count("WindowGroupLimit") == 2


def test_row_benchmarks_share_one_shuffle(spark, sf):
    assert plan(QUERIES["rolling_rows"](spark, sf)).count("Exchange hashpartitioning") == 1
