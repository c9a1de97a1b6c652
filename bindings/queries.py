"""One entry per operator: the Spark query and, where SQL can say it, the oracle."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bindings import tables as t
from bindings.oracle import SALE_TYPE, SPORT, _key, sql
from bindings.tables import AS_OF
from hammerline import fixed
from hammerline.functions import dates
from hammerline.functions import sales as fs
from hammerline.functions import text as tx
from hammerline.operators import checks, dedup, incremental, measured, outliers, quantile_store, resolve, rolling, scd, snapshots, validate
from hammerline.plans import certs, ingest, marts, monitor, parsing, serving
from hammerline.schemas import RAW_SALE
from hammerline.session import CODEC, materialise, scratch_path, scratch_scope, shuffles_dropped, write_table
from hammerline.sources import layouts, scans, sinks
from hammerline.sources.versions import Versions
from hammerline.streaming import compact, newest
from hammerline.streaming import ingest as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(oracle: str | None = None, number: str = "", text: str = ""):
    """Register a query under its function name.

    Columns named in ``number`` leave both sides as doubles, those in ``text`` as strings:
    decimals, dates, times and nullable integers have no common plain form otherwise.
    """
    casts = {**dict.fromkeys(number.split(), "double"), **dict.fromkeys(text.split(), "string")}

    def add(fn: Query) -> Query:
        def run(spark: SparkSession, sf: str) -> DataFrame:
            return fn(spark, sf).withColumns({name: F.col(name).cast(kind) for name, kind in casts.items()})

        QUERIES[fn.__name__] = run if casts else fn
        if oracle is not None:
            replaced = ", ".join(f"CAST({name} AS {kind}) AS {name}" for name, kind in casts.items())
            ORACLES[fn.__name__] = f"SELECT * REPLACE ({replaced}) FROM ({oracle})" if casts else oracle
        return fn

    return add


def like(name: str) -> str:
    """The oracle of another query whose result must be identical."""
    return ORACLES[name]


# --- scans, dedup, profile ------------------------------------------------------------

SALE_OUT = ["record_hash", "listing_id", "source", "sale_price_usd", "sale_date", "listing_title", "sale_type"]
SALE_SQL = ", ".join(SALE_OUT)


@query(sql(f"SELECT {SALE_SQL}, l_partkey FROM ingested"), number="sale_price_usd", text="sale_date")
def keep_latest(spark, sf):
    return t.ingested(spark, sf).select(*SALE_OUT, "l_partkey")


@query(sql("SELECT record_hash, count(*) AS copies FROM sales GROUP BY record_hash HAVING count(*) > 1"))
def duplicate_hashes(spark, sf):
    return dedup.duplicate_keys(t.sales(spark, sf))


PROFILE = """
    SELECT count(*) AS total_count, count(*) FILTER (WHERE sale_price_usd IS NULL) AS null_price_count,
           count(*) FILTER (WHERE sale_price_usd <= 0) AS invalid_price_count,
           count(*) FILTER (WHERE sale_date IS NULL) AS null_date_count,
           count(*) FILTER (WHERE listing_id IS NULL) AS null_id_count,
           (SELECT count(*) FROM (SELECT record_hash FROM sales GROUP BY record_hash HAVING count(*) > 1))
               AS duplicate_hash_count FROM sales"""


@query(sql(PROFILE))
def profile_counts(spark, sf):
    return validate.profile(t.sales(spark, sf))


@query(
    sql(
        f"""SELECT source, count(*) AS total_count, count(*) FILTER (WHERE sale_price_usd IS NULL) AS null_price_count,
            count(*) FILTER (WHERE sale_price_usd <= 0) AS invalid_price_count, count(*) FILTER (WHERE sale_date IS NULL) AS null_date_count,
            count(*) FILTER (WHERE listing_id IS NULL) AS null_id_count FROM sales GROUP BY source"""
    )
)
def profile_measured(spark, sf):
    """The anomalies of each source, counted while the sales are written."""
    wanted = {"total_count": F.lit(True), **validate.raw_anomalies()}
    rows, taken = measured.measure(t.sales(spark, sf), measured.by_value("source", fixed.SOURCES, wanted))
    write_table(rows, "sales")
    found = taken.counts()
    table = [(s, *(found[f"{s}.{name}"] for name in wanted)) for s in fixed.SOURCES]
    return spark.createDataFrame(table, "source string, " + ", ".join(f"{name} long" for name in wanted))


@query(sql(f"SELECT metric, records FROM (UNPIVOT ({PROFILE}) ON COLUMNS(*) INTO NAME metric VALUE records)"))
def profile_report(spark, sf):
    return validate.profile_report(t.sales(spark, sf))


SEEN = "sale_date < DATE '1998-01-01'"


def _seen_and_batch(spark, sf):
    rows = t.sales(spark, sf)
    return rows.where(SEEN), rows.where("sale_date >= DATE '1997-06-01'")


@query(
    sql(
        f"""SELECT record_hash, listing_id, sale_price_usd, sale_date FROM (
            SELECT *, row_number() OVER (PARTITION BY record_hash ORDER BY scraped_at DESC, l_partkey DESC, l_suppkey DESC,
                   sale_price_usd DESC, grade DESC NULLS LAST) AS rn
            FROM sales WHERE sale_date >= DATE '1997-06-01') b
        WHERE rn = 1 AND NOT EXISTS (SELECT 1 FROM sales s WHERE s.record_hash = b.record_hash AND s.{SEEN})"""
    ), number="sale_price_usd", text="sale_date")
def anti_seen(spark, sf):
    seen, batch = _seen_and_batch(spark, sf)
    return dedup.new_records(batch, seen, ties=t.TIES).select("record_hash", "listing_id", "sale_price_usd", "sale_date")


@query(sql(f"SELECT DISTINCT record_hash FROM sales WHERE {SEEN} OR sale_date >= DATE '1997-06-01'"))
def set_union(spark, sf):
    return dedup.merge_seen(*_seen_and_batch(spark, sf))


@query(
    sql(
        f"""SELECT record_hash FROM sales WHERE sale_date >= DATE '1997-06-01'
            EXCEPT SELECT record_hash FROM sales WHERE {SEEN}"""
    )
)
def set_difference(spark, sf):
    seen, batch = _seen_and_batch(spark, sf)
    return dedup.unseen_keys(batch, seen)


# --- derived columns ------------------------------------------------------------------


@query(
    sql(
        """SELECT listing_id, source, l_partkey, source = 'pwcc' AS stage_premium,
           source IN ('pwcc', 'myslabs') AS mart_premium
           FROM sales"""
    )
)
def buyer_premium(spark, sf):
    mart = F.create_map(*[F.lit(x) for pair in fixed.MART_PREMIUM.items() for x in pair])
    return t.sales(spark, sf).select(
        "listing_id",
        "source",
        "l_partkey",
        fs.stage_premium().alias("stage_premium"),
        F.coalesce(F.try_element_at(mart, F.col("source")), F.lit(False)).alias("mart_premium"),
    )


@query(sql(f"SELECT listing_id, l_partkey, {SALE_TYPE} AS sale_type FROM sales"))
def sale_type_norm(spark, sf):
    return t.sales(spark, sf).select("listing_id", "l_partkey", fs.normalised_sale_type().alias("sale_type"))


@query(sql("SELECT listing_id, source, sha256(concat(listing_id, source)) AS record_hash FROM sales"))
def record_hash(spark, sf):
    return t.sales(spark, sf).select("listing_id", "source", fs.record_hash().alias("record_hash"))


@query(sql(f"SELECT listing_id, {_key('source', 'grade', 'card_year')} AS sale_key FROM sales"))
def surrogate_key(spark, sf):
    return t.sales(spark, sf).select(
        "listing_id", fs.surrogate_key("source", "grade", "card_year").alias("sale_key")
    )


@query(
    sql(
        """SELECT listing_id, l_partkey, card_year,
           coalesce(card_year = CASE WHEN l_partkey % 7 > 0 THEN 1990 + l_partkey % 30 END, FALSE) AS is_rookie
           FROM sales"""
    )
)
def rookie_flag(spark, sf):
    debut = F.expr("CASE WHEN l_partkey % 7 > 0 THEN 1990 + l_partkey % 30 END")
    return t.sales(spark, sf).select(
        "listing_id", "l_partkey", "card_year", fs.rookie(F.col("card_year"), debut).alias("is_rookie")
    )


@query(
    sql(
        """SELECT listing_id, l_partkey, CASE WHEN l_suppkey % 4 = 0 THEN NULL
           ELSE CAST(sale_price_usd AS DOUBLE) / (l_suppkey % 4) END AS ratio FROM sales"""
    )
)
def safe_ratio(spark, sf):
    return t.sales(spark, sf).select(
        "listing_id",
        "l_partkey",
        fs.safe_divide(F.col("sale_price_usd").cast("double"), (F.col("l_suppkey") % 4).cast("double")).alias("ratio"),
    )


@query(
    sql(
        """SELECT listing_id, l_partkey, CAST(epoch(sale_date) AS BIGINT) AS sale_ts,
           strftime(sale_date, '%Y') AS year, strftime(sale_date, '%m') AS month, strftime(sale_date, '%d') AS day
           FROM sales"""
    )
)
def date_parts(spark, sf):
    return t.sales(spark, sf).select(
        "listing_id",
        "l_partkey",
        fs.epoch_seconds("sale_date").alias("sale_ts"),
        *[c.alias(n) for n, c in fs.path_parts("sale_date").items()],
    )


@query(
    sql(
        f"SELECT listing_id, l_partkey, {SPORT} AS sport FROM (SELECT *, "
        "CASE l_partkey % 3 WHEN 0 THEN 'Topps Chrome ' WHEN 1 THEN 'UFC ' ELSE '' END || fighter_name "
        "AS fighter_name_canonical FROM sales)"
    )
)
def sport_class(spark, sf):
    rows = t.sales(spark, sf).withColumn(
        "fighter_name_canonical",
        F.expr("concat(CASE l_partkey % 3 WHEN 0 THEN 'Topps Chrome ' WHEN 1 THEN 'UFC ' ELSE '' END, fighter_name)"),
    )
    return rows.select("listing_id", "l_partkey", fs.sport("card_set", "fighter_name_canonical").alias("sport"))


# --- validation and checks --------------------------------------------------------------

YEAR = 2015
DIRTY = """SELECT * REPLACE (
    CASE WHEN l_partkey % 11 = 0 THEN -sale_price_usd WHEN l_partkey % 11 = 1 THEN sale_price_usd * 100
         ELSE sale_price_usd END AS sale_price_usd,
    CASE WHEN l_partkey % 13 = 0 THEN '   ' ELSE listing_title END AS listing_title,
    CASE WHEN l_partkey % 17 = 0 THEN 'ftp://x' ELSE listing_url END AS listing_url,
    CASE WHEN l_partkey % 19 = 0 THEN 0.5 ELSE grade_numeric END AS grade_numeric,
    CASE WHEN l_partkey % 23 = 0 THEN 'XYZ' ELSE grader END AS grader) FROM sales"""
ERRORS_SQL = """concat_ws('; ',
    CASE WHEN sale_price_usd <= 0 THEN 'sale_price_usd must be greater than 0' END,
    CASE WHEN sale_price_usd >= 1000000 THEN 'sale_price_usd must be less than 1,000,000' END,
    CASE WHEN trim(listing_title) = '' THEN 'listing_title must not be empty' END,
    CASE WHEN card_year NOT BETWEEN 1990 AND 2015 THEN 'card_year out of range' END,
    CASE WHEN grader NOT IN ('PSA', 'BGS', 'SGC', 'CGC', 'Raw') THEN 'grader not allowed' END,
    CASE WHEN grade_numeric NOT BETWEEN 1 AND 10 THEN 'grade_numeric must be between 1.0 and 10.0' END,
    CASE WHEN listing_url NOT LIKE 'http%' THEN 'listing_url not a URL' END,
    CASE WHEN sale_type NOT IN ('auction', 'buy_it_now', 'best_offer') THEN 'sale_type not allowed' END)"""


def _dirty(spark, sf) -> DataFrame:
    part = F.col("l_partkey")
    price = F.col("sale_price_usd")
    broken = F.when(part % 11 == 0, -price).when(part % 11 == 1, price * 100).otherwise(price)
    return t.sales(spark, sf).withColumns(
        {
            "sale_price_usd": broken.cast("decimal(14,2)"),
            "listing_title": F.when(part % 13 == 0, "   ").otherwise(F.col("listing_title")),
            "listing_url": F.when(part % 17 == 0, "ftp://x").otherwise(F.col("listing_url")),
            "grade_numeric": F.when(part % 19 == 0, 0.5).otherwise(F.col("grade_numeric")),
            "grader": F.when(part % 23 == 0, "XYZ").otherwise(F.col("grader")),
        }
    )


@query(sql(f"SELECT record_hash, l_partkey, {ERRORS_SQL} AS errors FROM ({DIRTY})"))
def validate_rows(spark, sf):
    checked = validate.validate_sales(_dirty(spark, sf), YEAR)
    return checked.select("record_hash", "l_partkey", F.concat_ws("; ", "errors").alias("errors"))


@query(sql(f"SELECT record_hash, l_partkey, sale_price_usd FROM ({DIRTY}) WHERE {ERRORS_SQL} = ''"), number="sale_price_usd")
def valid_rows(spark, sf):
    valid, _ = validate.split_valid(validate.validate_sales(_dirty(spark, sf), YEAR))
    return valid.select("record_hash", "l_partkey", "sale_price_usd")


@query(
    sql(
        f"""SELECT source, e.error, count(*) AS records FROM (SELECT source, {ERRORS_SQL} AS errors FROM ({DIRTY})) x,
            unnest(string_split(errors, '; ')) AS e(error) WHERE errors <> '' GROUP BY source, e.error"""
    )
)
def quarantine_counts(spark, sf):
    return validate.error_counts(validate.validate_sales(_dirty(spark, sf), YEAR), "source")


def _check_sql(rows: list[tuple[str, str, str, str]], source: str) -> str:
    """rows of (check, column, severity, failed expression) over one table."""
    parts = [
        f"SELECT '{k}' AS \"check\", '{c}' AS \"column\", '{s}' AS severity, "
        f"{'1' if k == 'column_exists' else '(SELECT count(*) FROM ' + source + ')'} AS evaluated, {f} AS failed, {f} = 0 AS success"
        for k, c, s, f in rows
    ]
    return " UNION ALL ".join(parts)


def _count(source: str, condition: str) -> str:
    return f"(SELECT count(*) FROM {source} WHERE {condition})"


def _dups(source: str, column: str, what: str) -> str:
    return (
        f"(SELECT CAST(coalesce({what}, 0) AS BIGINT) FROM (SELECT {column}, count(*) AS n FROM {source} "
        f"WHERE {column} IS NOT NULL GROUP BY {column} HAVING count(*) > 1))"
    )


SUITE_ROWS = [
    ("row_count", "table", "error", "(SELECT CASE WHEN count(*) < 100 THEN 1 ELSE 0 END FROM sales)"),
    *[
        ("column_exists", c, "error", "0")
        for c in ("listing_id", "sale_price_usd", "sale_date", "source", "sale_type", "record_hash")
    ],
    *[("not_null", c, "error", _count("sales", f"{c} IS NULL")) for c in ("listing_id", "sale_price_usd", "sale_date")],
    ("between", "sale_price_usd", "error", _count("sales", "sale_price_usd NOT BETWEEN 0.01 AND 999999")),
    ("in_set", "source", "error", _count("sales", "source NOT IN ('ebay', 'pwcc', 'goldin', 'myslabs')")),
    ("in_set", "sale_type", "error", _count("sales", "sale_type NOT IN ('AUCTION', 'BUY_IT_NOW', 'UNKNOWN')")),
    ("matches", "record_hash", "error", _count("sales", "NOT regexp_full_match(record_hash, '[a-f0-9]{64}')")),
    ("unique_rows", "record_hash", "error", _dups("sales", "record_hash", "sum(n)")),
]


@query(sql(_check_sql(SUITE_ROWS, "sales")))
def dq_suite(spark, sf):
    return checks.run_checks(t.sales(spark, sf), checks.ENRICHED_SUITE)


@query(sql(_check_sql([row for row in SUITE_ROWS if not row[0].startswith("unique")], "sales")))
def dq_measured(spark, sf):
    """The suite's row-level checks, taken while the sales are written."""
    rows, taken = measured.measure(t.sales(spark, sf), checks=[c for c in checks.ENRICHED_SUITE if not c.kind.startswith("unique")])
    write_table(rows, "sales")
    return taken.check_table(spark)


@query(
    sql(
        f"""SELECT count(*) AS evaluated_checks, count(*) FILTER (WHERE NOT success) AS failed_checks,
            count(*) FILTER (WHERE NOT success AND severity = 'warn') AS warnings,
            count(*) FILTER (WHERE NOT success AND severity = 'error') = 0 AS success
            FROM ({_check_sql(SUITE_ROWS, "sales")})"""
    )
)
def dq_result(spark, sf):
    return checks.suite_result(checks.run_checks(t.sales(spark, sf), checks.ENRICHED_SUITE))


MART_ROWS = [
    ("unique_keys", "sale_id", "error", _dups("fact", "sale_id", "count(*)")),
    ("not_null", "sale_id", "error", _count("fact", "sale_id IS NULL")),
    ("not_null", "sale_price_usd", "error", _count("fact", "sale_price_usd IS NULL")),
    ("between", "sale_price_usd", "error", _count("fact", "sale_price_usd NOT BETWEEN 0 AND 1000000")),
    ("not_null", "sale_date", "error", _count("fact", "sale_date IS NULL")),
    ("not_null", "source", "error", _count("fact", "source IS NULL")),
    ("in_set", "source", "error", _count("fact", "source NOT IN ('ebay', 'pwcc', 'goldin', 'myslabs')")),
]
WARN_ROWS = [
    ("not_null", "fighter_id", "warn", _count("fact", "fighter_id IS NULL")),
    ("not_null", "grade_id", "warn", _count("fact", "grade_id IS NULL")),
]


@query(sql(_check_sql(MART_ROWS + WARN_ROWS, "fact")))
def mart_tests(spark, sf):
    rows = write_table(t.fact(spark, sf, t.entities(spark, sf)), "fact")
    warn = [c for c in checks.MART_TESTS["fct_price_benchmarks"] if c.severity == "warn"]
    return checks.run_checks(rows, [*checks.MART_TESTS["fct_card_sales"], *warn])


@query(
    sql(
        _check_sql(
            [
                ("unique_keys", "card_id", "error", _dups("card_pairs", "card_id", "count(*)")),
                ("not_null", "card_id", "error", _count("card_pairs", "card_id IS NULL")),
            ],
            "card_pairs",
        )
    )
)
def card_tests(spark, sf):
    """Reports that the per-entity card grain repeats its key."""
    dim = t.entities(spark, sf)
    cards = marts.dim_card(t.resolved(spark, sf, dim), dim, per_fighter=True)
    return checks.run_checks(cards, checks.MART_TESTS["dim_card"])


@query(sql("SELECT listing_id, l_partkey, sale_price_usd FROM (" + DIRTY + ") WHERE sale_price_usd <= 0"), number="sale_price_usd")
def non_positive_prices(spark, sf):
    return checks.non_positive_prices(_dirty(spark, sf)).select("listing_id", "l_partkey", "sale_price_usd")


@query(
    sql(
        """SELECT f.source, f.warn_hours, f.error_hours, m.age_hours,
           CASE WHEN m.age_hours IS NULL OR m.age_hours > f.error_hours THEN 'error'
                WHEN m.age_hours > f.warn_hours THEN 'warn' ELSE 'pass' END AS status
           FROM (VALUES ('ebay', 6, 24), ('pwcc', 12, 48), ('myslabs', 12, 48)) f(source, warn_hours, error_hours)
           LEFT JOIN (SELECT source, (epoch_us(TIMESTAMP '1998-12-02 13:00:00') - epoch_us(max(scraped_at))) / 3.6e9
                             AS age_hours FROM sales GROUP BY source) m
             ON f.source = m.source"""
    )
)
def freshness(spark, sf):
    now = F.lit("1998-12-02 13:00:00").cast("timestamp")
    loaded = t.sales(spark, sf).withColumn("ingested_at", F.col("scraped_at").cast("timestamp"))
    result = checks.freshness(loaded, now)
    return result.select("source", "warn_hours", "error_hours", "age_hours", "status")


# --- outliers -----------------------------------------------------------------------------


@query(sql("SELECT * FROM bounds"))
def iqr_bounds(spark, sf):
    return outliers.iqr_bounds(t.ingested(spark, sf))


def _stored_counts(spark, sf):
    """Counts per day, made in two steps: most of the older sales first, then all of them."""
    rows = write_table(t.ingested(spark, sf).select("record_hash", "source", "grade", "sale_date", "sale_price_usd"), "ingested")
    store = Versions(spark, scratch_path(spark, "counts"))
    on_time = ~F.col("record_hash").startswith("0") | ~F.month("sale_date").isin(5, 6)
    quantile_store.refresh(rows.where((F.col("sale_date") < F.lit("1998-03-10")) & on_time), store)
    quantile_store.refresh(rows, store)
    return store


@query(like("iqr_bounds"))
def iqr_bounds_stored(spark, sf):
    """The bounds from counts kept per day."""
    return quantile_store.bounds(_stored_counts(spark, sf))


@query(
    sql(
        """SELECT source, grade, q1, q3, q3 - q1 AS iqr, q1 - 3.0 * (q3 - q1) AS lower_bound, q3 + 3.0 * (q3 - q1) AS upper_bound
           FROM (SELECT source, grade, quantile_disc(CAST(sale_price_usd AS DOUBLE), 0.25) AS q1,
                        quantile_disc(CAST(sale_price_usd AS DOUBLE), 0.75) AS q3 FROM ingested
                 WHERE sale_date BETWEEN DATE '1995-02-10' AND DATE '1996-01-20' GROUP BY source, grade)"""
    )
)
def iqr_bounds_of_a_period(spark, sf):
    """The bounds of a span of days from the same counts."""
    return quantile_store.bounds(_stored_counts(spark, sf), dt.date(1995, 2, 10), dt.date(1996, 1, 20))


@query(sql("SELECT record_hash, source, grade, is_outlier, includes_buyer_premium, sale_type FROM normalised"))
def iqr_outliers(spark, sf):
    return t.normalised(spark, sf).select(
        "record_hash", "source", "grade", "is_outlier", "includes_buyer_premium", "sale_type"
    )


@query(
    """WITH b AS (SELECT event_type, quantile_disc(value, 0.25) AS q1, quantile_disc(value, 0.75) AS q3
                  FROM events GROUP BY event_type)
       SELECT e.event_id, coalesce(value < q1 - 3.0 * (q3 - q1) OR value > q3 + 3.0 * (q3 - q1), FALSE) AS is_outlier
       FROM events e LEFT JOIN b ON e.event_type = b.event_type"""
)
def event_outliers(spark, sf):
    flagged = outliers.flag_outliers(t.table(spark, sf, "events"), ["event_type"], "value")
    return flagged.select("event_id", "is_outlier")


# --- entity resolution --------------------------------------------------------------------


@query(
    sql(
        """SELECT s.listing_id, s.l_partkey, coalesce(a.canonical, h.by_title) AS fighter_name_canonical
           FROM sales s LEFT JOIN odd a ON lower(trim(s.fighter_name)) = a.alias
           LEFT JOIN odd_hits h ON s.listing_title = h.title""",
        (
            "odd",
            f"""SELECT lower(trim(alias)) AS alias, min(priority) AS priority, arg_min(canonical, priority) AS canonical
                FROM ({t.ODD_ALIASES}) WHERE trim(alias) <> '' AND canonical IS NOT NULL GROUP BY lower(trim(alias))""",
        ),
        (
            "odd_hits",
            """SELECT t.title, arg_min(a.canonical, a.priority) AS by_title
               FROM (SELECT DISTINCT listing_title AS title FROM sales) t JOIN odd a ON contains(lower(t.title), a.alias)
               GROUP BY t.title""",
        ),
    )
)
def resolve_entity(spark, sf):
    named = resolve.resolve_entities(t.stored_sales(spark, sf), t.odd_aliases(spark, sf))
    return named.select("listing_id", "l_partkey", "fighter_name_canonical")


@query(like("resolve_entity"))
def resolve_entity_joined(spark, sf):
    """The same result by joins, the way of a dictionary too large for literals."""
    named = resolve.resolve_entities(t.stored_sales(spark, sf), t.odd_aliases(spark, sf), inline=0)
    return named.select("listing_id", "l_partkey", "fighter_name_canonical")


@query(
    sql(
        """SELECT count(*) FILTER (WHERE coalesce(trim(alias), '') = '' OR canonical IS NULL) AS without_name,
                  count(*) FILTER (WHERE trim(alias) <> '' AND canonical IS NOT NULL)
                  - count(DISTINCT lower(trim(alias))) FILTER (WHERE trim(alias) <> '' AND canonical IS NOT NULL) AS repeated
           FROM odd""",
        ("odd", t.ODD_ALIASES),
    )
)
def unusable_aliases(spark, sf):
    return resolve.unusable_aliases(t.odd_aliases(spark, sf))


@query(
    sql(
        """SELECT s.listing_id, s.l_partkey, a.canonical FROM sales s
           LEFT JOIN aliases a ON lower(trim(s.fighter_name)) = a.alias"""
    )
)
def alias_join(spark, sf):
    matched = resolve.exact_alias(t.sales(spark, sf), materialise(t.aliases(spark, sf)), "fighter_name")
    return matched.select("listing_id", "l_partkey", "canonical")


@query(
    sql(
        """SELECT s.listing_id, s.l_partkey, h.by_title AS canonical FROM sales s
           LEFT JOIN title_hits h ON s.listing_title = h.title"""
    )
)
def alias_in_title(spark, sf):
    matched = resolve.substring_alias(t.sales(spark, sf), materialise(t.aliases(spark, sf)), "listing_title")
    return matched.select("listing_id", "l_partkey", "canonical")


FIXED_ALIASES = ", ".join(
    "({}, '{}', '{}')".format(i, a.replace("'", "''"), c.replace("'", "''")) for i, a, c in resolve.alias_rows()
)


@query(
    sql(
        """SELECT t.listing_id, t.l_partkey, arg_min(d.canonical, d.priority) AS fighter_name_canonical
           FROM tagged t LEFT JOIN dictionary d ON contains(lower(t.title), d.alias)
           GROUP BY t.listing_id, t.l_partkey, t.l_suppkey, t.sale_date, t.rn""",
        ("dictionary", f"SELECT * FROM (VALUES {FIXED_ALIASES}) v(priority, alias, canonical)"),
        (
            "tagged",
            """SELECT s.*, concat(s.listing_title, ' ', upper(d.alias)) AS title,
               row_number() OVER (ORDER BY listing_id, l_partkey, l_suppkey, sale_date) AS rn
               FROM sales s LEFT JOIN dictionary d ON d.priority = s.l_partkey % 120""",
        ),
    )
)
def resolve_fixed(spark, sf):
    """The built-in dictionary over titles that carry its aliases in upper case."""
    names = F.create_map(*[F.lit(x) for i, alias, _ in resolve.alias_rows() for x in (i, alias)])
    alias = F.try_element_at(names, (F.col("l_partkey") % 120).cast("int"))
    tagged = t.sales(spark, sf).withColumn(
        "title", F.concat_ws(" ", "listing_title", F.upper(alias))
    )
    named = resolve.resolve_fixed(tagged.withColumn("nobody", F.lit(None).cast("string")), "nobody", "title")
    return named.select("listing_id", "l_partkey", "fighter_name_canonical")


# --- rolling benchmarks -------------------------------------------------------------------

RANGE_SQL = """
    SELECT record_hash, sale_date, sale_price_usd, vwap_7d, vwap_30d, vwap_90d, sale_count_7d, sale_count_30d,
           CASE WHEN vwap_7d <> 0 THEN (CAST(sale_price_usd AS DOUBLE) - vwap_7d) / vwap_7d * 100 END AS price_pct_change_7d,
           CASE WHEN vwap_30d <> 0 THEN (CAST(sale_price_usd AS DOUBLE) - vwap_30d) / vwap_30d * 100 END AS price_pct_change_30d
    FROM (SELECT *, CAST(sum(sale_price_usd) OVER w7 AS DOUBLE) / count(*) OVER w7 AS vwap_7d,
                 CAST(sum(sale_price_usd) OVER w30 AS DOUBLE) / count(*) OVER w30 AS vwap_30d,
                 CAST(sum(sale_price_usd) OVER w90 AS DOUBLE) / count(*) OVER w90 AS vwap_90d,
                 count(*) OVER w7 AS sale_count_7d, count(*) OVER w30 AS sale_count_30d
          FROM enriched WHERE fighter_name_canonical IS NOT NULL AND grade IS NOT NULL AND grader IS NOT NULL
               AND sale_price_usd IS NOT NULL AND NOT is_outlier
          WINDOW w7 AS (PARTITION BY fighter_name_canonical, grade, grader ORDER BY sale_date
                        RANGE BETWEEN INTERVAL 7 DAY PRECEDING AND CURRENT ROW),
                 w30 AS (PARTITION BY fighter_name_canonical, grade, grader ORDER BY sale_date
                        RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW),
                 w90 AS (PARTITION BY fighter_name_canonical, grade, grader ORDER BY sale_date
                        RANGE BETWEEN INTERVAL 90 DAY PRECEDING AND CURRENT ROW))"""
RANGE_OUT = [
    "record_hash",
    "sale_date",
    "sale_price_usd",
    "vwap_7d",
    "vwap_30d",
    "vwap_90d",
    "sale_count_7d",
    "sale_count_30d",
    "price_pct_change_7d",
    "price_pct_change_30d",
]


@query(sql(RANGE_SQL), number="sale_price_usd", text="sale_date")
def rolling_benchmarks(spark, sf):
    wanted = ["record_hash", "sale_date", "sale_price_usd", "is_outlier", *rolling.ENTITY_KEYS]
    rows = write_table(t.enriched(spark, sf).select(*wanted), "enriched")
    return ingest.benchmark(rows, t.as_of()).select(*RANGE_OUT)


@query(like("rolling_benchmarks"), number="sale_price_usd", text="sale_date")
def benchmarks_refreshed(spark, sf):
    """Stored benchmarks brought up to date: first most of the older sales, then all of them."""
    wanted = ["record_hash", "sale_date", "sale_price_usd", "is_outlier", *rolling.ENTITY_KEYS]
    # The hash goes through the store as bytes, half as long as its text.
    packed = t.enriched(spark, sf).select(*wanted).withColumn("record_hash", F.unhex("record_hash"))
    rows = rolling.eligible(write_table(packed, "enriched"))
    store = Versions(spark, scratch_path(spark, "benchmarks"))
    on_time = ~F.hex("record_hash").startswith("0") | ~F.month("sale_date").isin(5, 6)
    incremental.refresh(rows.where((F.col("sale_date") < F.lit("1998-03-10")) & on_time), store)
    incremental.refresh(rows, store)
    stored = incremental.stored_benchmarks(store).withColumn("record_hash", F.lower(F.hex("record_hash")))
    return rolling.with_deviation(stored).select(*RANGE_OUT)


@query(
    sql(
        """SELECT DISTINCT source, grade, sale_date,
           CAST(sum(sale_price_usd * card_year) OVER w AS DOUBLE) / CAST(sum(card_year) OVER w AS DOUBLE) AS vwap_30d
           FROM sales WHERE grade IS NOT NULL
           WINDOW w AS (PARTITION BY source, grade ORDER BY sale_date
                        RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW)"""
    ), text="sale_date")
def rolling_weighted(spark, sf):
    """The optional weighted mean."""
    rows = t.sales(spark, sf).dropna(subset=["grade"])
    rolled = rolling.rolling_by_date(rows, ["source", "grade"], mean_days=[30], count_days=[], weight="card_year")
    return rolled.select("source", "grade", "sale_date", "vwap_30d").distinct()


BENCH_OUT = [
    "fighter_id",
    "grade_id",
    "benchmark_date",
    "sale_id",
    "vwap_7d",
    "vwap_30d",
    "vwap_90d",
    "sale_count_7d",
    "sale_count_30d",
    "price_pct_change_7d",
    "price_pct_change_30d",
]


@query(sql(f"SELECT {', '.join(BENCH_OUT)} FROM pct"), number="grade_id", text="benchmark_date")
def rolling_rows(spark, sf):
    return t.benchmarks(spark, sf, t.entities(spark, sf)).select(*BENCH_OUT)


@query(like("rolling_rows"), number="grade_id", text="benchmark_date")
def rolling_rows_blocks(spark, sf):
    """The same frames with groups above 1,000 sales cut into blocks."""
    return t.benchmarks(spark, sf, t.entities(spark, sf), hot_rows=1000).select(*BENCH_OUT)


# --- staging and marts ----------------------------------------------------------------------

STAGED_OUT = [
    "sale_id",
    "source_listing_id",
    "source",
    "sale_price_usd",
    "sale_date",
    "listing_title",
    "fighter_name_canonical",
    "card_year",
    "card_set",
    "card_number",
    "grade",
    "grader",
    "grade_numeric",
    "sale_type",
    "has_buyer_premium",
    "sport",
    "record_hash",
]


@query(sql(f"SELECT {', '.join(STAGED_OUT)} FROM staged"), number="sale_price_usd", text="sale_date")
def staging_one_scan(spark, sf):
    return marts.staged_sales(t.enriched(spark, sf), t.as_of_future()).select(*STAGED_OUT)


@query(like("staging_one_scan"), number="sale_price_usd", text="sale_date")
def union_sources(spark, sf):
    """The three staging models over the per-source raw tables, then their union."""
    rows = t.enriched(spark, sf, monthly=True).withColumn("processing_date", t.as_of())
    path = scratch_path(spark, "source_tables")
    sinks.write_source_tables(rows, path, grain="month", deal=False)
    stages = [
        marts.staged(scans.scan_table(spark, path, source), source, t.as_of_future())
        for source in fixed.STAGED_SOURCES
    ]
    return marts.unioned(stages).select(*STAGED_OUT)


@query(sql("SELECT * FROM dim_fighter"))
def dim_fighter(spark, sf):
    return marts.dim_fighter(t.seed(spark, sf))


@query(sql("SELECT * FROM dim_card"))
def dim_card(spark, sf):
    dim = t.entities(spark, sf)
    return marts.dim_card(t.resolved(spark, sf, dim), dim)


@query(sql("SELECT * FROM card_pairs"))
def dim_card_per_fighter(spark, sf):
    dim = t.entities(spark, sf)
    return marts.dim_card(t.resolved(spark, sf, dim), dim, per_fighter=True)


@query(sql("SELECT sale_id, fighter_name_canonical, fighter_id, fighter_sport, nationality FROM resolved"))
def resolve_dim(spark, sf):
    return t.resolved(spark, sf, t.entities(spark, sf)).select(
        "sale_id", "fighter_name_canonical", "fighter_id", "fighter_sport", "nationality"
    )


FACT_OUT = [c for c in marts.FACT_COLUMNS if c not in ("scraped_at", "ingested_at")]


@query(sql(f"SELECT {', '.join(FACT_OUT)} FROM fact"), number="sale_price_usd grade_id", text="sale_date")
def star_fact(spark, sf):
    return t.fact(spark, sf, t.entities(spark, sf)).select(*FACT_OUT)


@query(like("star_fact"), number="sale_price_usd grade_id", text="sale_date")
def star_fact_joined(spark, sf):
    """The fact with the card key looked up by a join instead of derived."""
    dim = t.entities(spark, sf)
    resolved = write_table(t.resolved(spark, sf, dim).select(*marts.RESOLVED_COLUMNS), "resolved")
    return marts.fct_card_sales(resolved, marts.dim_grade(spark), marts.dim_card(resolved, dim)).select(*FACT_OUT)


@query(
    sql(
        """SELECT s.listing_id, s.l_partkey, s.grader, s.grade_numeric, g.grade_id FROM sales s
           LEFT JOIN dim_grade g ON upper(trim(s.grader)) = upper(g.grader)
             AND s.grade_numeric IS NOT DISTINCT FROM g.grade_numeric"""
    ), number="grade_id")
def grade_join_raw(spark, sf):
    rows = marts.join_grade(t.sales(spark, sf), marts.dim_grade(spark), raw_match=True)
    return rows.select("listing_id", "l_partkey", "grader", "grade_numeric", "grade_id")


def _written_marts(spark, sf) -> scans.Layout:
    layout = scans.Layout(scratch_path(spark, "layout"))
    with scratch_scope(spark), shuffles_dropped(spark):  # what the source tables are made of goes before the marts are
        sinks.write_source_tables(t.enriched(spark, sf, monthly=True), layout.warehouse, grain="month", deal=False)
    marts.build_marts(spark, layout, t.as_of_future(), t.seed(spark, sf), grain="files")
    return layout


MARTS = {"dim_fighter": "dim_fighter", "dim_grade": "dim_grade", "dim_card": "dim_card", "fct_card_sales": "fact", "fct_price_benchmarks": "pct"}


@query(sql(" UNION ALL ".join(f"SELECT '{mart}' AS mart, count(*) AS records FROM {cte}" for mart, cte in MARTS.items())))
def build_marts(spark, sf):
    """Entry point B on disk: source tables in, five marts out."""
    layout = _written_marts(spark, sf)
    counts = [spark.read.parquet(layout.mart(m)).agg(F.lit(m).alias("mart"), F.count("*").alias("records")) for m in MARTS]
    return reduce(DataFrame.unionByName, counts)


def _mart(spark, sf, name):
    return spark.read.parquet(_written_marts(spark, sf).mart(name))


@query(sql(f"SELECT {', '.join(FACT_OUT)} FROM fact"), number="sale_price_usd grade_id", text="sale_date")
def mart_fact(spark, sf):
    """The contents of the written fact, read by its buckets."""
    return marts.read_fact(spark, _written_marts(spark, sf)).select(*FACT_OUT)


@query(sql(f"SELECT {', '.join(BENCH_OUT)} FROM pct"), number="grade_id", text="benchmark_date")
def mart_benchmarks(spark, sf):
    """The contents of the written benchmarks."""
    return _mart(spark, sf, "fct_price_benchmarks").select(*BENCH_OUT)


@query(sql("SELECT * FROM dim_card"))
def mart_cards(spark, sf):
    return _mart(spark, sf, "dim_card")


@query(sql("SELECT * FROM dim_fighter"))
def mart_fighters(spark, sf):
    return _mart(spark, sf, "dim_fighter")


@query(sql(f"SELECT {', '.join(FACT_OUT)} FROM fact"), number="sale_price_usd grade_id", text="sale_date")
def star_fact_bucketed(spark, sf):
    """The fact with its card looked up where sales and cards lie in the same buckets."""
    dim = t.entities(spark, sf)
    resolved = write_table(t.resolved(spark, sf, dim).select(*marts.RESOLVED_COLUMNS), "resolved")
    by = layouts.Buckets(tuple(marts.CARD_KEYS), tuple(marts.CARD_KEYS), 16)
    cards = layouts.save_bucketed(marts.dim_card(resolved, dim), scratch_path(spark, "cards"), by)
    sales = layouts.save_bucketed(resolved, scratch_path(spark, "sales"), by)
    joined = marts.join_card(sales, cards, co_located=True)
    return marts.join_grade(joined, marts.dim_grade(spark)).select(*FACT_OUT)


@query(
    """SELECT source, CAST(CAST(ts AS DATE) AS VARCHAR) AS sale_date, count(*) AS records, CAST(sum(event_id) AS BIGINT) AS ids
       FROM (SELECT *, CASE event_type WHEN 'view' THEN 'ebay' WHEN 'click' THEN 'pwcc' ELSE 'myslabs' END AS source FROM events)
       GROUP BY ALL"""
)
def source_days(spark, sf):
    """K3 by day: the events as rows of three sources, a folder per source and day, read source by source."""
    events = t.table(spark, sf, "events")
    source = F.when(F.col("event_type") == "view", "ebay").when(F.col("event_type") == "click", "pwcc").otherwise("myslabs")
    path = scratch_path(spark, "source_days")
    sinks.write_source_tables(events.withColumns({"source": source, "sale_date": F.to_date("ts"), "processing_date": t.as_of()}), path)
    rows = reduce(DataFrame.unionByName, (scans.scan_table(spark, path, s) for s in fixed.STAGED_SOURCES))
    return rows.groupBy("source", F.col("sale_date").cast("string").alias("sale_date")).agg(
        F.count("*").alias("records"), F.sum("event_id").alias("ids")
    )


# --- serving --------------------------------------------------------------------------------


def _star(spark, sf):
    dim = t.entities(spark, sf)
    return dim, marts.dim_grade(spark)


LABELLED = """FROM latest b JOIN dim_fighter f ON b.fighter_id = f.fighter_id JOIN dim_grade g ON b.grade_id = g.grade_id"""
OVERVIEW = f"""SELECT f.fighter_id, f.fighter_name_canonical AS fighter_name, f.sport, g.grade_label, b.vwap_7d, b.vwap_30d,
    b.sale_count_30d, b.price_pct_change_7d, b.price_pct_change_30d, b.benchmark_date {LABELLED}
    WHERE b.sale_count_30d >= 3 ORDER BY b.sale_count_30d DESC, f.fighter_id, g.grade_label LIMIT 100"""


def _overview(spark, sf):
    dim, grades = _star(spark, sf)
    return serving.market_overview(t.benchmarks(spark, sf, dim), dim, grades, t.as_of())


@query(sql(OVERVIEW), text="benchmark_date")
def overview_from_marts(spark, sf):
    """The overview as it is served: from written marts, of which it reads the files of one day."""
    layout = _written_marts(spark, sf)
    read = lambda mart: spark.read.parquet(layout.mart(mart))
    return serving.market_overview(read("fct_price_benchmarks"), read("dim_fighter"), read("dim_grade"), t.as_of())


@query(sql(OVERVIEW), text="benchmark_date")
def market_overview(spark, sf):
    return _overview(spark, sf)


@query(
    sql(
        f"""SELECT count(DISTINCT fighter_id) AS unique_fighters, CAST(coalesce(sum(sale_count_30d), 0) AS BIGINT) AS total_sales_30d,
            (SELECT fighter_name FROM ({OVERVIEW}) LIMIT 1) AS top_fighter FROM ({OVERVIEW})"""
    )
)
def market_kpis(spark, sf):
    return serving.market_kpis(_overview(spark, sf))


MOVERS = f"""SELECT f.fighter_id, f.fighter_name_canonical AS fighter_name, g.grade_label, b.vwap_7d, b.vwap_30d,
    b.price_pct_change_7d, b.sale_count_7d {LABELLED} WHERE b.sale_count_7d >= 2 AND b.price_pct_change_7d IS NOT NULL
    ORDER BY abs(b.price_pct_change_7d) DESC, f.fighter_id, g.grade_label LIMIT 20"""


def _movers(spark, sf, direction, limit):
    dim, grades = _star(spark, sf)
    return serving.top_movers(t.benchmarks(spark, sf, dim), dim, grades, t.as_of(), direction, limit)


@query(sql(f"SELECT * FROM ({MOVERS}) WHERE price_pct_change_7d > 0 ORDER BY price_pct_change_7d DESC, fighter_id, grade_label LIMIT 5"))
def top_movers_up(spark, sf):
    return _movers(spark, sf, "up", 5)


@query(sql(f"SELECT * FROM ({MOVERS}) WHERE price_pct_change_7d < 0 ORDER BY price_pct_change_7d, fighter_id, grade_label LIMIT 5"))
def top_movers_down(spark, sf):
    return _movers(spark, sf, "down", 5)


@query(sql(f"SELECT * FROM ({MOVERS}) ORDER BY abs(price_pct_change_7d) DESC, fighter_id, grade_label LIMIT 10"))
def top_movers_both(spark, sf):
    return _movers(spark, sf, "both", 10)


@query(
    sql(
        """SELECT f.fighter_id, f.fighter_name_canonical AS fighter_name, f.sport, f.promotion,
           max(b.vwap_30d) AS vwap_30d, CAST(sum(b.sale_count_30d) AS BIGINT) AS sale_count_30d
           FROM latest b JOIN dim_fighter f ON b.fighter_id = f.fighter_id WHERE b.sale_count_30d >= 1
           GROUP BY f.fighter_id, f.fighter_name_canonical, f.sport, f.promotion"""
    )
)
def list_fighters(spark, sf):
    dim, _ = _star(spark, sf)
    return serving.list_fighters(t.benchmarks(spark, sf, dim), dim, t.as_of())


@query(
    sql(
        """SELECT f.fighter_id, f.fighter_name_canonical AS fighter_name, f.sport, f.promotion,
           max(b.vwap_30d) AS vwap_30d
           FROM dim_fighter f LEFT JOIN latest b ON f.fighter_id = b.fighter_id
           WHERE contains(lower(f.fighter_name_canonical), 'g')
           GROUP BY f.fighter_id, f.fighter_name_canonical, f.sport, f.promotion
           ORDER BY fighter_name, f.fighter_id LIMIT 20"""
    )
)
def search_fighters(spark, sf):
    dim, _ = _star(spark, sf)
    return serving.search_fighters(t.benchmarks(spark, sf, dim), dim, "G", t.as_of())


@query(
    sql(
        """SELECT fighter_id, fighter_name_canonical, sport, promotion FROM dim_fighter
           WHERE fighter_id = (SELECT min(fighter_id) FROM dim_fighter)"""
    )
)
def fighter_metadata(spark, sf):
    dim, _ = _star(spark, sf)
    first = dim.agg(F.min("fighter_id")).first()[0]
    return serving.fighter_metadata(dim, first)


HISTORY = f"""SELECT b.fighter_id, b.benchmark_date AS date, g.grade_label, b.vwap_7d, b.vwap_30d, b.sale_count_30d AS sale_count
    FROM daily b JOIN dim_grade g ON b.grade_id = g.grade_id
    WHERE b.benchmark_date BETWEEN DATE '{AS_OF}' - INTERVAL 90 DAY AND DATE '{AS_OF}'"""


def _history(spark, sf):
    dim, grades = _star(spark, sf)
    return serving.price_history(t.benchmarks(spark, sf, dim), grades, t.as_of())


@query(sql(HISTORY), text="date")
def fighter_history(spark, sf):
    return _history(spark, sf)


LABELS = ["PSA 10", "PSA 9", "BGS 9.5", "BGS 9", "SGC 10"]


@query(
    sql(
        "SELECT fighter_id, date, "
        + ", ".join(f"max(vwap_30d) FILTER (WHERE grade_label = '{x}') AS \"{x}\"" for x in LABELS)
        + f" FROM ({HISTORY}) GROUP BY fighter_id, date"
    ), text="date")
def price_pivot(spark, sf):
    return serving.price_pivot(_history(spark, sf), LABELS)


@query(sql(f"SELECT DISTINCT fighter_id, grade_label FROM ({HISTORY})"))
def grade_labels(spark, sf):
    return serving.grade_labels(_history(spark, sf))


RECENT = """SELECT * EXCLUDE (rn) FROM (
    SELECT s.fighter_id, s.sale_id, s.source_listing_id, s.listing_title, CAST(s.sale_price_usd AS DOUBLE) AS sale_price_usd,
           s.sale_date, s.sale_type, s.source, s.listing_url, g.grade_label,
           row_number() OVER (PARTITION BY s.fighter_id ORDER BY s.sale_date DESC, s.sale_id) AS rn
    FROM fact s JOIN dim_grade g ON s.grade_id = g.grade_id WHERE s.fighter_id IS NOT NULL) WHERE rn <= 20"""


@query(sql(RECENT), text="sale_date")
def recent_sales(spark, sf):
    dim, grades = _star(spark, sf)
    return serving.recent_sales(t.fact(spark, sf, dim), grades)


@query(
    sql(
        f"""SELECT f.fighter_id, f.fighter_name_canonical AS fighter_name, f.sport, f.promotion,
            coalesce(h.n_points, 0) AS n_points, h.first_point, h.last_price, coalesce(r.n_sales, 0) AS n_sales,
            r.newest_title, r.oldest_title
            FROM dim_fighter f
            LEFT JOIN (SELECT fighter_id, count(*) AS n_points, min(date) AS first_point,
                              arg_max(vwap_30d, concat(CAST(date AS VARCHAR), grade_label)) AS last_price
                       FROM ({HISTORY}) GROUP BY fighter_id) h ON f.fighter_id = h.fighter_id
            LEFT JOIN (SELECT fighter_id, count(*) AS n_sales,
                              first(listing_title ORDER BY sale_date DESC, sale_id) AS newest_title,
                              last(listing_title ORDER BY sale_date DESC, sale_id) AS oldest_title
                       FROM ({RECENT}) GROUP BY fighter_id) r ON f.fighter_id = r.fighter_id"""
    ), text="first_point")
def fighter_detail(spark, sf):
    """The nested answer for all entities, summarised so that SQL can state it."""
    dim, grades = _star(spark, sf)
    rows = write_table(t.fact(spark, sf, dim), "fact")
    detail = serving.fighter_detail(marts.fct_price_benchmarks(rows), rows, dim, grades, t.as_of())
    points, latest = F.col("price_history"), F.col("recent_sales")
    return detail.select(
        "fighter_id",
        "fighter_name",
        "sport",
        "promotion",
        F.size(points).cast("long").alias("n_points"),
        F.get(points, F.lit(0))["date"].alias("first_point"),
        F.get(points, F.size(points) - 1)["vwap_30d"].alias("last_price"),
        F.size(latest).cast("long").alias("n_sales"),
        F.get(latest, F.lit(0))["listing_title"].alias("newest_title"),
        F.get(latest, F.size(latest) - 1)["listing_title"].alias("oldest_title"),
    )


def _detail(spark, sf):
    dim, grades = _star(spark, sf)
    rows = write_table(t.fact(spark, sf, dim), "fact")
    return serving.fighter_detail(marts.fct_price_benchmarks(rows), rows, dim, grades, t.as_of())


@query(
    sql(
        f"""SELECT fighter_id, CAST(row_number() OVER (PARTITION BY fighter_id ORDER BY date, grade_label) - 1 AS BIGINT) AS place,
                   date, grade_label, vwap_7d, vwap_30d, sale_count FROM ({HISTORY}) WHERE fighter_id IN (SELECT fighter_id FROM dim_fighter)"""
    ), text="date")
def fighter_detail_points(spark, sf):
    """Every price point of the nested answers, with its place in its list."""
    points = _detail(spark, sf).select("fighter_id", F.posexplode("price_history").alias("place", "p"))
    return points.select("fighter_id", F.col("place").cast("long").alias("place"), "p.*")


@query(
    sql(
        f"""SELECT fighter_id, CAST(row_number() OVER (PARTITION BY fighter_id ORDER BY sale_date DESC, sale_id) - 1 AS BIGINT) AS place,
                   listing_title, sale_price_usd, sale_date, sale_type, source, listing_url, grade_label
            FROM ({RECENT}) WHERE fighter_id IN (SELECT fighter_id FROM dim_fighter)"""
    ), text="sale_date")
def fighter_detail_sales(spark, sf):
    """Every recent sale of the nested answers, with its place in its list."""
    listed = _detail(spark, sf).select("fighter_id", F.posexplode("recent_sales").alias("place", "s"))
    return listed.select("fighter_id", F.col("place").cast("long").alias("place"), "s.*")


@query(
    sql(
        """SELECT count(*) AS total_records_in_fct_card_sales, count(DISTINCT fighter_id) AS fighters_with_coverage
           FROM fact"""
    )
)
def coverage(spark, sf):
    return monitor.coverage(t.fact(spark, sf, t.entities(spark, sf)))


# --- snapshot -------------------------------------------------------------------------------

FIRST, SECOND = "1998-03-31", "1998-06-30"
AT = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fighter_id, grade_id
           ORDER BY benchmark_date DESC, sale_id DESC) AS rn FROM pct
        WHERE benchmark_date <= DATE '{d}' AND fighter_id IS NOT NULL AND grade_id IS NOT NULL) WHERE rn = 1"""
# Keys that the second run no longer finds, and keys that the first doesn't find yet.
GONE, NEW = "ascii(fighter_id) % 7 = 3", "ascii(fighter_id) % 11 = 5"
SNAP = "fighter_id, grade_id, vwap_7d, vwap_30d, sale_count_30d"
N_SNAP = "n.fighter_id, n.grade_id, n.vwap_7d, n.vwap_30d, n.sale_count_30d"
O_SNAP = "o.fighter_id, o.grade_id, o.vwap_7d, o.vwap_30d, o.sale_count_30d"
DIFFERS = (
    "(o.vwap_30d IS DISTINCT FROM n.vwap_30d OR o.vwap_7d IS DISTINCT FROM n.vwap_7d "
    "OR o.sale_count_30d IS DISTINCT FROM n.sale_count_30d)"
)


def _snapshot_states(spark, sf):
    """The newest benchmarks of every key on the two days, each lacking some keys."""
    rows = write_table(t.benchmarks(spark, sf, t.entities(spark, sf)), "benchmarks")

    def state(day: str) -> DataFrame:
        so_far = rows.where(F.col("benchmark_date") <= F.lit(day).cast("date"))
        return dedup.first_per_key(
            so_far.dropna(subset=["fighter_id", "grade_id"]),
            ["fighter_id", "grade_id"],
            [F.col("benchmark_date").desc(), F.col("sale_id").desc()],
        )

    return state(FIRST).where(f"NOT ({NEW})"), state(SECOND).where(f"NOT ({GONE})")


def _at(day: str):
    return F.lit(day).cast("timestamp")


def _validity(history: DataFrame) -> DataFrame:
    return history.select(
        "fighter_id",
        "grade_id",
        "vwap_7d",
        "vwap_30d",
        "sale_count_30d",
        F.col("dbt_valid_from").cast("date").alias("valid_from"),
        F.col("dbt_valid_to").cast("date").alias("valid_to"),
    )


@query(
    sql(
        f"""SELECT {O_SNAP}, DATE '{FIRST}' AS valid_from,
                   CASE WHEN n.fighter_id IS NULL OR {DIFFERS} THEN DATE '{SECOND}' END AS valid_to
            FROM o LEFT JOIN n ON o.fighter_id = n.fighter_id AND o.grade_id = n.grade_id
            UNION ALL
            SELECT {N_SNAP}, DATE '{SECOND}', NULL FROM n
            LEFT JOIN o ON o.fighter_id = n.fighter_id AND o.grade_id = n.grade_id
            WHERE o.fighter_id IS NULL OR {DIFFERS}""",
        ("o", f"SELECT * FROM ({AT.format(d=FIRST)}) WHERE NOT ({NEW})"),
        ("n", f"SELECT * FROM ({AT.format(d=SECOND)}) WHERE NOT ({GONE})"),
    ), text="valid_from valid_to")
def scd2_snapshot(spark, sf):
    """Two snapshot runs over all benchmarks up to their day; the second lacks some keys."""
    first, second = _snapshot_states(spark, sf)
    return _validity(scd.apply_snapshot(scd.first_snapshot(first, _at(FIRST)), second, _at(SECOND)))


@query(like("scd2_snapshot"), text="valid_from valid_to")
def scd2_merged(spark, sf):
    """The same history by merge, the second run made twice."""
    first, second = _snapshot_states(spark, sf)
    store = Versions(spark, scratch_path(spark, "snapshot"))
    snapshots.merge_snapshot(store, first, _at(FIRST), buckets=16)
    snapshots.merge_snapshot(store, second, _at(SECOND))
    snapshots.merge_snapshot(store, second, _at("1998-12-31"))
    return _validity(snapshots.history(store))


# --- text -----------------------------------------------------------------------------------


@query(
    sql(
        r"""SELECT listing_id, l_partkey,
            CASE WHEN m.g <> '' THEN concat(upper(m.g), ' ', m.n)
                 WHEN regexp_matches(listing_title, '(?i)\braw\b') THEN 'Raw' END AS grade,
            CASE WHEN m.g <> '' THEN upper(m.g) WHEN regexp_matches(listing_title, '(?i)\braw\b') THEN 'Raw' END AS grader,
            TRY_CAST(nullif(m.n, '') AS DOUBLE) AS grade_numeric
            FROM (SELECT listing_id, l_partkey, listing_title, regexp_extract(listing_title,
                  '(?i)\b(PSA|BGS|SGC|CGC)\s*(10|[1-9](?:\.\d)?)\b', ['g', 'n']) AS m FROM sales)"""
    )
)
def grade_from_title(spark, sf):
    rows = t.sales(spark, sf).select("listing_id", "l_partkey", tx.grade_from_title("listing_title").alias("g"))
    return rows.select("listing_id", "l_partkey", "g.grade", "g.grader", "g.grade_numeric")


PRICE_TEXT = """CASE l_partkey % 5 WHEN 0 THEN concat('$', CAST(sale_price_usd AS STRING))
    WHEN 1 THEN concat('US $', CAST(sale_price_usd AS STRING), ' or Best Offer') WHEN 2 THEN 'n/a' WHEN 3 THEN '1.2.3'
    ELSE concat(CAST(l_partkey AS STRING), ',', '500') END"""


@query(
    sql(
        f"""SELECT listing_id, l_partkey, CASE WHEN l_partkey % 5 IN (0, 1) THEN sale_price_usd
            WHEN l_partkey % 5 = 4 THEN CAST(l_partkey * 1000 + 500 AS DECIMAL(12,2)) END AS price FROM sales"""
    ), number="price")
def price_text(spark, sf):
    rows = t.sales(spark, sf).withColumn("raw", F.expr(PRICE_TEXT))
    return rows.select("listing_id", "l_partkey", tx.price_from_text("raw").alias("price"))


@query(
    sql(
        f"""SELECT listing_id, l_partkey, CASE WHEN l_partkey % 6 = 5 THEN DATE '{AS_OF}' ELSE sale_date END AS parsed
            FROM sales"""
    ), text="parsed")
def date_text(spark, sf):
    """Five spellings and one unreadable text."""
    day = F.col("sale_date")
    spelled = (
        F.when(F.col("l_partkey") % 6 == 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:30:00.000Z")))
        .when(F.col("l_partkey") % 6 == 1, F.concat(F.lit("Sold "), F.date_format(day, "MMM d, yyyy")))
        .when(F.col("l_partkey") % 6 == 2, F.concat(F.lit("Sold on Tue "), F.date_format(day, "d MMMM yyyy")))
        .when(F.col("l_partkey") % 6 == 3, F.date_format(day, "M/d/yyyy"))
        .when(F.col("l_partkey") % 6 == 4, F.concat(F.lit("Sold: "), F.date_format(day, "MMMM dd yyyy")))
        .otherwise(F.lit("Ended 31/31/2020"))
    )
    rows = t.sales(spark, sf).withColumn("raw", spelled)
    return rows.select("listing_id", "l_partkey", tx.date_from_text("raw", t.as_of()).alias("parsed"))


@query(
    sql(
        """SELECT listing_id, l_partkey, CASE WHEN l_partkey % 9 IN (6, 7) THEN NULL ELSE sale_date END AS parsed,
               CASE WHEN l_partkey % 9 = 6 THEN 'unread' WHEN l_partkey % 9 = 7 THEN 'blank'
                    WHEN l_partkey % 9 IN (3, 8) AND day(sale_date) <= 12 AND day(sale_date) <> month(sale_date) THEN 'ambiguous'
                    ELSE 'read' END AS how
           FROM sales"""
    ), text="parsed")
def date_readings(spark, sf):
    """Seven spellings, one of them without a date, by the grammar of tokens; what can't be read is told."""
    day, kind = F.col("sale_date"), F.col("l_partkey") % 9
    spelled = (
        F.when(kind == 0, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T10:30:00.000Z")))
        .when(kind == 1, F.concat(F.lit("Sold for $12.50 on "), F.date_format(day, "MMM d, yyyy"), F.lit(" at 10:15 pm")))
        .when(kind == 2, F.concat(F.lit("Lot 17: ended Tue, the "), F.date_format(day, "d"), F.lit("th of "), F.date_format(day, "MMMM yyyy")))
        .when(kind == 3, F.date_format(day, "M/d/yyyy"))
        .when(kind == 4, F.concat(F.date_format(day, "yyyy MMMM "), F.lit("("), F.date_format(day, "dd"), F.lit(")")))
        .when(kind == 5, F.concat(F.lit("Ended "), F.date_format(day, "dd-MMM-yy")))
        .when(kind == 6, F.lit("Ended 31/31/2020"))
        .when(kind == 7, F.lit("  "))
        .otherwise(F.date_format(day, "MM.dd.yy"))
    )
    rows = t.sales(spark, sf).withColumn("found", dates.read_date(spelled))
    return rows.select("listing_id", "l_partkey", F.col("found.date").alias("parsed"), F.col("found.how").alias("how"))


@query(
    sql(
        r"""SELECT listing_id, l_partkey, nullif(array_to_string(list_transform(
               regexp_extract_all(trim(name), '[A-Za-z]+|[^A-Za-z]+'),
               lambda s: concat(upper(s[1]), lower(s[2:]))), ''), '') AS name
            FROM (SELECT listing_id, l_partkey, CASE WHEN l_partkey % 7 = 0 THEN '  '
                         ELSE concat(fighter_name, '''', lower(card_set), '-', l_suppkey, 'x ') END AS name FROM sales)"""
    )
)
def title_case(spark, sf):
    rows = t.sales(spark, sf).withColumn(
        "name",
        F.when(F.col("l_partkey") % 7 == 0, "  ").otherwise(
            F.expr(r"coalesce(fighter_name, '') || '\'' || lower(card_set) || '-' || l_suppkey || 'x '")
        ),
    )
    return rows.select("listing_id", "l_partkey", tx.title_case("name").alias("name"))


@query(
    sql(
        f"""SELECT listing_id, l_partkey, CASE WHEN l_partkey % 4 = 3 THEN NULL ELSE sale_date END AS sale_date,
            CASE l_partkey % 4 WHEN 1 THEN 'auction' WHEN 2 THEN 'auction' ELSE 'buy_it_now' END AS sale_type FROM sales"""
    ), text="sale_date")
def sold_line(spark, sf):
    wording = F.element_at(
        F.array(F.lit("Buy Now"), F.lit("Weekly Auction"), F.lit("Premier"), F.lit("nothing")),
        (F.col("l_partkey") % 4).cast("int") + 1,
    )
    line = F.when(
        F.col("l_partkey") % 4 < 3, F.concat(F.lit("Sold on "), F.date_format("sale_date", "MMM d, yyyy"), F.lit(" in "), wording)
    ).otherwise(F.lit("Available"))
    rows = t.sales(spark, sf).select("listing_id", "l_partkey", tx.sold_line(line).alias("s"))
    return rows.select("listing_id", "l_partkey", "s.sale_date", "s.sale_type")


@query(
    """SELECT page_id, CASE WHEN contains(url, '/itm/') THEN split_part(split_part(url, '/itm/', -1), '?', 1)
              ELSE right(url, 20) END AS item_id, split_part(rtrim(url, '/'), '/', -1) AS segment FROM pages"""
)
def url_ids(spark, sf):
    return t.table(spark, sf, "pages").select(
        "page_id", tx.item_id_from_url("url").alias("item_id"), tx.last_path_segment("url").alias("segment")
    )


@query(
    r"""SELECT doc_id, TRY_CAST(nullif(regexp_extract(text, '(\d+(?:\.\d+)?)', 1), '') AS DOUBLE) AS number FROM documents"""
)
def first_number(spark, sf):
    return t.table(spark, sf, "documents").select("doc_id", tx.first_number("text").alias("number"))


# A digit run with its optional wording: with wording the first 9 of at least 6 digits
# count, without it exactly 8.
CERT_HITS = r"""
    SELECT doc_id, pos, CASE WHEN worded THEN substr(run, 1, 9) ELSE run END AS digits
    FROM (SELECT doc_id, pos, regexp_extract(hit, '[0-9]+$') AS run, NOT regexp_matches(hit, '^[0-9]') AS worded
          FROM (SELECT doc_id, unnest(hits) AS hit, generate_subscripts(hits, 1) AS pos
                FROM (SELECT doc_id, regexp_extract_all(text,
                      '(?i)(?:\bcert(?:ificate)?\s*[:#]?\s*|PSA\s*cert\s*[:#]?\s*)?[0-9]+') AS hits FROM documents)))
    WHERE (worded AND length(run) >= 6) OR (NOT worded AND length(run) = 8)"""


@query(
    f"""SELECT cert_number, count(DISTINCT doc_id) AS mentions, min(doc_id) AS first_doc
        FROM (SELECT doc_id, coalesce(nullif(ltrim(digits, '0'), ''), '0') AS cert_number FROM ({CERT_HITS}))
        GROUP BY cert_number"""
)
def cert_numbers(spark, sf):
    found = certs.found_certs(t.table(spark, sf, "documents"), "text", "doc_id")
    return found.select("cert_number", "mentions", F.col("first_seen.doc_id").alias("first_doc"))


def _cert_flags(spark, sf):
    docs = t.table(spark, sf, "documents")
    found = certs.found_certs(docs, "text", "doc_id")
    cache = found.where(F.col("cert_number").endswith("7")).select(F.col("cert_number").alias("cert_key"))
    return certs.with_cached(found, cache)


CERTS = f"""SELECT cert_number, min(doc_id) AS first_doc, arg_min(pos, doc_id * 1000000 + pos) AS pos
    FROM (SELECT doc_id, pos, coalesce(nullif(ltrim(digits, '0'), ''), '0') AS cert_number FROM ({CERT_HITS}))
    GROUP BY cert_number"""


@query(
    f"""SELECT count(*) AS total, count(*) FILTER (WHERE cert_number LIKE '%7') AS cached,
        count(*) FILTER (WHERE cert_number NOT LIKE '%7') AS to_fetch FROM ({CERTS})"""
)
def cert_totals(spark, sf):
    return certs.cert_totals(_cert_flags(spark, sf))


@query(
    f"""SELECT cert_number, first_doc FROM ({CERTS}) WHERE cert_number NOT LIKE '%7'
        ORDER BY first_doc, pos, cert_number LIMIT 15"""
)
def cert_worklist(spark, sf):
    work = certs.worklist(_cert_flags(spark, sf), used_today=85)
    return work.select("cert_number", F.col("first_seen.doc_id").alias("first_doc"))


# --- payloads and pages ---------------------------------------------------------------------

PARSED_OUT = ["listing_id", "source", "sale_price_usd", "sale_date", "listing_title", "grade", "grader", "listing_url", "image_url", "sale_type"]
TITLE_GRADE = r"""
    CASE WHEN m.g <> '' THEN concat(upper(m.g), ' ', m.n) WHEN regexp_matches(listing_title, '(?i)\braw\b') THEN 'Raw' END AS grade,
    CASE WHEN m.g <> '' THEN upper(m.g) WHEN regexp_matches(listing_title, '(?i)\braw\b') THEN 'Raw' END AS grader"""
TITLED = r"""(SELECT *, regexp_extract(listing_title, '(?i)\b(PSA|BGS|SGC|CGC)\s*(10|[1-9](?:\.\d)?)\b', ['g', 'n']) AS m FROM sales)"""


@query(
    sql(
        f"""SELECT listing_id, 'ebay' AS source, sale_price_usd,
            CASE WHEN l_suppkey % 5 = 0 THEN DATE '{AS_OF}' ELSE sale_date END AS sale_date, listing_title, {TITLE_GRADE},
            listing_url, CASE WHEN l_partkey % 2 = 0 THEN 'https://img.example.com/1.jpg' END AS image_url,
            CASE WHEN l_partkey % 3 = 0 THEN 'auction' ELSE 'buy_it_now' END AS sale_type
            FROM {TITLED} WHERE l_partkey % 10 <> 0"""
    ), number="sale_price_usd", text="sale_date")
def api_payload(spark, sf):
    """Payloads of two items each: the sale, and one in another currency or without one."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    currency = F.when(part % 10 == 0, "EUR").when(part % 10 > 1, "USD")
    ended = F.when(supp % 5 == 0, "unknown").otherwise(F.date_format("sale_date", "yyyy-MM-dd'T'HH:mm:ss'Z'"))
    options = F.when(part % 3 == 0, F.array(F.lit("AUCTION"))).otherwise(F.array(F.lit("FIXED_PRICE")))

    def item(price, curr):
        return F.struct(
            F.col("listing_id").alias("itemId"),
            F.col("listing_title").alias("title"),
            F.struct(price.alias("value"), curr.alias("currency")).alias("price"),
            ended.alias("itemEndDate"),
            options.alias("buyingOptions"),
            F.col("listing_url").alias("itemWebUrl"),
            F.struct(F.when(part % 2 == 0, "https://img.example.com/1.jpg").alias("imageUrl")).alias("image"),
        )

    price = F.col("sale_price_usd").cast("string")
    items = F.array(item(price, currency), item(F.lit("n/a"), F.lit("USD")))
    payloads = t.sales(spark, sf).select(F.to_json(F.struct(items.alias("itemSummaries"))).alias("payload"))
    return parsing.api_sales(payloads, "payload", t.as_of()).select(*PARSED_OUT)


def _money(c: str = "sale_price_usd"):
    return F.concat(F.lit("$"), F.format_number(c, 2))


@query(
    sql(
        f"""SELECT listing_id, 'ebay' AS source, sale_price_usd, sale_date, listing_title, {TITLE_GRADE}, listing_url,
            'https://img.example.com/a.jpg' AS image_url, 'auction' AS sale_type FROM {TITLED}"""
    ), number="sale_price_usd", text="sale_date")
def listing_pages_ebay(spark, sf):
    """Stored result pages, derived per sale: a placeholder item and the sale."""
    html = F.concat(
        F.lit(
            '<ul><li class="s-item"><div class="s-item__title"><span>Shop on eBay</span></div>'
            '<span class="s-item__price">$20.00</span><a class="s-item__link" href="https://x.example.com/itm/1"></a></li>'
            '<li class="s-item s-item--new"><div class="s-item__info s-item__title"><span role="heading">'
        ),
        F.col("listing_title"),
        F.lit('</span></div><span class="s-item__price">US '),
        _money(),
        F.lit('</span><span class="s-item__ended-date">Sold '),
        F.date_format("sale_date", "MMM d, yyyy"),
        F.lit('</span><a target="_blank" class="s-item__link" href="'),
        F.col("listing_url"),
        F.lit('"><img class="s-item__image-img" src="https://img.example.com/a.jpg"></a></li></ul>'),
    )
    pages = t.sales(spark, sf, dear=True).select(html.alias("html"))
    return parsing.page_sales(pages, "html", t.as_of(), parsing.EBAY_PAGE).select(*PARSED_OUT)


@query(
    sql(
        f"""SELECT listing_id, 'ebay' AS source, sale_price_usd, sale_date, listing_title, {TITLE_GRADE}, listing_url,
            'https://img.example.com/a.jpg' AS image_url, 'auction' AS sale_type FROM {TITLED}"""
    ), number="sale_price_usd", text="sale_date")
def listing_pages_varied(spark, sf):
    """Result pages whose form varies by sale: quotes, order of attributes, wrappers, missing end tags,
    and names of the wanted elements in comments, scripts and values of other attributes."""
    form = F.col("l_partkey") % 4
    quote = F.when(form % 2 == 0, "'").otherwise('"')
    named = lambda tag, name, more="": F.concat(F.lit(f"<{tag} {more} data-class="), quote, F.lit("s-item s-item__title > x"), quote, F.lit(" class="), quote, F.lit(f"a {name}"), quote, F.lit(">"))
    wrapped = lambda c: F.when(form == 1, F.concat(F.lit("<b><i>"), c, F.lit("</i></b>"))).when(form == 2, F.concat(F.lit("<span><span>"), c, F.lit("</span></span>"))).otherwise(c)
    ends = lambda tags: F.when(form == 3, "").otherwise(tags)
    html = F.concat(
        F.lit("<body><!-- <li class='s-item'> --><script>var t = \"<li class='s-item'>\";</script><ul>"),
        named("li", "s-item", "id=x"),
        named("DIV", "s-item__title"),
        F.lit("<span>"),
        wrapped(F.col("listing_title")),
        ends("</span>"),
        F.lit("</div></em>"),
        named("span", "s-item__price"),
        wrapped(_money()),
        F.lit("</span><p>"),
        named("span", "s-item__ended-date"),
        F.date_format("sale_date", "MMM d, yyyy"),
        ends("</span></p>"),
        F.lit("<p><a href="),
        quote,
        F.col("listing_url"),
        quote,
        F.lit(" class='x s-item__link y'><img src=https://img.example.com/a.jpg class=s-item__image-img>"),
        ends("</a></p></li>"),
        F.lit("<li class='s-item'><div class='s-item__title'><span>Shop on eBay</span></div><span class='s-item__price'>$1</span>"),
        F.lit("<a class='s-item__link' href='https://x.example.com/itm/1'></a></ul>"),
    )
    pages = t.sales(spark, sf, dear=True).select(html.alias("html"))
    return parsing.page_sales(pages, "html", t.as_of(), parsing.EBAY_PAGE).select(*PARSED_OUT)


@query(
    sql(
        f"""SELECT listing_id, 'myslabs' AS source, sale_price_usd, sale_date, listing_title, {TITLE_GRADE},
            concat('https://www.myslabs.com/slab/view/', listing_id, '/') AS listing_url,
            'https://img.example.com/b.jpg' AS image_url,
            CASE WHEN l_partkey % 2 = 0 THEN 'auction' ELSE 'buy_it_now' END AS sale_type FROM {TITLED}"""
    ), number="sale_price_usd", text="sale_date")
def listing_pages_myslabs(spark, sf):
    icon = F.when(F.col("l_partkey") % 2 == 0, "/static/auction.svg").otherwise("/static/fixed-price.svg")
    html = F.concat(
        F.lit('<div class="row"><div class="col slab_item"><a href="/slab/view/'),
        F.col("listing_id"),
        F.lit('/"><img data-src="https://img.example.com/b.jpg" alt="'),
        F.col("listing_title"),
        F.lit('"></a><div class="slab-title">'),
        F.when(F.col("l_partkey") % 3 == 0, "").otherwise(F.col("listing_title")),
        F.lit('</div><div class="item-price">'),
        _money(),
        F.lit('<i class="tip">incl. 1%</i></div><img src="'),
        icon,
        F.lit('"><div class="slab-details"><small class="d">'),
        F.date_format("sale_date", "M/d/yyyy"),
        F.lit("</small></div></div></div>"),
    )
    pages = t.sales(spark, sf, dear=True).select(html.alias("html"))
    return parsing.page_sales(pages, "html", t.as_of(), parsing.MYSLABS_PAGE).select(*PARSED_OUT)


@query(
    sql(
        f"""SELECT listing_id, 'pwcc' AS source, sale_price_usd, sale_date, listing_title, {TITLE_GRADE},
            concat('https://www.fanaticscollect.com/',
                   CASE l_partkey % 2 WHEN 0 THEN 'buy-now/' ELSE 'weekly-auction/' END, listing_id) AS listing_url,
            'https://img.example.com/c.jpg' AS image_url,
            CASE l_partkey % 2 WHEN 0 THEN 'buy_it_now' ELSE 'auction' END AS sale_type FROM {TITLED}"""
    ), number="sale_price_usd", text="sale_date")
def listing_pages_pwcc(spark, sf):
    section = F.when(F.col("l_partkey") % 2 == 0, "buy-now/").otherwise("weekly-auction/")
    wording = F.when(F.col("l_partkey") % 2 == 0, "Buy Now").otherwise("Weekly Auction")
    html = F.concat(
        F.lit('<div class="card"><a class="css-1" href="https://www.fanaticscollect.com/'),
        section,
        F.col("listing_id"),
        F.lit('"></a><img alt="Card image" src="https://img.example.com/c.jpg"><p class="chakra-text css-2">'),
        _money(),
        F.lit('</p><p class="chakra-text css-3">'),
        F.col("listing_title"),
        F.lit('</p><p class="chakra-text css-4">Sold on '),
        F.date_format("sale_date", "MMM d, yyyy"),
        F.lit(" in "),
        wording,
        F.lit("</p></div>"),
    )
    pages = t.sales(spark, sf, dear=True).select(html.alias("html"))
    return parsing.page_sales(pages, "html", t.as_of(), parsing.PWCC_PAGE).select(*PARSED_OUT)


@query(
    """SELECT page_id, url, regexp_extract(url, '([^/]*)/*$', 1) AS last_segment,
              nullif(trim(replace(replace(replace(replace(regexp_extract(html, '<h1[^>]*>([^<]*)', 1), '&lt;', '<'), '&gt;', '>'),
                     '&quot;', '"'), '&amp;', '&')), '') AS heading
       FROM pages"""
)
def stored_page_headings(spark, sf):
    """The given pages: the last part of the address and the decoded heading."""
    heading = F.regexp_extract(F.col("html"), "<h1[^>]*>([^<]*)", 1)
    return t.table(spark, sf, "pages").select(
        "page_id", "url", tx.last_path_segment("url").alias("last_segment"), tx.blank_to_null(tx.html_text(heading)).alias("heading")
    )


# --- monitoring -----------------------------------------------------------------------------

STATUS_OUT = [
    "source",
    "last_run_records_written",
    "last_run_records_invalid",
    "last_run_records_duplicate",
    "last_run_records_unwritten",
    "lag_hours",
    "status",
]


@query(sql("SELECT source, run_id, completed_at, records_written FROM latest_runs"), text="completed_at")
def latest_run(spark, sf):
    return monitor.latest_runs(t.runs(spark, sf)).select("source", "run_id", "completed_at", "records_written")


@query(sql("""SELECT source, run_id, records_written FROM (
    SELECT *, row_number() OVER (PARTITION BY source ORDER BY completed_at DESC, run_id DESC) AS rn
    FROM (SELECT * REPLACE (concat(source, '-', records_written % 5) AS source) FROM runs)) WHERE rn = 1 AND records_written = 0"""))
def zero_output(spark, sf):
    finer = t.runs(spark, sf).withColumn("source", F.concat("source", F.lit("-"), F.col("records_written") % 5))
    return monitor.zero_output(finer)


@query(sql(f"SELECT {', '.join(STATUS_OUT)} FROM status"))
def run_status(spark, sf):
    return monitor.source_status(t.runs(spark, sf), t.runs_as_of()).select(*STATUS_OUT)


@query(sql("""SELECT CASE max(CASE status WHEN 'error' THEN 3 WHEN 'stale' THEN 2 WHEN 'degraded' THEN 1 ELSE 0 END)
    WHEN 3 THEN 'error' WHEN 2 THEN 'stale' WHEN 1 THEN 'degraded' ELSE 'healthy' END AS overall_status FROM status"""))
def worst_status(spark, sf):
    return monitor.overall_status(monitor.source_status(t.runs(spark, sf), t.runs_as_of()))


@query(sql(f"SELECT {', '.join(STATUS_OUT)} FROM status WHERE source = 'view'"))
def source_metrics(spark, sf):
    return monitor.source_metrics(t.runs(spark, sf), "view", t.runs_as_of()).select(*STATUS_OUT)


@query(sql(f"""SELECT (SELECT count(*) FROM status) AS n_sources,
    (SELECT lag_hours FROM status WHERE source = 'click') AS click_lag,
    (SELECT CASE max(CASE status WHEN 'error' THEN 3 WHEN 'stale' THEN 2 WHEN 'degraded' THEN 1 ELSE 0 END)
            WHEN 3 THEN 'error' WHEN 2 THEN 'stale' WHEN 1 THEN 'degraded' ELSE 'healthy' END FROM status) AS overall_status,
    (SELECT count(*) FROM fact) AS total_records_in_fct_card_sales,
    (SELECT count(DISTINCT fighter_id) FROM fact) AS fighters_with_coverage"""))
def run_summary(spark, sf):
    summary = monitor.run_summary(t.runs(spark, sf), t.fact(spark, sf, t.entities(spark, sf)), t.runs_as_of())
    return summary.select(
        F.size("sources").cast("long").alias("n_sources"),
        F.col("sources")["click"]["lag_hours"].alias("click_lag"),
        "overall_status",
        "total_records_in_fct_card_sales",
        "fighters_with_coverage",
    )


RUN_OUT = ["source", "run_id", "started_at", "completed_at", "records_scraped", "records_valid", "records_new", "records_written"]


@query(sql(f"SELECT {', '.join(RUN_OUT)} FROM runs ORDER BY completed_at DESC, run_id DESC LIMIT 30"), text="completed_at started_at")
def run_history(spark, sf):
    return monitor.run_history(t.runs(spark, sf)).select(*RUN_OUT)


@query(sql("""SELECT completed_at, source, run_id, error FROM (
    SELECT completed_at, source, run_id, unnest(errors) AS error, generate_subscripts(errors, 1) AS pos
    FROM (SELECT * FROM runs ORDER BY completed_at DESC, run_id DESC LIMIT 20))
    ORDER BY completed_at DESC, run_id DESC, pos LIMIT 10"""), text="completed_at")
def recent_errors(spark, sf):
    return monitor.recent_errors(t.runs(spark, sf))


@query(sql("""SELECT started_at, source, records_written FROM
    (SELECT * FROM runs ORDER BY completed_at DESC, run_id DESC LIMIT 60) WHERE started_at IS NOT NULL"""), text="started_at")
def records_over_time(spark, sf):
    return monitor.records_over_time(t.runs(spark, sf))


@query(
    sql(
        f"""SELECT t.source, t.records_scraped, t.records_valid, coalesce(n.records_new, 0) AS records_new,
            coalesce(n.records_new, 0) AS records_written, coalesce(e.errors, '') AS errors
            FROM (SELECT source, count(*) AS records_scraped, count(*) FILTER (WHERE errors = '') AS records_valid
                  FROM checked GROUP BY source) t
            LEFT JOIN (SELECT source, count(DISTINCT record_hash) AS records_new FROM checked c
                       WHERE errors = '' AND NOT EXISTS (SELECT 1 FROM sales s WHERE s.record_hash = c.record_hash AND s.{SEEN})
                       GROUP BY source) n ON t.source = n.source
            LEFT JOIN (SELECT source, string_agg(concat(error, ':', n), '; ' ORDER BY error) AS errors
                       FROM (SELECT source, e.error, count(*) AS n FROM checked x, unnest(string_split(errors, '; ')) AS e(error)
                             WHERE errors <> '' GROUP BY source, e.error) GROUP BY source) e ON t.source = e.source""",
        ("checked", f"SELECT *, {ERRORS_SQL} AS errors FROM ({DIRTY})"),
    )
)
def batch_counters(spark, sf):
    seen = t.sales(spark, sf).where(SEEN)
    validated = write_table(validate.validate_sales(_dirty(spark, sf), YEAR), "validated")
    counters = monitor.batch_counters(validated, seen)
    listed = F.transform("errors", lambda e: F.concat_ws(":", e["error"], e["records"].cast("string")))
    return counters.withColumn("errors", F.concat_ws("; ", listed))


# --- persistence ----------------------------------------------------------------------------

RAW_OUT = ["listing_id", "source", "sale_price_usd", "sale_date", "listing_title", "grade_numeric", "record_hash"]


def _raw_records(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SALE.fields])


@query(sql(f"SELECT {', '.join(RAW_OUT)} FROM sales WHERE source = 'pwcc'"), number="sale_price_usd", text="sale_date")
def roundtrip_raw(spark, sf):
    """NDJSON folders by ingest date, read back for one source."""
    path = scratch_path(spark, "raw")
    sinks.append_raw(_raw_records(t.sales(spark, sf)), path, t.as_of())
    parsed, _ = scans.split_corrupt(scans.scan_raw(spark, path, "pwcc"))
    return parsed.select(*RAW_OUT)


@query(sql(f"SELECT {', '.join(RAW_OUT)} FROM sales"), number="sale_price_usd", text="sale_date")
def roundtrip_stage(spark, sf):
    """All sources written, two of them wrongly; a second write replaces just these."""
    path = scratch_path(spark, "stage")
    rows = t.stored_sales(spark, sf).withColumn("processing_date", t.as_of())
    late = F.col("source").isin("ebay", "goldin")
    sinks.write_stage(rows.withColumn("listing_id", F.when(late, "old").otherwise(F.col("listing_id"))), path)
    sinks.write_stage(rows.where(late), path)
    return scans.scan_stage(spark, path).select(*RAW_OUT)


@query(sql("SELECT listing_title FROM sales"))
def roundtrip_titles(spark, sf):
    path = scratch_path(spark, "raw_titles")
    sinks.append_raw(_raw_records(t.sales(spark, sf)), path, t.as_of())
    return scans.scan_titles(spark, path)


@query(like("set_union"))
def roundtrip_seen(spark, sf):
    seen, batch = _seen_and_batch(spark, sf)
    first, second = scratch_path(spark, "seen"), scratch_path(spark, "seen")
    sinks.save_seen(scans.scan_seen(spark, first), seen, first)
    sinks.save_seen(scans.scan_seen(spark, first), batch, second)
    return scans.scan_seen(spark, second)


@query(sql("SELECT source, run_id, started_at, records_written, coalesce(len(errors), 0) AS n_errors FROM runs"), text="started_at")
def roundtrip_run_log(spark, sf):
    path = scratch_path(spark, "runs")
    sinks.append_run_log(t.runs(spark, sf), path)
    back = scans.scan_run_log(spark, path, documents=False)
    return back.select(
        "source",
        "run_id",
        F.col("started_at").cast("timestamp_ntz").alias("started_at"),
        "records_written",
        F.coalesce(F.size("errors"), F.lit(0)).cast("long").alias("n_errors"),
    )


@query(like("run_status"))
def roundtrip_status(spark, sf):
    path = scratch_path(spark, "status")
    sinks.append_status(monitor.source_status(t.runs(spark, sf), t.runs_as_of()), path)
    return spark.read.parquet(path).select(*STATUS_OUT)


@query(
    sql(
        """SELECT fighter_name_canonical, grade, count(*) AS sales, CAST(max(n) AS BIGINT) AS busiest_30d,
                  min(vwap_30d) AS lowest_vwap_30d, max(vwap_30d) AS highest_vwap_30d,
                  max((CAST(sale_price_usd AS DOUBLE) - vwap_30d) / vwap_30d * 100) AS highest_change_30d
           FROM (SELECT *, count(*) OVER w AS n, CAST(sum(sale_price_usd) OVER w AS DOUBLE) / count(sale_price_usd) OVER w AS vwap_30d
                 FROM (SELECT s.*, d.canonical AS fighter_name_canonical,
                              coalesce(CAST(s.sale_price_usd AS DOUBLE) < b.q1 - 3.0 * (b.q3 - b.q1)
                                       OR CAST(s.sale_price_usd AS DOUBLE) > b.q3 + 3.0 * (b.q3 - b.q1), FALSE) AS is_outlier
                       FROM raw_latest s JOIN dictionary d ON d.priority = s.l_partkey % 120
                       LEFT JOIN (SELECT source, grade, quantile_disc(CAST(sale_price_usd AS DOUBLE), 0.25) AS q1,
                                         quantile_disc(CAST(sale_price_usd AS DOUBLE), 0.75) AS q3
                                  FROM raw_latest GROUP BY source, grade) b
                         ON s.source = b.source AND s.grade = b.grade)
                 WHERE grade IS NOT NULL AND grader IS NOT NULL AND NOT is_outlier
                 WINDOW w AS (PARTITION BY fighter_name_canonical, grade, grader ORDER BY sale_date
                              RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND CURRENT ROW))
           GROUP BY fighter_name_canonical, grade""",
        ("dictionary", f"SELECT * FROM (VALUES {FIXED_ALIASES}) v(priority, alias, canonical)"),
        (
            "raw_latest",
            """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY record_hash
                      ORDER BY scraped_at DESC, sale_price_usd DESC, listing_title DESC) AS rn FROM sales) WHERE rn = 1""",
        ),
    )
)
def stages_end_to_end(spark, sf):
    """Raw NDJSON through all four stages on disk, two days in a row, with the built-in dictionary."""
    layout = scans.Layout(scratch_path(spark, "layout"))
    names = F.create_map(*[F.lit(x) for i, alias, _ in resolve.alias_rows() for x in (i, alias)])
    named = t.sales(spark, sf).withColumn(
        "fighter_name", F.try_element_at(names, (F.col("l_partkey") % 120).cast("int"))
    )
    sinks.append_raw(_raw_records(named), layout.raw, t.as_of())
    ingest.run_stages(spark, layout, as_of=dt.datetime(1998, 12, 2))
    ingest.run_stages(spark, layout, as_of=dt.datetime(1998, 12, 3))
    return spark.read.parquet(layout.benchmarks).groupBy("fighter_name_canonical", "grade").agg(
        F.count("*").alias("sales"),
        F.max("sale_count_30d").alias("busiest_30d"),
        F.min("vwap_30d").alias("lowest_vwap_30d"),
        F.max("vwap_30d").alias("highest_vwap_30d"),
        F.max("price_pct_change_30d").alias("highest_change_30d"),
    )


def _sales_stream(spark, sf) -> DataFrame:
    """The lineitem file and its part join as a stream."""
    schema = t.table(spark, sf, "lineitem").schema
    spark.readStream.schema(schema).option("pathGlobFilter", "lineitem.parquet").parquet(sf).createOrReplaceTempView(
        "lineitem_stream"
    )
    t.table(spark, sf, "part").createOrReplaceTempView("part")
    rows = spark.sql(t.SALES.replace("FROM lineitem", "FROM lineitem_stream"))
    return rows.withColumn("record_hash", fs.record_hash())


@query(sql("SELECT record_hash, count(*) AS copies FROM (SELECT DISTINCT record_hash FROM sales) GROUP BY record_hash"))
def stream_dedup(spark, sf):
    """Deduplicated by keyed state."""
    path, state = scratch_path(spark, "stream"), scratch_path(spark, "stream_state")
    kept = streaming.stream_dedup(_sales_stream(spark, sf)).select("record_hash")
    writer = kept.writeStream.format("parquet").option("checkpointLocation", state).option("path", path)
    writer.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(kept.schema).parquet(path).groupBy("record_hash").agg(F.count("*").alias("copies"))


@query(like("keep_latest"), number="sale_price_usd", text="sale_date")
def append_new(spark, sf):
    """Deduplicated against what earlier batches have written, in one batch."""
    path, state = scratch_path(spark, "stream"), scratch_path(spark, "stream_state")
    streaming.append_new(_sales_stream(spark, sf), path, state, ties=t.TIES).awaitTermination()
    return spark.read.parquet(path).select(*SALE_OUT, "l_partkey")


@query(
    sql(
        f"""SELECT {SALE_SQL}, l_partkey FROM (SELECT *, row_number() OVER (PARTITION BY record_hash ORDER BY l_partkey % 4,
                scraped_at DESC, l_partkey DESC, l_suppkey DESC, sale_price_usd DESC, grade DESC NULLS LAST) AS rn FROM sales)
            WHERE rn = 1"""
    ), number="sale_price_usd", text="sale_date")
def append_batches(spark, sf):
    """Four batches appended to compacted folders: of each key the first batch's newest row."""
    rows = t.stored_sales(spark, sf)
    path = scratch_path(spark, "appended")
    write = compact.appender(spark, path, ties=t.TIES, buckets=8, fanout=3, written=True)
    for batch in range(4):
        write(rows.where(F.col("l_partkey") % 4 == batch), batch)
    return compact.read_appended(spark, path).select(*SALE_OUT, "l_partkey")


@query(like("keep_latest"), number="sale_price_usd", text="sale_date")
def stream_newest(spark, sf):
    """The newest row of each key by keyed state: the sales arrive in several batches, in no order."""
    path = scratch_path(spark, "newest")
    with scratch_scope(spark), shuffles_dropped(spark):  # arrivals and state go once all have arrived
        folder, state = scratch_path(spark, "arrivals"), scratch_path(spark, "newest_state")
        rows = t.sales(spark, sf)
        # As many files as cores have: a batch rewrites the state, so their number should not grow with the table.
        files = rows.withColumn("part", F.col("l_partkey") % 4).coalesce(spark.sparkContext.defaultParallelism)
        files.write.option("compression", CODEC).partitionBy("part").parquet(folder)
        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema)
        stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 16).parquet(folder).select(*rows.columns)
        newest.write_newest(stream, path, state, ties=t.TIES, lateness="7300 days").awaitTermination()
    return newest.keep_newest(spark.read.parquet(path), ties=t.TIES).select(*SALE_OUT, "l_partkey")


# --- operators whose only evidence were tests --------------------------------------------------


@query(
    sql(
        f"""SELECT listing_id, source, TIMESTAMP '{AS_OF} 06:00:00' AS ingested_at, DATE '{AS_OF}' AS processing_date,
                   TRUE AS from_own_folder FROM sales"""
    ), text="ingested_at processing_date")
def audit_trail(spark, sf):
    """P1 over raw files: when a row was ingested, and from which file."""
    path = scratch_path(spark, "raw_audit")
    sinks.append_raw(_raw_records(t.sales(spark, sf)), path, t.as_of())
    parsed, _ = scans.split_corrupt(scans.scan_raw(spark, path))
    stamped = parsed.withColumns(fs.audit_columns(F.lit(f"{AS_OF} 06:00:00")))
    folder = F.concat(F.lit("/source="), F.col("source"), F.lit("/"))
    return stamped.select("listing_id", "source", F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at"), "processing_date",
        F.contains("source_file", folder).alias("from_own_folder"))


@query(sql(f"SELECT listing_id, l_partkey, grade_numeric FROM ({DIRTY}) WHERE grade_numeric < 1 OR grade_numeric > 10"))
def grade_range(spark, sf):
    return checks.grades_out_of_range(_dirty(spark, sf)).select("listing_id", "l_partkey", "grade_numeric")


@query(sql("SELECT DISTINCT CAST(l_partkey AS VARCHAR) AS cert_key, CASE WHEN l_partkey % 4 > 0 THEN l_partkey % 10 + 0.5 END AS grade_numeric FROM sales"))
def cert_cache(spark, sf):
    """JSON documents that map certificates to their records, some missing, 1000 numbers each."""
    keys = t.sales(spark, sf).select("l_partkey").distinct().withColumn("book", F.floor(F.col("l_partkey") / 1000))
    name = F.col("l_partkey").cast("string")
    record = F.when(F.col("l_partkey") % 4 > 0, F.struct(name.alias("cert_number"), (F.col("l_partkey") % 10 + 0.5).alias("grade_numeric")))
    entry = F.concat(F.to_json(F.struct(name.alias("k"))).substr(F.lit(6), F.length(name) + 2), F.lit(": "),
                     F.coalesce(F.to_json(record), F.lit("null")))
    listed = F.concat_ws(", ", F.collect_list(entry))
    documents = keys.groupBy("book").agg(F.concat(F.lit('{"_meta": null, '), listed, F.lit("}")).alias("value"))
    path = scratch_path(spark, "certs")
    documents.write.partitionBy("book").text(path)
    cached = scans.scan_cert_cache(spark, path)
    return cached.select("cert_key", F.col("cert.grade_numeric").alias("grade_numeric"))


@query(sql(f"SELECT DISTINCT record_hash FROM sales WHERE {SEEN}"))
def seen_json(spark, sf):
    """JSON arrays of hashes, a document for 500 orders."""
    book = F.floor(F.split_part("listing_id", F.lit("-"), F.lit(1)).cast("long") / 500).alias("book")
    seen = t.sales(spark, sf).where(SEEN).groupBy(book).agg(F.to_json(F.collect_set("record_hash")).alias("value"))
    path = scratch_path(spark, "seen_json")
    seen.write.partitionBy("book").text(path)
    return scans.scan_seen_json(spark, path)


@query(sql("SELECT source, run_id, started_at, records_written, coalesce(len(errors), 0) AS n_errors FROM latest_runs"), text="started_at")
def run_documents(spark, sf):
    """S6 as documents of several lines, one per source, beside one that can't be read."""
    newest = monitor.latest_runs(t.runs(spark, sf))
    path = scratch_path(spark, "run_documents")
    whole = F.struct("source", "run_id", F.date_format("started_at", sinks.MICROS).alias("started_at"), "records_written", "errors")
    newest.select("source", F.to_json(whole, {"pretty": "true"}).alias("value")).write.partitionBy("source").text(path)
    spark.createDataFrame([("broken", "{oops")], "source string, value string").write.mode("append").partitionBy("source").text(path)
    back = scans.scan_run_log(spark, path)
    return back.select("source", "run_id", F.col("started_at").cast("timestamp_ntz").alias("started_at"), "records_written",
        F.coalesce(F.size("errors"), F.lit(0)).cast("long").alias("n_errors"))


@query(
    sql(
        f"""SELECT 'new' AS kind, count(DISTINCT record_hash) AS records FROM ({DIRTY}) c WHERE {ERRORS_SQL} = ''
                   AND NOT EXISTS (SELECT 1 FROM sales s WHERE s.record_hash = c.record_hash AND s.{SEEN})
            UNION ALL SELECT 'quarantined', count(*) FROM ({DIRTY}) WHERE {ERRORS_SQL} <> ''"""
    )
)
def capture(spark, sf):
    """Entry point D: a batch validated, split, and reduced to what was not seen before."""
    fresh, quarantine = ingest.capture(_dirty(spark, sf), t.sales(spark, sf).where(SEEN), YEAR)
    count = lambda kind, df: df.agg(F.count("*").alias("records")).select(F.lit(kind).alias("kind"), "records")
    return count("new", fresh).unionByName(count("quarantined", quarantine))
