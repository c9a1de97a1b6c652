"""Views of the given tables that stand for sales, aliases and run logs.

The SELECT texts run unchanged in Spark SQL and in the oracle's SQL.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hammerline.functions.sales import normalised_sale_type, record_hash, sport, stage_premium
from hammerline.operators.dedup import keep_latest
from hammerline.operators.outliers import flag_outliers
from hammerline.operators.resolve import resolve_entities
from hammerline.plans import marts
from hammerline.session import materialise, spread_evenly, spread_small, write_table

AS_OF = "1998-06-30"
RUNS_AS_OF = "2024-01-31 07:45:00"
# Tables whose small test files are spread over the cores, and by which key.
SPREAD = {"lineitem": "l_orderkey", "events": "event_id"}
# Together with the time these decide between copies of a sale.
TIES = ["l_partkey", "l_suppkey", "sale_price_usd", "grade"]

SALES = """
SELECT concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING)) AS listing_id,
       CASE l_suppkey % 4 WHEN 0 THEN 'ebay' WHEN 1 THEN 'pwcc' WHEN 2 THEN 'myslabs' ELSE 'goldin' END AS source,
       l_shipdate AS scraped_at,
       CAST(CASE WHEN l_orderkey % 97 = 0 THEN l_extendedprice * 8 ELSE l_extendedprice END AS DECIMAL(12,2))
           AS sale_price_usd,
       CAST(l_shipdate AS DATE) AS sale_date,
       concat('UFC ', p_brand, ' ', p_name, ' ',
              CASE l_returnflag WHEN 'A' THEN 'PSA' WHEN 'R' THEN 'BGS' ELSE 'raw' END, ' ',
              CASE l_linenumber % 3 WHEN 0 THEN '10' WHEN 1 THEN '9.5' ELSE '9' END) AS listing_title,
       CASE WHEN l_partkey % 5 = 0 THEN NULL ELSE concat(' ', upper(p_name)) END AS fighter_name,
       CAST(1990 + p_size % 30 AS INT) AS card_year, p_brand AS card_set, p_type AS card_number,
       CASE l_returnflag WHEN 'A' THEN 'PSA' WHEN 'R' THEN 'BGS'
            ELSE CASE WHEN l_linestatus = 'F' THEN 'SGC' END END AS grader,
       CAST(CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
                 ELSE CASE l_linenumber % 3 WHEN 0 THEN 10.0 WHEN 1 THEN 9.5 ELSE 9.0 END END AS DOUBLE)
           AS grade_numeric,
       CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN NULL
            ELSE concat(CASE l_returnflag WHEN 'A' THEN 'PSA' WHEN 'R' THEN 'BGS' ELSE 'SGC' END, ' ',
                        CASE l_linenumber % 3 WHEN 0 THEN '10' WHEN 1 THEN '9.5' ELSE '9' END) END AS grade,
       concat('https://shop.example.com/itm/', CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING),
              '?hash=', CAST(l_suppkey AS STRING)) AS listing_url,
       CAST(NULL AS STRING) AS image_url,
       CASE l_linenumber % 4 WHEN 0 THEN 'auction' WHEN 1 THEN 'buy_it_now' WHEN 2 THEN 'best_offer'
            ELSE 'other' END AS sale_type,
       l_partkey, l_suppkey
FROM lineitem JOIN part ON l_partkey = p_partkey
"""

SALES_FROM = "FROM lineitem JOIN part ON l_partkey = p_partkey"

ALIASES = """
SELECT min(p_partkey) AS priority, lower(p_name) AS alias, split_part(lower(p_name), ' ', -1) AS canonical
FROM part GROUP BY lower(p_name), split_part(lower(p_name), ' ', -1)
"""

# Aliases as users write them: short, padded, in capitals, repeated, blank and missing.
ODD_ALIASES = f"""
SELECT CAST(priority AS BIGINT) AS priority, alias, canonical FROM ({ALIASES})
UNION ALL SELECT CAST(priority AS BIGINT) AS priority, alias, canonical FROM (VALUES
    (-1, 'q', 'One'), (-2, ' ZZ ', 'Two'), (-3, '', 'Empty'), (-4, NULL, 'Missing'), (-5, '   ', 'Blank'),
    (-6, ' Anodized', 'Padded'), (-7, 'anodized', 'Repeated'), (-8, 'ivory', NULL)) v(priority, alias, canonical)
"""

SEED = """
SELECT DISTINCT split_part(lower(p_name), ' ', -1) AS fighter_name_canonical,
       lower(p_name) AS fighter_name_alias,
       CASE WHEN length(split_part(lower(p_name), ' ', -1)) % 2 = 0 THEN 'MMA' ELSE 'BOXING' END AS sport,
       split_part(lower(p_name), ' ', 1) AS nationality,
       CASE WHEN ascii(split_part(lower(p_name), ' ', -1)) % 3 = 0 THEN 'UFC' END AS promotion,
       ascii(split_part(lower(p_name), ' ', -1)) % 2 = 0 AS active,
       CAST(1990 + ascii(split_part(lower(p_name), ' ', -1)) % 30 AS BIGINT) AS debut_year
FROM part
"""

RUNS = """
SELECT event_type AS source, lpad(CAST(event_id AS STRING), 12, '0') AS run_id,
       ts AS started_at, ts + INTERVAL 5 MINUTE AS completed_at,
       CAST(floor(value) AS INT) + CAST(user_id % 5 AS INT) + CAST(user_id % 3 AS INT) AS records_scraped,
       CAST(floor(value) AS INT) + CAST(user_id % 5 AS INT) AS records_valid,
       CAST(floor(value) AS INT) AS records_new, CAST(floor(value) AS INT) AS records_written,
       CASE WHEN event_type = 'error' THEN split(concat('timeout,bad row ', props), ',') END AS errors
FROM events
"""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _bound(spark: SparkSession, sf: str, sql: str, names: tuple[str, ...], dear: bool = False) -> DataFrame:
    """Run a SELECT text over the named tables, with ``dear`` for work that is dear per row."""
    for name in names:
        table(spark, sf, name).createOrReplaceTempView(name)
    if names[0] in SPREAD:
        wide = table(spark, sf, names[0])
        read = [c for c in wide.columns if re.search(rf"\b{c}\b", sql)]
        narrow = wide.select(*read)
        (spread_evenly(narrow) if dear else spread_small(narrow, SPREAD[names[0]])).createOrReplaceTempView(names[0])
    return spark.sql(sql)


def sales(spark: SparkSession, sf: str, dear: bool = False) -> DataFrame:
    """Raw sales, one row per line item, copies included."""
    df = _bound(spark, sf, SALES, ("lineitem", "part"), dear)
    return df.withColumn("record_hash", record_hash())


# How sales lie that go to folders by source and month; the first is told by the supplier alone.
MONTHLY = "l_suppkey % 4", "trunc(l_shipdate, 'month')"


def stored_sales(spark: SparkSession, sf: str, monthly: bool = False) -> DataFrame:
    """:func:`sales` over the written join, for what reads them several times: the columns of the
    tables are stored, which are a fraction of the texts made of them. ``monthly`` sales are laid out
    by source and month, which shuffles that fraction instead of the texts."""
    both = {c: name for name in ("lineitem", "part") for c in table(spark, sf, name).columns}
    read = [c for c in both if re.search(rf"\b{c}\b", SALES)]
    text = f"SELECT {', '.join(read)} {SALES_FROM}"
    if monthly:
        lines = table(spark, sf, "lineitem").rdd.getNumPartitions()
        for name in ("lineitem", "part"):
            table(spark, sf, name).createOrReplaceTempView(name)
        parts = max(4 * lines, spark.sparkContext.defaultParallelism)
        joined = write_table(spark.sql(text).repartition(parts, *map(F.expr, MONTHLY)), "joined")
    else:
        joined = write_table(_bound(spark, sf, text, ("lineitem", "part")), "joined")
    joined.createOrReplaceTempView("joined_sales")
    return spark.sql(SALES.replace(SALES_FROM, "FROM joined_sales")).withColumn("record_hash", record_hash())


def aliases(spark: SparkSession, sf: str) -> DataFrame:
    return _bound(spark, sf, ALIASES, ("part",))


def odd_aliases(spark: SparkSession, sf: str) -> DataFrame:
    return _bound(spark, sf, ODD_ALIASES, ("part",))


def seed(spark: SparkSession, sf: str) -> DataFrame:
    return _bound(spark, sf, SEED, ("part",))


def runs(spark: SparkSession, sf: str) -> DataFrame:
    return _bound(spark, sf, RUNS, ("events",))


def as_of() -> Column:
    return F.lit(AS_OF).cast("date")


def runs_as_of() -> Column:
    return F.lit(RUNS_AS_OF).cast("timestamp_ntz").cast("timestamp")


def ingested(spark: SparkSession, sf: str, monthly: bool = False) -> DataFrame:
    """Stage 1. The load time is the scrape time, as the tables have no other clock."""
    by = [F.col("source"), F.trunc("sale_date", "month")] if monthly else []
    return keep_latest(stored_sales(spark, sf, monthly), ties=TIES, written=True, by=by).withColumn("ingested_at", F.col("scraped_at"))


def normalised(spark: SparkSession, sf: str, monthly: bool = False) -> DataFrame:
    """Stages 1-2. Deduplicated rows feed the bounds and the flags; both read what is stored of them."""
    rows = ingested(spark, sf, monthly).withColumn("includes_buyer_premium", stage_premium())
    return flag_outliers(rows).withColumn("sale_type", normalised_sale_type())


def enriched(spark: SparkSession, sf: str, monthly: bool = False) -> DataFrame:
    """Stages 1-3."""
    named = resolve_entities(normalised(spark, sf, monthly), aliases(spark, sf))
    return named.withColumn("sport", sport("card_set", "fighter_name_canonical"))


def entities(spark: SparkSession, sf: str) -> DataFrame:
    return materialise(marts.dim_fighter(seed(spark, sf)))


def resolved(spark: SparkSession, sf: str, dim: DataFrame) -> DataFrame:
    return marts.resolved_sales(enriched(spark, sf), dim, as_of_future())


def as_of_future() -> Column:
    """The "today" of the staging guard: the first half of the table's years passes."""
    return F.lit("2000-06-30").cast("date")


def fact(spark: SparkSession, sf: str, dim: DataFrame) -> DataFrame:
    return marts.fct_card_sales(resolved(spark, sf, dim), marts.dim_grade(spark))


def benchmarks(spark: SparkSession, sf: str, dim: DataFrame, **options) -> DataFrame:
    """The benchmark mart over a written fact table, of which it reads five columns."""
    read = fact(spark, sf, dim).select("fighter_id", "grade_id", "sale_date", "sale_id", "sale_price_usd")
    return marts.fct_price_benchmarks(write_table(read, "fact"), **options)
