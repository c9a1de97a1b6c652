"""Oracle SQL: the same results written directly over the given tables."""

from __future__ import annotations

from bindings.tables import ALIASES, AS_OF, RUNS, RUNS_AS_OF, SALES, SEED
from hammerline import fixed

NULL_KEY = fixed.KEY_NULL


def _key(*cols: str) -> str:
    parts = ", '-', ".join(f"coalesce(CAST({c} AS VARCHAR), '{NULL_KEY}')" for c in cols)
    return f"md5(concat({parts}))"


def _list(values) -> str:
    return ", ".join("'" + str(v).replace("'", "''") + "'" for v in values)


def _contains_any(text: str, words) -> str:
    return "(" + " OR ".join(f"contains({text}, '{w}')" for w in words) + ")"


SPORT = (
    "CASE WHEN {mma} THEN 'MMA' WHEN {box} THEN 'BOXING' ELSE 'UNKNOWN' END".format(
        mma=_contains_any("lower(concat(coalesce(card_set, ''), ' ', coalesce(fighter_name_canonical, '')))", fixed.MMA_KEYWORDS),
        box=_contains_any("lower(concat(coalesce(card_set, ''), ' ', coalesce(fighter_name_canonical, '')))", fixed.BOXING_KEYWORDS),
    )
)
SALE_TYPE = (
    "CASE WHEN sale_type = 'auction' THEN 'AUCTION' WHEN sale_type IN ('buy_it_now', 'best_offer') "
    "THEN 'BUY_IT_NOW' ELSE 'UNKNOWN' END"
)

GRADE_ROWS = ", ".join(
    f"({i}, '{g}', CAST({'NULL' if n is None else n} AS DOUBLE), '{label}')" for i, g, n, label in fixed.GRADES
)

CTES = {
    "sales": f"SELECT *, sha256(concat(listing_id, source)) AS record_hash FROM ({SALES})",
    "ingested": """
        SELECT * EXCLUDE (rn), scraped_at AS ingested_at FROM (
            SELECT *, row_number() OVER (PARTITION BY record_hash ORDER BY scraped_at DESC, l_partkey DESC, l_suppkey DESC,
                   sale_price_usd DESC, grade DESC NULLS LAST) AS rn FROM sales) WHERE rn = 1""",
    "bounds": """
        SELECT source, grade, q1, q3, q3 - q1 AS iqr, q1 - 3.0 * (q3 - q1) AS lower_bound,
               q3 + 3.0 * (q3 - q1) AS upper_bound
        FROM (SELECT source, grade, quantile_disc(CAST(sale_price_usd AS DOUBLE), 0.25) AS q1,
                     quantile_disc(CAST(sale_price_usd AS DOUBLE), 0.75) AS q3
              FROM ingested GROUP BY source, grade)""",
    "normalised": f"""
        SELECT s.* REPLACE ({SALE_TYPE} AS sale_type), s.source = 'pwcc' AS includes_buyer_premium,
               coalesce(CAST(s.sale_price_usd AS DOUBLE) < b.lower_bound
                        OR CAST(s.sale_price_usd AS DOUBLE) > b.upper_bound, FALSE) AS is_outlier
        FROM ingested s LEFT JOIN bounds b ON s.source = b.source AND s.grade = b.grade""",
    "aliases": ALIASES,
    "title_hits": """
        SELECT t.title, arg_min(a.canonical, a.priority) AS by_title
        FROM (SELECT DISTINCT listing_title AS title FROM sales) t JOIN aliases a
          ON contains(lower(t.title), a.alias) GROUP BY t.title""",
    "named": """
        SELECT n.*, coalesce(a.canonical, t.by_title) AS fighter_name_canonical
        FROM normalised n LEFT JOIN aliases a ON lower(trim(n.fighter_name)) = a.alias
        LEFT JOIN title_hits t ON n.listing_title = t.title""",
    "enriched": f"SELECT *, {SPORT} AS sport FROM named",
    "seed": SEED,
    "dim_fighter": f"""
        SELECT {_key('fighter_name_canonical', 'fighter_name_alias')} AS fighter_id, fighter_name_canonical,
               fighter_name_alias, sport, nationality, promotion, active, debut_year,
               {_key('fighter_name_canonical')} AS canonical_fighter_id FROM seed""",
    "dim_grade": f"SELECT * FROM (VALUES {GRADE_ROWS}) t(grade_id, grader, grade_numeric, grade_label)",
    "staged": f"""
        SELECT {_key('source', 'listing_id')} AS sale_id, listing_id AS source_listing_id, source, sale_price_usd,
               sale_date, scraped_at, ingested_at, listing_title, fighter_name, fighter_name_canonical, card_year,
               card_set, card_number, grade, grader, grade_numeric, listing_url, sale_type,
               source IN ('pwcc', 'myslabs') AS has_buyer_premium, is_outlier, sport, record_hash
        FROM enriched WHERE source IN ('ebay', 'pwcc', 'myslabs') AND sale_price_usd > 0 AND sale_date IS NOT NULL
          AND NOT is_outlier AND (source = 'ebay' OR sale_date <= DATE '2000-06-30')""",
    "resolved": """
        SELECT s.* REPLACE (coalesce(f.fighter_name_canonical, s.fighter_name_canonical) AS fighter_name_canonical),
               f.fighter_id, f.sport AS fighter_sport, f.nationality
        FROM staged s LEFT JOIN dim_fighter f ON lower(trim(s.fighter_name)) = lower(trim(f.fighter_name_alias))""",
    "card_pairs": f"""
        SELECT {_key('card_year', 'card_set', 'card_number')} AS card_id, c.card_year, c.card_set, c.card_number,
               coalesce(c.card_year = f.debut_year, FALSE) AS is_rookie
        FROM (SELECT DISTINCT card_year, card_set, card_number, fighter_id FROM resolved
              WHERE card_year IS NOT NULL AND card_set IS NOT NULL AND card_number IS NOT NULL) c
        LEFT JOIN dim_fighter f ON c.fighter_id = f.fighter_id""",
    "dim_card": """
        SELECT card_id, card_year, card_set, card_number, bool_or(is_rookie) AS is_rookie
        FROM card_pairs GROUP BY ALL""",
    "fact": """
        SELECT s.sale_id, s.fighter_id, c.card_id, g.grade_id, s.source_listing_id, s.source, s.sale_price_usd,
               s.sale_date, s.sale_type, s.has_buyer_premium, s.listing_title, s.listing_url
        FROM resolved s
        LEFT JOIN dim_card c ON s.card_year = c.card_year AND s.card_set = c.card_set
             AND s.card_number = c.card_number
        LEFT JOIN dim_grade g ON upper(trim(s.grader)) = g.grader AND s.grade_numeric = g.grade_numeric""",
    "benchmarks": """
        SELECT fighter_id, grade_id, sale_date AS benchmark_date, sale_id,
               CAST(sum(sale_price_usd) OVER w7 AS DOUBLE) / count(sale_price_usd) OVER w7 AS vwap_7d,
               CAST(sum(sale_price_usd) OVER w30 AS DOUBLE) / count(sale_price_usd) OVER w30 AS vwap_30d,
               CAST(sum(sale_price_usd) OVER w90 AS DOUBLE) / count(sale_price_usd) OVER w90 AS vwap_90d,
               count(*) OVER w7 AS sale_count_7d, count(*) OVER w30 AS sale_count_30d,
               CAST(sale_price_usd AS DOUBLE) AS price
        FROM fact
        WINDOW w7 AS (PARTITION BY fighter_id, grade_id ORDER BY sale_date, sale_id ROWS BETWEEN 6 PRECEDING AND CURRENT ROW),
               w30 AS (PARTITION BY fighter_id, grade_id ORDER BY sale_date, sale_id ROWS BETWEEN 29 PRECEDING AND CURRENT ROW),
               w90 AS (PARTITION BY fighter_id, grade_id ORDER BY sale_date, sale_id ROWS BETWEEN 89 PRECEDING AND CURRENT ROW)""",
    "pct": """
        SELECT * EXCLUDE (price), CASE WHEN vwap_7d <> 0 THEN (price - vwap_7d) / vwap_7d * 100 END AS price_pct_change_7d,
               CASE WHEN vwap_30d <> 0 THEN (price - vwap_30d) / vwap_30d * 100 END AS price_pct_change_30d
        FROM benchmarks""",
    "latest": f"""
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fighter_id, grade_id ORDER BY sale_id DESC) AS rn
                       FROM pct WHERE benchmark_date = DATE '{AS_OF}') WHERE rn = 1""",
    "daily": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY fighter_id, grade_id, benchmark_date
                                                    ORDER BY sale_id DESC) AS rn FROM pct) WHERE rn = 1""",
    "runs": RUNS,
    "latest_runs": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY completed_at DESC, run_id DESC) AS rn
                       FROM runs) WHERE rn = 1""",
    "status": f"""
        SELECT source, records_written AS last_run_records_written,
               greatest(records_scraped - records_valid, 0) AS last_run_records_invalid,
               greatest(records_valid - records_new, 0) AS last_run_records_duplicate,
               greatest(records_valid - records_written, 0) AS last_run_records_unwritten, round(lag, 2) AS lag_hours,
               CASE WHEN coalesce(len(errors), 0) > 0 THEN 'error' WHEN lag > 24 THEN 'stale'
                    WHEN lag > 8 OR (records_valid > 0
                         AND greatest(records_valid - records_written, 0) / records_valid > 0.1) THEN 'degraded'
                    ELSE 'healthy' END AS status
        FROM (SELECT *, (epoch_us(TIMESTAMP '{RUNS_AS_OF}') - epoch_us(completed_at)) / 3.6e9 AS lag FROM latest_runs)""",
}

# Which CTEs each one reads, in definition order.
ORDER = list(CTES)


def _needed(names: set[str]) -> list[str]:
    import re

    todo, found = list(names), set()
    while todo:
        name = todo.pop()
        if name in found:
            continue
        found.add(name)
        todo += [n for n in ORDER if n != name and re.search(rf"\b(?:FROM|JOIN)\s+\(?{n}\b", CTES[name])]
    return [n for n in ORDER if n in found]


def sql(body: str, *extra: tuple[str, str]) -> str:
    """A statement with exactly the CTEs its body reads."""
    import re

    text = body + " ".join(t for _, t in extra)
    names = {n for n in ORDER if re.search(rf"\b(?:FROM|JOIN)\s+\(?{n}\b", text)}
    ctes = [f"{n} AS MATERIALIZED ({CTES[n]})" for n in _needed(names)] + [f"{n} AS ({t})" for n, t in extra]
    return (f"WITH {', '.join(ctes)} " if ctes else "") + body
