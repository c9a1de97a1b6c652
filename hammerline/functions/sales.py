"""Derived sale columns (inventory P1-P3, P5-P7, P9-P11, P16, P23, P24, P27)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from hammerline import fixed

SECONDS_PER_DAY = 86400


def record_hash(listing_id: Column | str = "listing_id", source: Column | str = "source") -> Column:
    """SHA-256 of listing id and source, no separator."""
    return F.sha2(F.concat(listing_id, source), 256)


def surrogate_key(*cols: Column | str) -> Column:
    """MD5 of the '-'-joined string forms; NULL parts take a placeholder."""
    parts = [F.coalesce((F.col(c) if isinstance(c, str) else c).cast("string"), F.lit(fixed.KEY_NULL)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def stage_premium(source: Column | str = "source") -> Column:
    """P2, stage rule: true for pwcc only."""
    source = F.col(source) if isinstance(source, str) else source
    return F.coalesce(source.isin(fixed.STAGE_PREMIUM_SOURCES), F.lit(False))


def normalised_sale_type(sale_type: Column | str = "sale_type") -> Column:
    """AUCTION, BUY_IT_NOW (also best offers), else UNKNOWN."""
    sale_type = F.col(sale_type) if isinstance(sale_type, str) else sale_type
    return (
        F.when(sale_type == "auction", "AUCTION")
        .when(sale_type.isin("buy_it_now", "best_offer"), "BUY_IT_NOW")
        .otherwise("UNKNOWN")
    )


def sport(card_set: Column | str, name: Column | str) -> Column:
    """P5: sport by keyword in "set name"; MMA keywords are tried first."""
    card_set, name = (F.col(c) if isinstance(c, str) else c for c in (card_set, name))
    text = F.lower(F.concat(F.coalesce(card_set, F.lit("")), F.lit(" "), F.coalesce(name, F.lit(""))))
    mma = reduce(or_, (text.contains(k) for k in fixed.MMA_KEYWORDS))
    boxing = reduce(or_, (text.contains(k) for k in fixed.BOXING_KEYWORDS))
    return F.when(mma, "MMA").when(boxing, "BOXING").otherwise("UNKNOWN")


def pct_deviation(value: Column, base: Column) -> Column:
    """Percent distance from ``base``; NULL when it is NULL or zero."""
    value, base = value.cast("double"), base.cast("double")
    return F.when(base != 0, (value - base) / base * 100)


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """NULL when the denominator is NULL or zero."""
    return F.try_divide(numerator, denominator)


def epoch_seconds(day: Column | str) -> Column:
    """Midnight UTC of a date as epoch seconds, whatever the session time zone is."""
    return F.unix_date(day).cast("long") * F.lit(SECONDS_PER_DAY).cast("long")


def rookie(card_year: Column | str, debut_year: Column | str) -> Column:
    """P10: card of the debut year; unknown years are not rookies."""
    card_year, debut_year = (F.col(c) if isinstance(c, str) else c for c in (card_year, debut_year))
    return F.coalesce(card_year == debut_year, F.lit(False))


def audit_columns(as_of: Column | None = None) -> dict[str, Column]:
    """When and as part of which run a row was ingested."""
    now = F.current_timestamp() if as_of is None else as_of.cast("timestamp")
    day = F.current_date() if as_of is None else as_of.cast("date")
    return {"ingested_at": now, "processing_date": day}


def path_parts(ts: Column | str) -> dict[str, Column]:
    """Year, zero-padded month and day of the ingest folder."""
    return {
        "year": F.date_format(ts, "yyyy"),
        "month": F.date_format(ts, "MM"),
        "day": F.date_format(ts, "dd"),
    }


def raw_lag_hours(completed_at: Column, as_of: Column) -> Column:
    """Hours since completion as they are, 0 when the time is missing."""
    micros = F.unix_micros(as_of.cast("timestamp")) - F.unix_micros(completed_at.cast("timestamp"))
    return F.coalesce(micros / F.lit(3.6e9), F.lit(0.0))


def lag_hours(completed_at: Column, as_of: Column) -> Column:
    """Hours since completion for display, two decimals."""
    return F.round(raw_lag_hours(completed_at, as_of), 2)


def run_status(has_errors: Column, lag: Column, invalid_ratio: Column, max_invalid_ratio: float | None) -> Column:
    """Error, stale, degraded or healthy; the invalid-ratio rule is optional.

    ``lag`` is the unrounded one: a run 10 seconds past a threshold is past it.
    """
    degraded = lag > fixed.DEGRADED_HOURS
    if max_invalid_ratio is not None:
        degraded = degraded | F.coalesce(invalid_ratio > max_invalid_ratio, F.lit(False))
    return (
        F.when(has_errors, "error")
        .when(lag > fixed.STALE_HOURS, "stale")
        .when(degraded, "degraded")
        .otherwise("healthy")
    )


def severity(status: Column) -> Column:
    """Rank of a status; the worst has the highest."""
    names = F.array(*[F.lit(s) for s in fixed.STATUS_ORDER])
    return F.array_position(names, status).cast("int")


def status_name(rank: Column) -> Column:
    """Inverse of :func:`severity`; no runs at all count as healthy."""
    names = F.array(*[F.lit(s) for s in fixed.STATUS_ORDER])
    return F.coalesce(F.try_element_at(names, rank), F.lit("healthy"))
