"""Run monitoring from the run log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hammerline import fixed
from hammerline.functions.sales import lag_hours, raw_lag_hours, run_status, severity, status_name
from hammerline.operators.dedup import first_per_key, new_records
from hammerline.operators.validate import error_counts, split_valid


def latest_runs(runs: DataFrame) -> DataFrame:
    """The newest run of each source."""
    return first_per_key(runs, ["source"], [F.col("completed_at").desc_nulls_last(), F.col("run_id").desc()])


def zero_output(runs: DataFrame) -> DataFrame:
    """Sources whose newest run wrote nothing."""
    return latest_runs(runs).where(F.col("records_written") == 0).select("source", "run_id", "records_written")


def source_status(runs: DataFrame, as_of: Column, max_invalid_ratio: float | None = fixed.MAX_INVALID_RATIO) -> DataFrame:
    """V6, per source: lag, invalid and duplicate counts, status of the newest run.

    Invalid records are scraped minus valid, duplicates valid minus new.
    ``last_run_records_unwritten`` (valid minus written) is what the invalid-ratio rule reads.
    """
    valid = F.coalesce("records_valid", F.lit(0))
    unwritten = F.greatest(valid - F.coalesce("records_written", F.lit(0)), F.lit(0))
    lag = raw_lag_hours(F.col("completed_at"), as_of)
    has_errors = F.coalesce(F.size("errors"), F.lit(0)) > 0
    ratio = F.try_divide(unwritten, valid)
    return latest_runs(runs).select(
        "source",
        F.col("completed_at").alias("last_successful_scrape"),
        F.coalesce("records_written", F.lit(0)).alias("last_run_records_written"),
        unwritten.alias("last_run_records_unwritten"),
        F.greatest(F.col("records_scraped") - valid, F.lit(0)).alias("last_run_records_invalid"),
        F.greatest(valid - F.col("records_new"), F.lit(0)).alias("last_run_records_duplicate"),
        run_status(has_errors, lag, ratio, max_invalid_ratio).alias("status"),
        lag_hours(F.col("completed_at"), as_of).alias("lag_hours"),
        as_of.cast("timestamp").alias("updated_at"),
    )


def overall_status(statuses: DataFrame) -> DataFrame:
    """The worst status of all sources."""
    return statuses.agg(F.max(severity(F.col("status"))).alias("_rank")).select(
        status_name(F.col("_rank")).alias("overall_status")
    )


def coverage(fact: DataFrame) -> DataFrame:
    """Rows of the fact table and entities with sales."""
    return fact.agg(
        F.count("*").alias("total_records_in_fct_card_sales"),
        F.count_distinct("fighter_id").alias("fighters_with_coverage"),
    )


def run_summary(runs: DataFrame, fact: DataFrame, as_of: Column) -> DataFrame:
    """V6: overall status, coverage and a map source -> status."""
    statuses = source_status(runs, as_of)
    by_source = statuses.agg(
        F.map_from_entries(
            F.array_sort(
                F.collect_list(
                    F.struct(
                        "source",
                        F.struct(
                            "last_successful_scrape",
                            "last_run_records_written",
                            "last_run_records_invalid",
                            "status",
                            "lag_hours",
                        ).alias("value"),
                    )
                )
            )
        ).alias("sources"),
        F.max(severity(F.col("status"))).alias("_rank"),
    )
    totals = coverage(fact).select(F.struct("*")).scalar()
    return by_source.withColumn("_totals", totals).select(
        as_of.cast("timestamp").alias("updated_at"),
        "sources",
        status_name(F.col("_rank")).alias("overall_status"),
        "_totals.total_records_in_fct_card_sales",
        "_totals.fighters_with_coverage",
    )


def source_metrics(runs: DataFrame, source: str, as_of: Column) -> DataFrame:
    """V7: the status of one source; its filter reaches the scan."""
    return source_status(runs.where(F.col("source") == source), as_of)


def run_history(runs: DataFrame, n: int = 30) -> DataFrame:
    """V7 + T6: the newest runs."""
    return runs.orderBy(F.col("completed_at").desc_nulls_last(), F.col("run_id").desc()).limit(n)


def records_over_time(runs: DataFrame, n: int = 60) -> DataFrame:
    """V8 + F14: records written by start time for the newest runs; bad times are dropped."""
    return (
        run_history(runs, n)
        .where(F.col("started_at").isNotNull())
        .select("started_at", F.coalesce("source", F.lit("unknown")).alias("source"), "records_written")
        .orderBy("started_at", "source")
    )


def recent_errors(runs: DataFrame, n_runs: int = 20, n: int = 10) -> DataFrame:
    """The first errors of the newest runs."""
    newest = run_history(runs, n_runs).select("completed_at", "source", "run_id", F.posexplode("errors").alias("pos", "error"))
    return newest.orderBy(F.col("completed_at").desc_nulls_last(), F.col("run_id").desc(), "pos").limit(n).drop("pos")


def batch_counters(validated: DataFrame, seen: DataFrame, *keys: str) -> DataFrame:
    """Scraped, valid, new and written per batch, with counts per error message.

    ``validated`` is read three times and should be a written table. New records are
    counted after removing copies within the batch. Messages are counted
    before they are listed, so the list is as long as the number of rules.
    """
    keys = keys or ("source",)
    valid, _ = split_valid(validated)
    totals = validated.groupBy(*keys).agg(
        F.count("*").alias("records_scraped"), F.count_if(F.size("errors") == 0).alias("records_valid")
    )
    fresh = new_records(valid, seen).groupBy(*keys).agg(F.count("*").alias("records_new"))
    errors = (
        error_counts(validated, *keys)
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("error", "records"))).alias("errors"))
    )
    return (
        totals.join(fresh, list(keys), "left")
        .join(errors, list(keys), "left")
        .select(
            *keys,
            "records_scraped",
            "records_valid",
            F.coalesce("records_new", F.lit(0)).alias("records_new"),
            F.coalesce("records_new", F.lit(0)).alias("records_written"),
            F.coalesce("errors", F.array()).alias("errors"),
        )
    )
