"""Median seconds per headline query, as one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8) and BENCH_RUNS
(default 3) choose data, cores and repetitions. Every query runs once beforehand, and
its whole result is computed (written to the no-op sink).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from bindings.queries import QUERIES, _written_marts  # noqa: E402
from bindings.tables import as_of, as_of_future, seed  # noqa: E402
from hammerline.plans import marts, serving  # noqa: E402
from hammerline.session import build_session, scratch_scope  # noqa: E402

HEADLINE = [
    "keep_latest",
    "profile_counts",
    "anti_seen",
    "validate_rows",
    "dq_suite",
    "iqr_outliers",
    "resolve_entity",
    "resolve_entity_joined",
    "rolling_benchmarks",
    "rolling_rows",
    "star_fact",
    "dim_card",
    "market_overview",
    "fighter_detail",
    "scd2_snapshot",
    "cert_worklist",
    "api_payload",
    "run_status",
]


def run(spark, name: str, sf: str) -> float:
    with scratch_scope(spark):
        start = time.perf_counter()
        QUERIES[name](spark, sf).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start


def serving_seconds(spark, sf: str, runs: int) -> dict[str, float]:
    """Building the marts from raw tables and again from the warehouse tables, and answers read
    from them; not part of the total."""
    start = time.perf_counter()
    layout = _written_marts(spark, sf)
    seconds = {"marts_build": round(time.perf_counter() - start, 3)}
    start = time.perf_counter()
    marts.build_marts(spark, layout, as_of_future(), seed(spark, sf), grain="files")
    seconds["marts_from_tables"] = round(time.perf_counter() - start, 3)
    bench, names, grades = (spark.read.parquet(layout.mart(m)) for m in ("fct_price_benchmarks", "dim_fighter", "dim_grade"))
    fact = marts.read_fact(spark, layout)
    answers = {
        "serve_overview": lambda: serving.market_overview(bench, names, grades, as_of()),
        "serve_movers": lambda: serving.top_movers(bench, names, grades, as_of(), "up", 20),
        "serve_detail": lambda: serving.fighter_detail(bench, fact, names, grades, as_of()),
    }
    for name, answer in answers.items():
        taken = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            answer().write.format("noop").mode("overwrite").save()
            taken.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(taken[1:]), 3)
    return seconds


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g"
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        run(spark, name, sf)
    seconds = {name: round(statistics.median(run(spark, name, sf) for _ in range(runs)), 3) for name in names}
    total = round(sum(seconds.values()), 3)
    if not sys.argv[1:]:
        seconds |= serving_seconds(spark, sf, runs)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))


if __name__ == "__main__":
    main()
