"""Headline timings: prints one JSON line.

Each query starts from the given tables: events become JSON documents, those are parsed
into staging and core rows, and the mart or panel is computed from them.  ``queries`` has
the first run of each, ``warm`` the second.  ``lake`` has the dashboard views over written
lake tables (the second run of each), ``lake_load`` the time to write those tables.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from driftlake_checks.queries import REGISTRY  # noqa: E402
from driftlake.plans.marts import MARTS  # noqa: E402
from driftlake.schemas import TABLES  # noqa: E402
from driftlake.session import build_session, scratch_path  # noqa: E402
from driftlake.sources.fixtures import FixtureTables  # noqa: E402
from driftlake.sources.lake import Lake  # noqa: E402

HEADLINE = (
    "mart_pipeline_health",
    "mart_most_mentioned",
    "mart_events_per_second",
    "mart_language_distribution",
    "mart_content_breakdown",
    "mart_embed_usage",
    "mart_trending_hashtags",
    "mart_sentiment_timeseries",
    "mart_top_posts",
    "mart_engagement_velocity",
    "mart_firehose_stats",
    "panel_trending_hashtags",
    "panel_top_posts_positive",
    "stg_posts",
    "core_posts",
    "core_post_sentiment",
    "telemetry_alerts",
    "telemetry_latency_post",
    "quality_duplicate_ratio",
    "stream_core_posts",
)


def run(spark, name: str, folder: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - started, 3)


def run_lake(spark, folder: str, times: int) -> tuple[float, dict[str, float]]:
    """Write every lake table once, then time the marts over them.

    ``times`` takes each event that often: 32 at sf0.1 gives the 3.2 million rows that the
    published figures are for.
    """
    tables = FixtureTables.of(spark, folder) if times == 1 else FixtureTables(spark, folder, times=times)
    lake = Lake(spark, scratch_path(spark, "bench-lake"))
    started = time.perf_counter()
    for name, spec in TABLES.items():
        lake.ensure_table(spec)
        lake.append(spec, tables[name])
    load = round(time.perf_counter() - started, 3)
    timings: dict[str, float] = {}
    for _ in range(2):
        for name, build in MARTS.items():
            started = time.perf_counter()
            build(lake, tables.as_of).write.format("noop").mode("overwrite").save()
            timings[name] = round(time.perf_counter() - started, 3)
    return load, timings


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, "stg_client_dates", folder)
    cold = {name: run(spark, name, folder) for name in names}
    warm = {name: run(spark, name, folder) for name in names}
    times = int(os.environ.get("BENCH_TIMES", "1"))
    load, over_lake = run_lake(spark, folder, times)
    print(
        json.dumps(
            {
                "metric": "headline queries, first run each",
                "value": round(sum(cold.values()), 3),
                "unit": "sec",
                "queries": cold,
                "warm": warm,
                "lake": over_lake,
                "lake_load": load,
                "lake_times": times,
                "sf": os.path.basename(os.path.normpath(folder)).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
