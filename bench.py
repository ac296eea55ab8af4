"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the input tables (default /root/testdata/sf0.1), ``BENCH_CPUS`` the local cores.
After one warm-up of the JVM on the smallest tables each query runs once in full into the no-op sink; the mart is built once, as in use, and timed
as its own entry. ``weather_load_rows_per_sec`` is the throughput of storing the hourly weather rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from dailymart import registry  # noqa: E402
from dailymart.session import local_session  # noqa: E402
from dailymart.sources.projection import LOAD_TIME  # noqa: E402
from dailymart.workspace import workspace  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
WARM_UP_DIR = "/root/testdata/sf0.001"
CPUS = int(os.environ.get("BENCH_CPUS", "8"))

MODELS = ["stg_orders", "stg_weather", "int_orders_enriched", "int_rank_daily_avg", "int_ratings_metrics", "fct_daily"]
OTHERS = ["src_json_flatten", "load_audit", "dq_null_profile", "dq_orphans", "dq_all_checks"]


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    started = time.perf_counter()
    work()
    return round(time.perf_counter() - started, 3)


def main() -> None:
    spark = local_session(CPUS, shuffle_partitions=CPUS, app="bench")
    queries = registry.all_queries()
    space = workspace(spark, SF_DIR)
    if os.path.exists(WARM_UP_DIR):
        drain(queries["fct_daily"](spark, WARM_UP_DIR))

    seconds: dict[str, float] = {name: timed(lambda n=name: drain(queries[n](spark, SF_DIR))) for name in MODELS}
    seconds["mart_build"] = timed(lambda: space.fact)
    for name in sorted(registry.report_queries()) + OTHERS:
        seconds[name] = timed(lambda n=name: drain(queries[n](spark, SF_DIR)))

    stored: list[int] = []
    seconds["weather_load"] = timed(
        lambda: stored.append(space.results.load_raw(space.raw["weather"].drop("loaded_at"), "weather", LOAD_TIME))
    )
    result = {
        "metric": "total_query_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": SF_DIR.rstrip("/").rsplit("sf", 1)[-1],
        "cpus": CPUS,
        "fact_rows": space.fact.count(),
        "weather_load_rows_per_sec": round(stored[0] / seconds["weather_load"]),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
