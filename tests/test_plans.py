"""Physical plans keep the properties the design relies on."""

from __future__ import annotations

import re

import pytest

from conftest import SMALL
from dailymart import registry
from dailymart.plans import reports

# Building these runs jobs, so only their results are tested.
EAGER = {
    "src_csv",
    "src_csv_parts",
    "src_csv_rejects",
    "src_weather_ingest",
    "load_audit",
    "load_append",
    "load_failed_keeps_rows",
    "dq_stored_failures",
    "dq_rowcount_recon",
    "src_csv_dates",
    "src_csv_quoted_breaks",
    "catalog_layers",
    "catalog_stg_weather",
    "catalog_stg_ratings_agg",
    "catalog_bucketed_days",
    "load_repeated_id",
    "fct_refreshed",
    "fct_two_loads",
    "fct_late_ratings",
}
LAZY = sorted(set(registry.all_queries()) - EAGER)


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, plan_of, name):
    plan = plan_of(registry.all_queries()[name](spark, SMALL))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert operator not in plan, operator


def test_listing_history_reaches_the_scan(small, plan_of):
    plan = plan_of(reports.listing_history(small.fact, 43))
    pushed = next(line for line in plan.splitlines() if "PushedFilters" in line)
    assert "EqualTo(listing_id,43)" in pushed and "GreaterThanOrEqual(date" in pushed
    assert "PartitionFilters: [isnotnull(month" in plan
    schema = next(line for line in plan.splitlines() if "ReadSchema" in line)
    assert "org_name" not in schema and "avg_rank" not in schema


def test_reports_read_only_their_columns(small, plan_of):
    plan = plan_of(reports.quality_flag_distribution(small.fact))
    schemas = [line for line in plan.splitlines() if "ReadSchema" in line]
    assert schemas and all(line.count(":") == 2 and "data_quality_flag" in line for line in schemas)


@pytest.mark.parametrize("skewed", [False, True])
def test_days_of_weather_are_not_broadcast(small, plan_of, skewed):
    """Hourly rows come out of an explode, so Spark takes daily weather for a small table whatever its size."""
    plan = plan_of((registry._skewed(small) if skewed else small.lazy).fact)
    joins = re.findall(r"\n\(\d+\) (\w+)\s*\nLeft keys \[[23]\]: \[outlet_id#\d+L?, date", plan)
    assert joins == ["SortMergeJoin"]


def test_sources_share_one_partitioning_in_the_fold(small, spark):
    """Four shuffles by (listing, date) feed the union; the fold above it needs none."""
    days = small.lazy.date_listing_spine()
    days.collect()
    plan = days._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    above_union = final[: final.index("Union")]
    fold = above_union[above_union.rindex("HashAggregate") :]
    assert "Exchange" not in fold


def test_building_a_query_runs_no_job(spark, small):
    """Queries are lazy once the keys of the raw tables are counted; stored side results are made before."""
    small.checked.fact
    for name in ("stg_listing", "stg_outlet", "stg_org", "stg_orders", "int_orders_enriched"):
        small.checked[name]
    small.lazy["int_orders_enriched"]
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building queries")
    try:
        for name in ("int_orders_enriched", "fct_daily", "dq_unplaced_listings", "rpt03_platform_comparison"):
            registry.all_queries()[name](spark, SMALL)
        assert not tracker.getJobIdsForGroup("building")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_daily_listings_are_counted_without_a_shuffle_of_pairs(small, plan_of):
    plan = plan_of(reports.daily_summary(small.fact))
    exchanges = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert exchanges and not any("listing_id" in line for line in exchanges)


def test_star_joins_scan_each_raw_table_once_or_twice(spark, small):
    """Joins share the counted keys, so no join counts inside the plan; raw tables are told apart by their columns."""
    stored = {name: spark.createDataFrame([], df.schema).alias(name) for name, df in small.raw.items()}
    import tempfile

    from dailymart.plans.models import Models

    folder = tempfile.mkdtemp()
    for name, df in stored.items():
        df.write.parquet(f"{folder}/{name}")
    models = Models({name: spark.read.parquet(f"{folder}/{name}") for name in stored})
    for frame in (models["int_orders_enriched"], models.fact):
        plan = frame._jdf.queryExecution().sparkPlan().toString()
        scans = {name: plan.count(f"{folder}/{name}]") for name in stored}
        assert max(scans.values()) <= 2 and 3 < sum(scans.values()) <= len(stored) + 1, scans


def test_bucketed_fact_is_not_shuffled(spark, small, plan_of):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        days = registry.all_queries()["catalog_bucketed_days"](spark, SMALL)
        plan = days._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    join = plan[plan.index("SortMergeJoin") :]
    fact_side = join[: join.index("by_listing")]
    assert "Exchange" not in plan[: plan.index("SortMergeJoin")] and "Exchange" not in fact_side


def test_views_give_the_staging_models(spark, small):
    from dailymart.sinks.catalog import VIEWS

    registry.all_queries()["catalog_layers"](spark, SMALL)
    catalog = registry._catalog(small)
    for model in VIEWS:
        ours, view = small.lazy[model], spark.table(catalog.name(model))
        assert ours.columns == view.columns
        assert sorted(map(str, ours.collect())) == sorted(map(str, view.collect())), model
    assert spark.catalog.tableExists(catalog.name("stg_orders")) and catalog.name("stg_orders").endswith("staging.stg_orders")
