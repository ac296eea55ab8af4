"""The registered queries: name -> function(spark, sf_dir) returning a DataFrame."""

from __future__ import annotations

import zlib
from collections.abc import Callable
from contextlib import suppress
from datetime import date
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dailymart.functions import rules, text_key
from dailymart.operators import orphan_keys, orphans
from dailymart.plans import reports, rollup
from dailymart.plans.mart import FACT
from dailymart.plans.models import Models, failure_rates_by_listing
from dailymart.plans.rollup import Rollup
from dailymart.plans.staging import stg_weather
from dailymart.quality import CATALOG, Check, failing_rows, key_presence, profiles, store_failures
from dailymart.quality.catalog import EXPRESSIONS, RATING_RANGE, TEMPERATURE_RANGE
from dailymart.schemas import HOURLY_METRICS, LOADED_AT
from dailymart.sinks.catalog import Catalog, days_by_listing
from dailymart.sinks.incremental import IncrementalMart
from dailymart.sinks.lake import Lake
from dailymart.sinks.loading import audit_summary, load_manifest
from dailymart.sources.files import MANIFEST, read_typed_csv, scan_csv
from dailymart.sources.projection import LOAD_TIME
from dailymart.sources.weather import flatten_hourly, split_coordinates, weather_locations, within_dates
from dailymart.workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]

# Fixed dates, so that results do not depend on the day of the run.
AS_OF = date(2024, 1, 20)
OVERVIEW_AS_OF = date(2024, 2, 10)


def plain(df: DataFrame) -> DataFrame:
    """Decimals as doubles, the form in which results leave the engine."""
    return df.select(
        *[
            F.col(f"`{f.name}`").cast("double").alias(f.name)
            if isinstance(f.dataType, T.DecimalType)
            else F.col(f"`{f.name}`")
            for f in df.schema.fields
        ]
    )


def _query(build: Callable[[Workspace], DataFrame]) -> Query:
    return lambda spark, sf_dir: plain(build(workspace(spark, sf_dir)))


def _on_fact(report: Callable[[DataFrame], DataFrame]) -> Query:
    return _query(lambda w: report(w.fact))


def _placed(report: DataFrame) -> DataFrame:
    """A report of few rows with each row's place in its order, so that the order is compared as well."""
    placed = report.withColumn("at", F.monotonically_increasing_id())
    return placed.withColumn("position", F.row_number().over(Window.orderBy("at")).cast("bigint")).drop("at")


def _ordered_on_fact(report: Callable[[DataFrame], DataFrame]) -> Query:
    return _query(lambda w: _placed(report(w.fact)))


def _skewed(w: Workspace) -> Models:
    """Models over raw tables in which one listing has half of the orders and one outlet most listings.

    Some keys are NULL.
    """
    hot = w.raw["listing"].agg(F.min("id")).scalar()
    order, listing = F.col("order_id"), F.col("id")
    by_listing = F.when(order % 2 == 0, hot).when(order % 7 != 0, F.col("listing_id"))
    by_outlet = F.when(listing % 3 != 0, F.lit(1).cast("bigint")).when(listing % 10 != 0, F.col("outlet_id"))
    return Models(
        {
            **w.raw,
            "orders": w.raw["orders"].withColumn("listing_id", by_listing),
            "listing": w.raw["listing"].withColumn("outlet_id", by_outlet),
        }
    )


def _model(name: str) -> Query:
    return _query(lambda w: w.lazy[name])


def model_queries() -> dict[str, Query]:
    names = [
        "stg_listing",
        "stg_orders",
        "stg_orders_daily",
        "stg_org",
        "stg_outlet",
        "stg_platform",
        "stg_rank",
        "stg_ratings_agg",
        "stg_weather",
        "int_orders_enriched",
        "int_rank_daily_avg",
        "int_ratings_metrics",
    ]
    return {name: _model(name) for name in names} | {
        "orders_by_status": _query(lambda w: w.lazy.orders_by_status()),
        "date_listing_spine": _query(lambda w: w.lazy.date_listing_spine()),
        "spine_text_keys": _query(lambda w: w.lazy.date_listing_spine().select(text_key("date", "listing_id").alias("day_key"))),
        "fct_daily": _query(lambda w: w.lazy.fact),
        "int_orders_enriched_skewed": _query(lambda w: _skewed(w)["int_orders_enriched"]),
        "fct_daily_skewed": _query(lambda w: _skewed(w).fact),
        "listing_failure_rates": _query(lambda w: failure_rates_by_listing(w.lazy.orders_by_status())),
    }


def _layer_row_counts(w: Workspace) -> DataFrame:
    return reports.layer_row_counts(
        {
            "raw.listing": w.raw["listing"],
            "raw.weather": w.raw["weather"],
            "staging.stg_listing": w.lazy["stg_listing"],
            f"mart.{FACT}": w.fact,
        }
    )


def report_queries() -> dict[str, Query]:
    return {
        "rpt01_overall_summary": _on_fact(reports.overall_summary),
        "rpt02_top_listings": _on_fact(reports.top_listings),
        "rpt03_platform_comparison": _ordered_on_fact(reports.platform_comparison),
        "rpt04_rating_impact": _ordered_on_fact(reports.rating_impact),
        "rpt04_unrated_share": _on_fact(reports.unrated_share),
        "rpt05_weather_impact": _ordered_on_fact(reports.weather_impact),
        "rpt06_availability_impact": _ordered_on_fact(reports.availability_impact),
        "rpt07_top_organizations": _on_fact(reports.top_organizations),
        "rpt08_monthly_trend": _ordered_on_fact(reports.monthly_trend),
        "rpt09_issue_summary": _on_fact(reports.issue_summary),
        "rpt10_worst_listings": _on_fact(partial(reports.worst_listings, failed_above=20)),
        "rpt10_worst_listings_published": _on_fact(reports.worst_listings),
        "rpt11_quality_flags": _on_fact(reports.quality_flag_distribution),
        "rpt12_day_of_week": _ordered_on_fact(reports.day_of_week),
        "rpt13_problem_records": _on_fact(reports.problem_records),
        "rpt14_listing_history": _on_fact(partial(reports.listing_history, listing_id=43)),
        "rpt15_correlation_matrix": _on_fact(reports.correlation_matrix),
        "rpt16_daily_summary": _on_fact(reports.daily_summary),
        "rpt16_orders_by_date": _on_fact(reports.orders_by_date),
        "rpt17_temperature_buckets": _on_fact(reports.temperature_buckets),
        "rpt17_temperature_buckets_known": _on_fact(reports.temperature_buckets_known),
        "rpt18_orders_by_temperature": _on_fact(reports.orders_by_temperature),
        "rpt19_top_outlets": _on_fact(reports.top_outlets),
        "rpt20_layer_row_counts": _query(_layer_row_counts),
        "rpt21_latest_rows": _on_fact(reports.latest_rows),
        "rpt22_recent_overview": _on_fact(partial(reports.recent_overview, as_of=OVERVIEW_AS_OF)),
        "rpt23_rating_distribution": _on_fact(reports.rating_distribution),
        "rpt24_platform_outlets": _on_fact(reports.platform_outlets),
    }


def _rollup(w: Workspace) -> Rollup:
    rollups = Rollup(Lake(w.spark, w.folder("rollups")), w.fact.schema)
    w.once("rollups", lambda: rollups.build(w.fact))
    return rollups


def _on_months(report: Callable[[DataFrame], DataFrame]) -> Query:
    return _query(lambda w: report(_rollup(w).listing_months))


def _rollup_refreshed(w: Workspace) -> DataFrame:
    """Months of listings summed up without the orders of the first half of January, which then come in."""
    rollups = Rollup(Lake(w.spark, w.folder("rollups_refreshed")), w.fact.schema)

    def build() -> None:
        rollups.build(Models({**w.raw, "orders": w.raw["orders"].where(F.col("placed_at") >= F.lit("2024-01-16").cast("timestamp_ntz"))}).fact)
        rollups.refresh(w.fact, [date(2023, 12, 5), date(2024, 1, 3)])

    w.once("refreshed rollups", build)
    return rollups.listing_months.select(
        *rollup.KEYS, "sum_orders", "sum_busy_failed", *[f"{n}_{m}" for m in ("failure", "busy_uptime", "rated", "rank") for n in ("sum", "count")]
    )


def rollup_queries() -> dict[str, Query]:
    """The reports that add up, from the rollups instead of the fact."""
    return {
        "rollup_rpt02_top_listings": _on_months(rollup.top_listings),
        "rollup_rpt03_platform_comparison": _on_months(lambda months: _placed(rollup.platform_comparison(months))),
        "rollup_rpt07_top_organizations": _on_months(rollup.top_organizations),
        "rollup_rpt08_monthly_trend": _on_months(lambda months: _placed(rollup.monthly_trend(months))),
        "rollup_rpt10_worst_listings": _on_months(partial(rollup.worst_listings, failed_above=20)),
        "rollup_rpt16_daily_summary": _query(lambda w: reports.merged_days(_rollup(w).day_parts)),
        "rollup_rpt19_top_outlets": _on_months(rollup.top_outlets),
        "rollup_rpt24_platform_outlets": _on_months(rollup.platform_outlets),
        "rollup_refreshed": _query(_rollup_refreshed),
    }


def _checks(select: Callable[[Check], bool]) -> Query:
    chosen = [c for c in CATALOG if select(c)]
    return _query(lambda w: w.check(chosen, as_of=AS_OF))


DUPLICATE_ORDERS = Check("raw_orders", "unique", ("order_id",))
RAW_STATUS = Check("raw_orders", "accepted_values", ("status",), values=tuple(rules.ORDER_STATUSES))
RAW_RATING = Check("raw_ratings_agg", "range", expression=RATING_RANGE.expression)


def _unplaced_listings(w: Workspace) -> DataFrame:
    """Listings (whole rows) whose outlet has no usable coordinates."""
    placed = w.lazy["stg_outlet"].where(F.col("has_valid_coordinates"))
    rows = orphans(w.lazy["stg_listing"], "outlet_id", placed, "outlet_id")
    return rows.select("listing_id", "outlet_id")


def _hot_days(w: Workspace) -> DataFrame:
    """The temperature check on readings scaled up by a half, so that it has something to find."""
    scaled = w.lazy["stg_weather"].withColumns(
        {c: F.col(c) * F.lit(1.5).cast("decimal(2,1)") for c in ("avg_temperature", "max_temperature")}
    )
    check = Check(
        "scaled", "range", where=TEMPERATURE_RANGE.where, expression=TEMPERATURE_RANGE.expression
    )
    return failing_rows(check, {"scaled": scaled}).select(
        "date", "outlet_id", "avg_temperature", "min_temperature", "max_temperature"
    )


def _future_from_today(w: Workspace) -> DataFrame:
    """Days that lie after today once the middle of the data is moved to today; no day is injected."""
    ahead = F.datediff(F.current_date(), F.lit(date(2024, 1, 15)))
    moved = w.fact.withColumn("date", F.date_add("date", ahead))
    found = failing_rows(Check("moved", "no_future_dates", ("date",)), {"moved": moved})
    return found.select(F.date_sub("date", ahead).alias("date"), "record_count")


def _stored_failures(w: Workspace) -> DataFrame:
    """Failing rows of three checks written to ``test_results`` and counted there."""
    checks = [EXPRESSIONS[1], DUPLICATE_ORDERS, RAW_STATUS]
    w.once("stored failures", lambda: store_failures(w.results, w.checked, checks))
    return reports.layer_row_counts({c.name: w.results.read("test_results", c.name) for c in checks})


def _listing_keys(w: Workspace) -> DataFrame:
    """In how many rows of each source a listing occurs."""
    columns = {"raw_listing": "id", "raw_orders": "listing_id", "raw_ratings_agg": "listing_id", "raw_rank": "listing_id", FACT: "listing_id"}
    names = {m: "fact_rows" if m == FACT else m.removeprefix("raw_") + "_rows" for m in columns}
    return key_presence(w.checked, {names[m]: (m, c) for m, c in columns.items()})


def quality_queries() -> dict[str, Query]:
    return {
        "dq_not_null": _checks(lambda c: c.kind == "not_null" and not c.where),
        "dq_not_null_where": _checks(lambda c: c.kind == "not_null" and c.where is not None),
        "dq_unique": _checks(lambda c: c.kind == "unique" and len(c.columns) == 1),
        "dq_unique_composite": _checks(lambda c: c.kind == "unique" and len(c.columns) > 1),
        "dq_relationships": _checks(lambda c: c.kind == "relationships"),
        "dq_accepted_values": _checks(lambda c: c.kind == "accepted_values"),
        "dq_expression_severity": _checks(lambda c: c.kind == "expression"),
        "dq_ranges": _checks(lambda c: c.kind == "range"),
        "dq_all_checks": _checks(lambda c: True),
        "dq_key_presence": _query(_listing_keys),
        "dq_future_dates": _query(
            lambda w: failing_rows(Check(FACT, "no_future_dates", ("date",)), w.checked, as_of=AS_OF)
        ),
        "dq_future_dates_today": _query(_future_from_today),
        "dq_rating_range_rows": _query(
            lambda w: failing_rows(RAW_RATING, w.lazy).select("date", "listing_id", "avg_rating")
        ),
        "dq_temperature_rows": _query(_hot_days),
        "dq_duplicate_orders": _query(lambda w: failing_rows(DUPLICATE_ORDERS, w.lazy)),
        "dq_unexpected_status": _query(lambda w: failing_rows(RAW_STATUS, w.lazy)),
        "dq_discrepancy_rows": _query(
            lambda w: failing_rows(EXPRESSIONS[1], w.checked).select("date", "listing_id", "data_quality_flag")
        ),
        "dq_stored_failures": _query(_stored_failures),
        "dq_unplaced_listings": _query(_unplaced_listings),
        "dq_missing_parents": _query(
            lambda w: orphan_keys(w.lazy["stg_listing"], "outlet_id", w.raw["weather"], "outlet_id")
        ),
        "dq_source_rows": _query(lambda w: profiles.source_rows(w.raw["outlet"])),
        "dq_rowcount_recon": _query(
            lambda w: profiles.row_count_reconciliation(_stored_weather(w), flatten_hourly(_payloads(w))[0])
        ),
        "dq_null_profile": _query(lambda w: profiles.null_profile(w.raw["weather"])),
        "dq_range_profile": _query(lambda w: profiles.range_profile(w.raw["weather"])),
        "dq_coverage": _query(lambda w: profiles.coverage_profile(w.raw["weather"])),
        "dq_orphans": _query(lambda w: profiles.orphan_profile(w.raw["weather"], w.raw["outlet"])),
    }


def _payloads(w: Workspace, broken: bool = False) -> DataFrame:
    """Payload texts rebuilt from the hourly rows, one per outlet and day (at most 24 hours each).

    With ``broken``, one day in outlets divisible by 7 loses its last wind value.
    """
    hour = F.struct(F.col("datetime"), *HOURLY_METRICS)
    daily = (
        w.raw["weather"]
        .groupBy("outlet_id", F.to_date("datetime").alias("day"))
        .agg(F.array_sort(F.collect_list(hour)).alias("hours"))
    )
    arrays = {m: F.col(f"hours.{m}").cast("array<double>") for m in HOURLY_METRICS}
    if broken:
        hit = (F.col("outlet_id") % 7 == 0) & (F.dayofmonth("day") == 1)
        wind = arrays["wind_speed_10m"]
        arrays["wind_speed_10m"] = F.when(hit, F.slice(wind, 1, F.size(wind) - 1)).otherwise(wind)
    times = F.col("hours.datetime").cast("array<string>")
    hourly = F.struct(times.alias("time"), *[a.alias(m) for m, a in arrays.items()])
    return daily.select("outlet_id", F.to_json(F.struct(hourly.alias("hourly"))).alias("payload"))


def _coordinate_rejects(w: Workspace) -> DataFrame:
    """Coordinate check on doubled latitudes, which leave the valid range."""
    doubled = w.raw["outlet"].select(
        F.col("id").alias("outlet_id"), (F.col("latitude") * 2).alias("latitude"), "longitude"
    )
    return split_coordinates(doubled)[1].select("outlet_id", "reason")


def _write_csv(df: DataFrame, path: str) -> None:
    texts = [F.col(f"`{c}`").cast("string").alias(c) for c in df.columns if c != LOADED_AT]
    writer = df.select(*texts).write.mode("overwrite").option("header", True).option("escape", '"')
    writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)


def _csv_round_trip(w: Workspace) -> DataFrame:
    """All raw orders written as CSV with some unreadable times, then read back by the typed scan."""
    path = w.folder("files/orders_with_bad_times.csv")
    bad = F.when(F.col("order_id") % 97 == 0, F.lit("not a time"))
    texts = w.raw["orders"].withColumn("placed_at", F.coalesce(bad, F.col("placed_at").cast("string")))
    w.once("orders file", lambda: _write_csv(texts, path))
    return read_typed_csv(w.spark, path, "orders")


def _csv_parts(w: Workspace) -> tuple[DataFrame, DataFrame]:
    """All raw orders in part files with two orders of columns; some lines have a field too many."""
    path = w.folder("files/order_parts")

    def write() -> None:
        even = F.col("order_id") % 2 == 0
        # Without a quote character a comma in the last column separates one more field.
        status = F.when(F.col("order_id") % 101 == 0, F.concat("status", F.lit(",surplus"))).otherwise(F.col("status"))
        parts = [
            w.raw["orders"].where(even).select("listing_id", "order_id", "placed_at", status.alias("status")),
            w.raw["orders"].where(~even).select("order_id", "status", "listing_id", "placed_at"),
        ]
        for mode, part in zip(("overwrite", "append"), parts):
            texts = part.select(*[F.col(c).cast("string").alias(c) for c in part.columns])
            writer = texts.write.mode(mode).option("header", True).option("quote", "\u0000")
            writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)

    w.once("order parts", write)
    return scan_csv(w.spark, path, "orders")


def _csv_rejects(w: Workspace) -> DataFrame:
    fields = F.split("line", ",")
    return _csv_parts(w)[1].select(fields[1].cast("bigint").alias("order_id"), "reason")


def _load_audit(w: Workspace) -> DataFrame:
    """All manifest files written from the raw entities, then loaded with the audit."""
    folder = w.folder("files/manifest")

    def load() -> DataFrame:
        for file, table in MANIFEST.items():
            _write_csv(w.raw[table], f"{folder}/{file}")
        return load_manifest(w.spark, folder, w.results, LOAD_TIME)

    return audit_summary(w.once("manifest load", load))


def _load_again(w: Workspace) -> DataFrame:
    """Organizations loaded twice, the second time added to the first."""
    folder, lake = w.folder("files/again"), Lake(w.spark, w.folder("again"))

    def load() -> DataFrame:
        _write_csv(w.raw["org"], f"{folder}/org.csv")
        for _ in range(2):
            audit = load_manifest(w.spark, folder, lake, LOAD_TIME, manifest={"org.csv": "org"})
        return audit

    return w.once("load again", load)


def _load_faults(w: Workspace) -> DataFrame:
    """A replacing load after a good one: a missing, an empty and two bad files leave the stored rows alone."""
    folder, lake = w.folder("files/faults"), Lake(w.spark, w.folder("faults"))

    def load() -> DataFrame:
        good, bad = f"{folder}/good", f"{folder}/bad"
        tables = ["org", "platform", "outlet", "listing"]
        manifest = {f"{t}.csv": t for t in tables}
        for table in tables:
            _write_csv(w.raw[table], f"{good}/{table}.csv")
        load_manifest(w.spark, good, lake, LOAD_TIME, manifest=manifest)
        _write_csv(w.raw["org"].where("id < 0"), f"{bad}/org.csv")
        _write_csv(w.raw["outlet"].withColumn("id", F.concat(F.lit("no. "), F.col("id").cast("string"))), f"{bad}/outlet.csv")
        _write_csv(w.raw["listing"].withColumn("colour", F.lit("red")), f"{bad}/listing.csv")
        return load_manifest(w.spark, bad, lake, LOAD_TIME, replace=True, manifest=manifest)

    audit = w.once("load with faults", load)
    stored = reduce(
        DataFrame.union,
        [lake.read_raw(t).agg(F.lit(t).alias("table_name"), F.count("*").alias("stored")) for t in ("org", "platform", "outlet", "listing")],
    )
    return audit.withColumn("reason", F.substring_index("reason", " in ", 1)).join(stored, "table_name")


def _fact_refreshed(w: Workspace) -> DataFrame:
    """The fact built without the orders of the first half of January, then refreshed for that month."""
    lake = Lake(w.spark, w.folder("refreshed"))
    late = F.col("placed_at") < F.lit("2024-01-16").cast("timestamp_ntz")

    def build() -> None:
        before = Models({**w.raw, "orders": w.raw["orders"].where(~late)})
        lake.build_fact(before.fact, "mart", FACT)
        lake.refresh_fact(w.lazy.fact, "mart", FACT, date(2023, 12, 5), date(2024, 12, 31))

    w.once("refreshed fact", build)
    return lake.read("mart", FACT).drop("month")


DIMENSIONS = ("listing", "outlet", "org", "platform")


def _incremental(w: Workspace, name: str) -> IncrementalMart:
    lake = Lake(w.spark, w.folder(name))
    return IncrementalMart(lake, {t: w.raw[t] for t in DIMENSIONS}, period="week")


def _two_loads(w: Workspace) -> DataFrame:
    """The fact after two loads: late orders, and versions of earlier ones, are merged into the weeks they touch."""
    mart = _incremental(w, "two_loads")
    facts = {t: df for t, df in w.raw.items() if t not in DIMENSIONS}
    order = F.col("order_id")
    # Of every tenth order the version that counts comes late, and with it all orders of some listings in one week.
    late = ((order % 10 == 0) & (F.col("status") != "pending")) | (
        (F.col("listing_id") % 3 == 0) & F.col("placed_at").between(F.lit("2024-01-08").cast("timestamp_ntz"), F.lit("2024-01-12").cast("timestamp_ntz"))
    )

    def build() -> None:
        mart.load("first", {**facts, "orders": facts["orders"].where(~late)})
        mart.load("second", {"orders": facts["orders"].where(late)})

    w.once("two loads", build)
    return mart.fact.drop("period")


def _late_ratings(w: Workspace) -> DataFrame:
    """The fact after late ratings: those of one day come a load later, and one listing's are corrected."""
    mart = _incremental(w, "late_ratings")
    facts = {t: df for t, df in w.raw.items() if t not in DIMENSIONS}
    ratings = facts["ratings_agg"]
    late = F.col("date") == F.lit(date(2024, 1, 12))
    corrected = F.col("listing_id") % 10 == 2
    earlier = F.lit("2024-01-31").cast("timestamp_ntz")
    wrong = ratings.where(~late).withColumns(
        {
            "cnt_ratings": F.when(corrected, F.col("cnt_ratings") + 3).otherwise(F.col("cnt_ratings")).cast("int"),
            LOADED_AT: F.when(corrected, earlier).otherwise(F.col(LOADED_AT)),
        }
    )

    def build() -> None:
        mart.load("first", {**facts, "ratings_agg": wrong})
        mart.load("second", {"ratings_agg": ratings.where(late | corrected)})

    w.once("late ratings", build)
    return mart.fact.drop("period")


def _load_repeated(w: Workspace) -> DataFrame:
    """Two loads of organizations under ids; the second one's id, given again, is refused."""
    lake = Lake(w.spark, w.folder("load_ids"))

    def load() -> None:
        for load_id, part in (("monday", 0), ("tuesday", 1), ("tuesday", 1)):
            rows = w.raw["org"].where(F.col("id") % 2 == part)
            with suppress(ValueError):
                lake.load_raw(rows.drop(LOADED_AT), "org", LOAD_TIME, replace=False, load_id=load_id)

    w.once("load ids", load)
    return lake.read_raw("org")


def _catalog(w: Workspace) -> Catalog:
    """All layers of the input under names in the catalog, those of each folder of tables under a prefix of its own."""
    catalog = Catalog(w.spark, w.folder("catalog"), prefix=f"s{abs(zlib.crc32(w.sf_dir.encode()))}_")

    def publish() -> None:
        catalog.publish(w.raw, w.lazy, ["int_rank_daily_avg"])
        catalog.save_bucketed(w.spark.table(catalog.name(FACT)), f"{catalog.name(FACT)}_by_listing", "listing_id", 8, ["date"])

    w.once("catalog", publish)
    return catalog


def _catalog_layers(w: Workspace) -> DataFrame:
    """Orders by status, of listings and days in the mart, from the layers by name in plain SQL."""
    catalog = _catalog(w)
    return w.spark.sql(
        f"""SELECT o.status, f.platform_name, count(*) AS n_orders, count(DISTINCT f.listing_id) AS n_listings,
              sum(r.total_readings) AS n_readings
            FROM {catalog.name("stg_orders")} o JOIN {catalog.name(FACT)} f ON f.listing_id = o.listing_id AND f.date = o.order_date
            LEFT JOIN {catalog.name("int_rank_daily_avg")} r ON r.listing_id = o.listing_id AND r.date = o.order_date
            GROUP BY o.status, f.platform_name"""
    )


def _catalog_view(model: str) -> Query:
    return _query(lambda w: w.spark.table(_catalog(w).name(model)))


def _bucketed_days(w: Workspace) -> DataFrame:
    """Days and orders by listing from the bucketed fact, which is not shuffled."""
    catalog = _catalog(w)
    return days_by_listing(w.spark.table(f"{catalog.name(FACT)}_by_listing"), w.spark.table(catalog.name("stg_listing")))


def _csv_dates(w: Workspace) -> DataFrame:
    """All snapshots written as CSV with some unreadable dates and some with a time, then read back by the typed scan."""
    path = w.folder("files/snapshots_with_bad_dates.csv")
    listing, day = F.col("listing_id"), F.col("date").cast("string")
    texts = w.raw["orders_daily"].withColumn(
        "date",
        F.when(listing % 7 == 0, F.lit("no date"))
        .when(listing % 7 == 1, F.concat(day, F.lit(" 23:59:59")))
        .when(listing % 7 == 2, F.lit("NaT?"))
        .otherwise(day),
    )
    w.once("snapshots file", lambda: _write_csv(texts, path))
    return read_typed_csv(w.spark, path, "orders_daily").drop(LOADED_AT)


def _csv_quoted(w: Workspace) -> DataFrame:
    """All organizations written as CSV with line breaks, quotes and commas in their names, in several files, then read back."""
    path = w.folder("files/org_with_breaks.csv")
    name = F.when(F.col("id") % 3 == 0, F.concat(F.lit('"A,\n\n'), F.col("name"), F.lit('\r\n"')))
    texts = w.raw["org"].withColumn("name", F.coalesce(name, F.col("name"))).repartition(3, "id")
    w.once("broken lines file", lambda: _write_csv(texts, path))
    return read_typed_csv(w.spark, path, "org").drop(LOADED_AT)


def _stored_weather(w: Workspace) -> DataFrame:
    """Payloads flattened and stored in place of earlier rows, read back from storage."""
    rows, _ = flatten_hourly(_payloads(w))
    w.once("weather ingest", lambda: w.results.load_raw(rows, "weather", LOAD_TIME))
    return w.results.read_raw("weather")


def _weather_ingest(w: Workspace) -> DataFrame:
    """Stored weather aggregated per day."""
    return stg_weather(_stored_weather(w))


def source_queries() -> dict[str, Query]:
    return {
        "src_csv": _query(_csv_round_trip),
        "src_json_flatten": _query(lambda w: flatten_hourly(_payloads(w, broken=True))[0]),
        "src_json_rejects": _query(
            lambda w: flatten_hourly(_payloads(w, broken=True))[1].select("outlet_id", "reason")
        ),
        "src_locations": _query(lambda w: weather_locations(w.raw["outlet"])),
        "src_coord_validate": _query(_coordinate_rejects),
        "src_date_range": _query(
            lambda w: within_dates(w.raw["weather"], date(2024, 1, 10), date(2024, 1, 20)).select(
                "outlet_id", "datetime"
            )
        ),
        "src_weather_ingest": _query(_weather_ingest),
        "src_csv_dates": _query(_csv_dates),
        "src_csv_quoted_breaks": _query(_csv_quoted),
        "src_csv_parts": _query(lambda w: _csv_parts(w)[0]),
        "src_csv_rejects": _query(_csv_rejects),
        "load_audit": _query(_load_audit),
        "load_append": _query(_load_again),
        "load_failed_keeps_rows": _query(_load_faults),
        "catalog_layers": _query(_catalog_layers),
        "catalog_stg_weather": _catalog_view("stg_weather"),
        "catalog_stg_ratings_agg": _catalog_view("stg_ratings_agg"),
        "catalog_bucketed_days": _query(_bucketed_days),
        "load_repeated_id": _query(_load_repeated),
        "fct_refreshed": _query(_fact_refreshed),
        "fct_two_loads": _query(_two_loads),
        "fct_late_ratings": _query(_late_ratings),
    }


def all_queries() -> dict[str, Query]:
    return {**model_queries(), **report_queries(), **rollup_queries(), **quality_queries(), **source_queries()}
