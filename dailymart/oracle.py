"""The registered queries again as plain SQL, for an independent engine to check the results.

Written against the definition, not against the Spark plans: the fact, for one, starts from the full
product of dates and listings. Decimals leave every query as DOUBLE on both sides.
"""

from __future__ import annotations

import re

from dailymart.quality import CATALOG
from dailymart.quality.checks import Check


def rounded(expr: str, digits: int) -> str:
    """Round half away from zero through a wide decimal, as a double."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def average(column: str, digits: int, where: str = "") -> str:
    return rounded(f"avg({column}){where}", digits)


def plain_mean(column: str) -> str:
    return f"CAST(sum({column}) AS DOUBLE) / CAST(count({column}) AS DOUBLE)"


RATED = " FILTER (WHERE avg_rating > 0)"
LOADED = "TIMESTAMP '2024-02-01 00:00:00' AS loaded_at"

CTES: dict[str, str] = {
    "raw_platform": f"""
        SELECT CAST(r_regionkey AS BIGINT) AS id,
               if(r_regionkey < 3, 'Delivery', 'Aggregator') AS "group",
               r_name AS name, if(r_regionkey % 2 = 0, 'US', 'UK') AS country, {LOADED}
        FROM region""",
    "raw_org": f"""
        SELECT CAST(n_nationkey AS BIGINT) AS id, '  ' || n_name || ' ' AS name,
               TIMESTAMP '2020-01-01 00:00:00' AS "timestamp", {LOADED} FROM nation
        UNION ALL
        SELECT n_nationkey, 'stale', TIMESTAMP '2019-01-01 00:00:00', {LOADED}
        FROM nation WHERE n_nationkey % 5 = 0""",
    "raw_outlet": f"""
        SELECT s_suppkey AS id, CAST(s_nationkey AS BIGINT) AS org_id, s_name AS name,
               CAST(CASE s_suppkey % 17 WHEN 3 THEN 0 WHEN 5 THEN NULL ELSE s_suppkey % 90 END
                    AS DECIMAL(10,7)) AS latitude,
               CAST(if(s_suppkey % 17 = 3, 0, s_suppkey % 180) AS DECIMAL(10,7)) AS longitude,
               TIMESTAMP '2020-06-01 00:00:00' AS "timestamp", {LOADED} FROM supplier
        UNION ALL
        SELECT s_suppkey, s_nationkey, 'stale', 0, 0, TIMESTAMP '2020-05-01 00:00:00', {LOADED}
        FROM supplier WHERE s_suppkey % 10 = 0""",
    "raw_listing": f"""
        SELECT user_id AS id, user_id % (SELECT count(*) FROM supplier) AS outlet_id, user_id % 5 AS platform_id,
               TIMESTAMP '2021-01-02 00:00:00' AS "timestamp", {LOADED}
        FROM (SELECT DISTINCT user_id FROM events)
        UNION ALL
        SELECT user_id, user_id % (SELECT count(*) FROM supplier), (user_id + 1) % 5,
               TIMESTAMP '2021-01-01 00:00:00', {LOADED}
        FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 8 = 0)""",
    "raw_orders": f"""
        SELECT user_id AS listing_id, event_id AS order_id, ts AS placed_at,
               CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'view' THEN '  Completed '
                    WHEN 'signup' THEN 'pending' WHEN 'error' THEN 'CANCELLED' ELSE 'refunded' END AS status, {LOADED}
        FROM events WHERE event_id % 11 <> 0
        UNION ALL
        SELECT user_id, event_id, ts - INTERVAL 1 HOUR, 'pending', {LOADED}
        FROM events WHERE event_id % 50 = 0 AND event_id % 11 <> 0""",
    "raw_orders_daily": f"""
        SELECT CAST(ts AS DATE) AS date, user_id AS listing_id,
               CAST(count(*) + if(user_id % 13 = 0, 7, 0) - if(user_id % 19 = 1, 20, 0) AS INT) AS orders,
               TIMESTAMP '2024-02-01 00:00:00' AS "timestamp", {LOADED}
        FROM events WHERE user_id % 6 <> 0 GROUP BY CAST(ts AS DATE), user_id
        UNION ALL
        SELECT CAST(ts AS DATE) AS date, user_id, 99, TIMESTAMP '2024-01-31 00:00:00', {LOADED}
        FROM events WHERE user_id % 9 = 1 GROUP BY CAST(ts AS DATE), user_id""",
    "raw_rank": f"""
        SELECT user_id AS listing_id, CAST(ts AS DATE) AS date, ts AS "timestamp",
               event_type NOT IN ('error', 'click') AS is_online,
               if(event_type NOT IN ('error', 'click'), CAST(value AS DECIMAL(10,2)), NULL) AS rank, {LOADED}
        FROM events WHERE user_id % 3 <> 0""",
    "raw_ratings_agg": f"""
        SELECT date, user_id AS listing_id, CAST(day(date) * (user_id % 5) AS INT) AS cnt_ratings,
               CAST(((user_id * 7 + day(date) * 3) % 56 - 2) * 0.1 AS DECIMAL(3,2)) AS avg_rating, {LOADED}
        FROM (SELECT DISTINCT CAST(ts AS DATE) AS date, user_id FROM events WHERE user_id % 4 <> 1)""",
    "raw_weather": f"""
        SELECT s.id AS outlet_id, CAST(d.date AS TIMESTAMP) + to_hours(CAST(h.h AS INT)) AS datetime,
               if((s.id + h.h) % 97 = 96, NULL,
                  CAST(((s.id * 7 + day(d.date) * 13 + h.h * 5) % 551) * 0.1 - 12 AS DECIMAL(5,2))) AS temperature_2m,
               CAST((s.id + h.h) % 101 AS INT) AS relative_humidity_2m,
               CAST(((s.id + h.h * 3) % 400) * 0.1 AS DECIMAL(5,2)) AS wind_speed_10m, {LOADED}
        FROM (SELECT DISTINCT id FROM raw_outlet
              WHERE latitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0)) s,
             (SELECT DISTINCT CAST(ts AS DATE) AS date FROM events) d,
             range(24) h(h)
        WHERE NOT (h.h = 23 AND (s.id + day(d.date)) % 5 = 0)""",
    "stg_listing": """
        SELECT id AS listing_id, outlet_id, platform_id, "timestamp" AS listing_timestamp, loaded_at FROM raw_listing
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC NULLS FIRST, loaded_at DESC) = 1""",
    "stg_orders": """
        SELECT order_id, listing_id, placed_at, placed_at::DATE AS order_date,
               lower(trim(status, ' ')) AS status, loaded_at FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY placed_at DESC NULLS FIRST, loaded_at DESC) = 1""",
    "stg_orders_daily": """
        SELECT date, listing_id, if(orders < 0, 0, orders) AS daily_orders, "timestamp", loaded_at
        FROM raw_orders_daily
        QUALIFY row_number() OVER (PARTITION BY listing_id, date ORDER BY "timestamp" DESC NULLS FIRST) = 1""",
    "stg_org": """
        SELECT id AS org_id, trim(name, ' ') AS org_name, "timestamp" AS org_timestamp, loaded_at FROM raw_org
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC NULLS FIRST) = 1""",
    "stg_outlet": """
        SELECT id AS outlet_id, org_id, name AS outlet_name, latitude, longitude,
               coalesce(abs(latitude) + abs(longitude) <> 0, false) AS has_valid_coordinates,
               "timestamp" AS outlet_timestamp, loaded_at FROM raw_outlet
        QUALIFY row_number() OVER (PARTITION BY id ORDER BY "timestamp" DESC NULLS FIRST) = 1""",
    "stg_platform": """
        SELECT id AS platform_id, "group" AS platform_group, name AS platform_name,
               country AS platform_country, loaded_at FROM raw_platform""",
    "stg_rank": """
        SELECT listing_id, date, "timestamp" AS rank_timestamp, is_online, rank, loaded_at FROM raw_rank""",
    "stg_ratings_agg": """
        SELECT date, listing_id, cnt_ratings AS rating_count,
               if(avg_rating IS NULL, NULL, least(greatest(avg_rating, 0), 5))::DECIMAL(3,2) AS avg_rating, loaded_at
        FROM (SELECT * FROM raw_ratings_agg
              QUALIFY row_number() OVER (PARTITION BY listing_id, date ORDER BY loaded_at DESC NULLS FIRST) = 1)
        WHERE cnt_ratings > 0""",
    "stg_weather": f"""
        SELECT outlet_id, datetime::DATE AS date,
               {average("temperature_2m", 2)} AS avg_temperature,
               {average("relative_humidity_2m", 2)} AS avg_humidity,
               {average("wind_speed_10m", 2)} AS avg_wind_speed,
               min(temperature_2m) AS min_temperature, max(temperature_2m) AS max_temperature,
               count(*) AS hourly_records_count, count(*) = 24 AS is_complete_day
        FROM raw_weather WHERE temperature_2m IS NOT NULL GROUP BY ALL""",
    "int_orders_enriched": """
        SELECT order_id, order_date, placed_at, status, listing_id, listing_timestamp, outlet_id, outlet_name,
               latitude, longitude, has_valid_coordinates, org_id, org_name,
               platform_id, platform_name, platform_group, platform_country
        FROM stg_orders JOIN stg_listing USING (listing_id) JOIN stg_outlet USING (outlet_id)
             JOIN stg_org USING (org_id) JOIN stg_platform USING (platform_id)""",
    "rank_day": f"""
        SELECT listing_id, date, coalesce({average("rank", 2, " FILTER (WHERE is_online)")}, 0) AS avg_rank,
               coalesce(min(rank) FILTER (WHERE is_online), 0) AS best_rank,
               coalesce(max(rank) FILTER (WHERE is_online), 0) AS worst_rank,
               count(*) AS total_readings, count(*) FILTER (WHERE is_online) AS online_readings,
               count(*) FILTER (WHERE NOT is_online) AS offline_readings,
               {rounded("100.0 * count(*) FILTER (WHERE is_online) / count(*)", 1)} AS uptime_percentage,
               bool_or(is_online) AS was_ever_online
        FROM stg_rank GROUP BY ALL""",
    "int_rank_daily_avg": """
        SELECT *, worst_rank - best_rank AS rank_volatility,
               CASE WHEN uptime_percentage = 100 THEN 'Always Online' WHEN uptime_percentage >= 75 THEN 'Mostly Online'
                    WHEN uptime_percentage >= 25 THEN 'Partially Online'
                    WHEN uptime_percentage > 0 THEN 'Mostly Offline' ELSE 'Always Offline' END AS availability_category
        FROM rank_day""",
    "int_ratings_metrics": """
        SELECT date, listing_id, rating_count - coalesce(lag(rating_count) OVER prior, 0) AS daily_new_ratings,
               rating_count AS cumulative_rating_count, coalesce(avg_rating, 0) AS avg_rating,
               coalesce(avg_rating - lag(avg_rating) OVER prior, 0) AS rating_delta,
               CASE WHEN lag(avg_rating) OVER prior IS NULL THEN 'new'
                    WHEN avg_rating > lag(avg_rating) OVER prior THEN 'improving'
                    WHEN avg_rating < lag(avg_rating) OVER prior THEN 'declining' ELSE 'stable' END AS rating_trend
        FROM stg_ratings_agg WINDOW prior AS (PARTITION BY listing_id ORDER BY date NULLS LAST)""",
    "orders_by_status": f"""
        SELECT *, completed_orders + pending_orders AS successful_orders,
               cancelled_orders + refunded_orders AS failed_orders,
               {rounded("100.0 * (cancelled_orders + refunded_orders) / total_orders", 1)} AS order_failure_rate
        FROM (SELECT order_date AS date, listing_id, count(*) AS total_orders,
                     count(*) FILTER (WHERE status = 'completed') AS completed_orders, count(*) FILTER (WHERE status = 'pending') AS pending_orders,
                     count(*) FILTER (WHERE status = 'cancelled') AS cancelled_orders, count(*) FILTER (WHERE status = 'refunded') AS refunded_orders
              FROM stg_orders GROUP BY ALL)""",
    "all_days": """
        SELECT date, listing_id FROM (SELECT DISTINCT date FROM stg_orders_daily),
                                     (SELECT DISTINCT listing_id FROM stg_listing)""",
    "fact_day": """
        SELECT a.date, a.listing_id, s.daily_orders AS snapshot, o.total_orders AS counted,
               o.* EXCLUDE (date, listing_id), r.* EXCLUDE (date, listing_id), k.* EXCLUDE (date, listing_id)
        FROM all_days a
             LEFT JOIN stg_orders_daily s USING (date, listing_id)
             LEFT JOIN orders_by_status o USING (date, listing_id)
             LEFT JOIN int_ratings_metrics r USING (date, listing_id)
             LEFT JOIN int_rank_daily_avg k USING (date, listing_id)
        WHERE s.daily_orders IS NOT NULL OR o.total_orders IS NOT NULL
              OR r.avg_rating IS NOT NULL OR k.avg_rank IS NOT NULL""",
    "fct": """
        SELECT f.date, f.listing_id, l.listing_timestamp, l.outlet_id, u.outlet_name,
               CAST(u.latitude AS DOUBLE) AS latitude, CAST(u.longitude AS DOUBLE) AS longitude,
               u.has_valid_coordinates, u.org_id, g.org_name,
               l.platform_id, p.platform_name, p.platform_group, p.platform_country,
               CAST(coalesce(snapshot, 0) AS BIGINT) AS daily_orders_from_snapshot,
               coalesce(counted, 0) AS daily_orders, coalesce(counted, 0) AS total_orders,
               CASE WHEN snapshot IS NULL THEN 'snapshot_missing' WHEN snapshot < 0 THEN 'snapshot_negative'
                    WHEN abs(snapshot - coalesce(counted, 0)) > 5 THEN 'large_discrepancy'
                    WHEN snapshot <> counted THEN 'minor_discrepancy' ELSE 'match' END AS data_quality_flag,
               coalesce(counted, 0) - coalesce(snapshot, 0) AS snapshot_vs_actual_diff,
               coalesce(completed_orders, 0) AS completed_orders, coalesce(pending_orders, 0) AS pending_orders,
               coalesce(cancelled_orders, 0) AS cancelled_orders, coalesce(refunded_orders, 0) AS refunded_orders,
               coalesce(successful_orders, 0) AS successful_orders, coalesce(failed_orders, 0) AS failed_orders,
               coalesce(order_failure_rate, 0) AS order_failure_rate,
               CAST(coalesce(daily_new_ratings, 0) AS BIGINT) AS daily_new_ratings,
               CAST(coalesce(cumulative_rating_count, 0) AS BIGINT) AS cumulative_rating_count,
               CAST(coalesce(avg_rating, 0) AS DOUBLE) AS avg_rating,
               CAST(coalesce(rating_delta, 0) AS DOUBLE) AS rating_delta,
               coalesce(rating_trend, 'No Ratings') AS rating_trend,
               avg_rank, CAST(best_rank AS DOUBLE) AS daily_best_rank, CAST(worst_rank AS DOUBLE) AS daily_worst_rank,
               CAST(rank_volatility AS DOUBLE) AS rank_volatility,
               coalesce(total_readings, 0) AS rank_total_readings, coalesce(online_readings, 0) AS rank_online_readings,
               coalesce(offline_readings, 0) AS rank_offline_readings,
               coalesce(uptime_percentage, 0) AS uptime_percentage, coalesce(was_ever_online, false) AS was_ever_online,
               coalesce(availability_category, 'No Data') AS availability_category,
               w.avg_temperature, w.avg_humidity, w.avg_wind_speed,
               CAST(w.min_temperature AS DOUBLE) AS min_temperature,
               CAST(w.max_temperature AS DOUBLE) AS max_temperature,
               coalesce(w.is_complete_day, false) AS weather_data_complete,
               CASE WHEN avg_rating >= 4.5 THEN 'Excellent' WHEN avg_rating >= 4.0 THEN 'Good'
                    WHEN avg_rating >= 3.0 THEN 'Average' WHEN avg_rating > 0 THEN 'Poor'
                    ELSE 'No Ratings' END AS rating_category,
               CASE WHEN w.avg_temperature < 10 THEN 'Cold' WHEN w.avg_temperature < 20 THEN 'Mild'
                    WHEN w.avg_temperature < 30 THEN 'Warm' WHEN w.avg_temperature IS NOT NULL THEN 'Hot'
                    ELSE 'Unknown' END AS temperature_category,
               coalesce(greatest(snapshot, counted), 0) > 0 AND coalesce(uptime_percentage, 0) = 0
                   AS is_offline_order_anomaly,
               coalesce(uptime_percentage > 0 AND uptime_percentage < 50 AND order_failure_rate > 30, false)
                   AS is_high_failure_when_offline
        FROM fact_day f JOIN stg_listing l USING (listing_id)
             LEFT JOIN stg_outlet u ON u.outlet_id = l.outlet_id
             LEFT JOIN stg_org g ON g.org_id = u.org_id
             LEFT JOIN stg_platform p ON p.platform_id = l.platform_id
             LEFT JOIN stg_weather w ON w.outlet_id = l.outlet_id AND w.date = f.date""",
}


def sql(body: str, extra: dict[str, str] | None = None) -> str:
    """``body`` behind the WITH clauses it needs."""
    known = {**CTES, **(extra or {})}
    needed: list[str] = []

    def visit(text: str) -> None:
        for name in known:
            if name not in needed and re.search(rf"\b{name}\b", text):
                visit(known[name])
                if name not in needed:
                    needed.append(name)

    visit(body)
    if not needed:
        return body
    clauses = ",\n".join(f"{name} AS ({known[name].strip()})" for name in needed)
    return f"WITH {clauses}\n{body.strip()}"


def _doubles(*columns: str) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in columns)


ORDERS = "CAST(sum(daily_orders) AS BIGINT) AS total_orders"
FAILURE = f"{average('order_failure_rate', 1)} AS avg_failure_rate"
UPTIME = f"{average('uptime_percentage', 1)} AS avg_uptime"
PER_LISTING = "listing_id, outlet_name, org_name, platform_name"


def _model_queries() -> dict[str, str]:
    decimals = {
        "stg_outlet": ["latitude", "longitude"],
        "stg_rank": ["rank"],
        "stg_ratings_agg": ["avg_rating"],
        "stg_weather": ["min_temperature", "max_temperature"],
        "int_orders_enriched": ["latitude", "longitude"],
        "int_rank_daily_avg": ["best_rank", "worst_rank", "rank_volatility"],
        "int_ratings_metrics": ["avg_rating", "rating_delta"],
    }
    models = [n for n in CTES if n.startswith(("stg_", "int_"))] + ["orders_by_status"]
    out = {}
    for name in models:
        columns = decimals.get(name, [])
        replaced = f" REPLACE ({_doubles(*columns)})" if columns else ""
        out[name] = sql(f"SELECT *{replaced} FROM {name}")
    out["date_listing_spine"] = sql("SELECT date, listing_id FROM fact_day")
    out["spine_text_keys"] = sql("SELECT strftime(date, '%Y-%m-%d') || '-' || listing_id AS day_key FROM fct")
    out["fct_daily"] = sql("SELECT * FROM fct")
    out |= {f"catalog_{name}": out[name] for name in ("stg_weather", "stg_ratings_agg")}
    skewed = {
        "raw_listing": f"""
            SELECT * REPLACE (CASE WHEN id % 3 <> 0 THEN 1 WHEN id % 10 <> 0 THEN outlet_id END AS outlet_id)
            FROM ({CTES["raw_listing"]})""",
        "raw_orders": f"""
            SELECT * REPLACE (CASE WHEN order_id % 2 = 0 THEN (SELECT min(user_id) FROM events)
                                   WHEN order_id % 7 <> 0 THEN listing_id END AS listing_id)
            FROM ({CTES["raw_orders"]})""",
    }
    places = f" REPLACE ({_doubles('latitude', 'longitude')})"
    out["int_orders_enriched_skewed"] = sql(f"SELECT *{places} FROM int_orders_enriched", skewed)
    out["fct_daily_skewed"] = sql("SELECT * FROM fct", skewed)
    out["listing_failure_rates"] = sql(
        f"""SELECT listing_id, count(*) AS active_days, CAST(sum(total_orders) AS BIGINT) AS total_orders,
                   CAST(sum(failed_orders) AS BIGINT) AS failed_orders,
                   {rounded("100.0 * sum(failed_orders) / sum(total_orders)", 1)} AS order_failure_rate
            FROM orders_by_status GROUP BY listing_id"""
    )
    return out


def _correlation(x: str, y: str) -> str:
    return rounded(
        f"covar_pop({x}, {y}) / nullif(stddev_pop({x}) FILTER (WHERE {y} IS NOT NULL)"
        f" * stddev_pop({y}) FILTER (WHERE {x} IS NOT NULL), 0)",
        3,
    )


def _issue(name: str, condition: str) -> str:
    return f"""SELECT '{name}' AS issue_type, count(*) FILTER (WHERE {condition}) AS occurrences,
                      {rounded(f"100.0 * count(*) FILTER (WHERE {condition}) / count(*)", 2)} AS pct_of_total FROM fct"""


def _share(group: str, count_as: str, where: str = "") -> str:
    return f"""SELECT {group}, count(*) AS "{count_as}",
                      {rounded("100.0 * count(*) / sum(count(*)) OVER ()", 2)} AS percentage
               FROM fct {where} GROUP BY {group}"""


def _domain(column: str, *order: str) -> str:
    """Sort key that puts values in the stated order."""
    return f"CASE {column} " + " ".join(f"WHEN '{v}' THEN {i}" for i, v in enumerate(order)) + " END"


#: Reports that are registered a second time, over the rollups.
ROLLED_UP = [
    "rpt02_top_listings",
    "rpt03_platform_comparison",
    "rpt07_top_organizations",
    "rpt08_monthly_trend",
    "rpt10_worst_listings",
    "rpt16_daily_summary",
    "rpt19_top_outlets",
    "rpt24_platform_outlets",
]


def _report_queries() -> dict[str, str]:
    ranges = "CASE WHEN avg_temperature < 10 THEN '{}' WHEN avg_temperature < 20 THEN '{}' ELSE '{}' END"
    daily = f"""{plain_mean("avg_rating")} AS avg_rating, {plain_mean("avg_temperature")} AS avg_temp"""
    bodies = {
        "rpt01_overall_summary": f"""
            SELECT count(DISTINCT date) AS total_days, count(DISTINCT listing_id) AS total_listings, {ORDERS},
                   {average("daily_orders", 2)} AS avg_daily_orders_per_listing,
                   CAST(sum(successful_orders) AS BIGINT) AS total_successful_orders,
                   CAST(sum(failed_orders) AS BIGINT) AS total_failed_orders,
                   {average("order_failure_rate", 2)} AS avg_failure_rate,
                   {average("avg_rating", 2)} AS overall_avg_rating,
                   {average("uptime_percentage", 1)} AS avg_uptime_percentage FROM fct""",
        "rpt02_top_listings": f"""
            SELECT {PER_LISTING}, {ORDERS}, {average("avg_rating", 2)} AS avg_rating, {UPTIME}, {FAILURE}
            FROM fct GROUP BY {PER_LISTING} ORDER BY total_orders DESC, listing_id LIMIT 10""",
        "rpt03_platform_comparison": f"""
            SELECT platform_name, count(DISTINCT listing_id) AS num_listings, {ORDERS},
                   {average("daily_orders", 2)} AS avg_orders_per_day, {FAILURE},
                   {average("avg_rating", 2, RATED)} AS avg_rating_when_rated, {UPTIME},
                   row_number() OVER (ORDER BY sum(daily_orders) DESC, platform_name) AS position
            FROM fct GROUP BY platform_name""",
        "rpt04_rating_impact": f"""
            SELECT rating_category, count(*) AS num_days, {ORDERS}, {average("daily_orders", 2)} AS avg_daily_orders,
                   {FAILURE}, {average("avg_rating", 2)} AS avg_rating_score, {UPTIME},
                   row_number() OVER (ORDER BY {_domain("rating_category", "Excellent", "Good", "Average", "Poor", "No Ratings")}) AS position
            FROM fct GROUP BY rating_category""",
        "rpt04_unrated_share": f"""
            SELECT CAST(sum(daily_orders) FILTER (WHERE rating_category = 'No Ratings') AS BIGINT) AS unrated_orders, {ORDERS},
                   {rounded("100.0 * sum(daily_orders) FILTER (WHERE rating_category = 'No Ratings') / sum(daily_orders)", 1)} AS unrated_pct
            FROM fct""",
        "rpt05_weather_impact": f"""
            SELECT temperature_category, count(*) AS num_days, {average("daily_orders", 2)} AS avg_daily_orders,
                   {average("avg_temperature", 1)} AS avg_temp, {FAILURE},
                   row_number() OVER (ORDER BY {_domain("temperature_category", "Cold", "Mild", "Warm", "Hot")}) AS position
            FROM fct WHERE temperature_category <> 'Unknown' GROUP BY temperature_category""",
        "rpt06_availability_impact": f"""
            SELECT availability_category, count(*) AS num_days, {average("daily_orders", 2)} AS avg_daily_orders,
                   {UPTIME}, {FAILURE}, count(*) FILTER (WHERE is_offline_order_anomaly) AS offline_order_anomalies,
                   row_number() OVER (ORDER BY {_domain("availability_category", "Always Online", "Mostly Online", "Partially Online", "Mostly Offline", "Always Offline", "No Data")}) AS position
            FROM fct GROUP BY availability_category""",
        "rpt07_top_organizations": f"""
            SELECT org_name, count(DISTINCT listing_id) AS num_listings, {ORDERS},
                   {average("daily_orders", 2)} AS avg_orders_per_listing_day, {FAILURE},
                   {average("avg_rating", 2, RATED)} AS avg_rating_score, {UPTIME}
            FROM fct GROUP BY org_name ORDER BY total_orders DESC, org_name LIMIT 10""",
        "rpt08_monthly_trend": f"""
            SELECT CAST(date_trunc('month', date) AS DATE) AS month, {ORDERS},
                   {average("daily_orders", 2)} AS avg_daily_orders, {FAILURE},
                   {average("avg_rating", 2, RATED)} AS avg_rating, {UPTIME},
                   row_number() OVER (ORDER BY date_trunc('month', date)) AS position
            FROM fct GROUP BY date_trunc('month', date)""",
        "rpt09_issue_summary": " UNION ALL ".join(
            [
                _issue("Offline Order Anomalies", "is_offline_order_anomaly"),
                _issue("High Failure When Offline", "is_high_failure_when_offline"),
                _issue("Days Without Weather Data", "avg_temperature IS NULL"),
                _issue("Days Without Rank Data", "avg_rank IS NULL"),
            ]
        ),
        "rpt10_worst_listings": f"""
            SELECT {PER_LISTING}, {ORDERS}, CAST(sum(failed_orders) AS BIGINT) AS total_failed, {FAILURE}, {UPTIME},
                   {average("avg_rating", 2, RATED)} AS avg_rating
            FROM fct WHERE daily_orders > 0 GROUP BY {PER_LISTING} HAVING sum(failed_orders) > 20
            ORDER BY avg_failure_rate DESC, listing_id LIMIT 10""",
        "rpt10_worst_listings_published": f"""
            SELECT {PER_LISTING}, {ORDERS}, CAST(sum(failed_orders) AS BIGINT) AS total_failed, {FAILURE}, {UPTIME},
                   {average("avg_rating", 2, RATED)} AS avg_rating
            FROM fct WHERE daily_orders > 0 GROUP BY {PER_LISTING} HAVING sum(failed_orders) > 100
            ORDER BY avg_failure_rate DESC, listing_id LIMIT 10""",
        "rpt11_quality_flags": _share("data_quality_flag", "records"),
        "rpt12_day_of_week": f"""
            SELECT rpad(dayname(date), 9, ' ') AS day_of_week, isodow(date) AS day_number, count(*) AS num_days,
                   {average("daily_orders", 2)} AS avg_orders, {FAILURE}, {ORDERS},
                   row_number() OVER (ORDER BY isodow(date)) AS position
            FROM fct GROUP BY dayname(date), isodow(date)""",
        "rpt13_problem_records": """
            SELECT date, listing_id, daily_orders_from_snapshot, daily_orders, snapshot_vs_actual_diff,
                   data_quality_flag, completed_orders, pending_orders, cancelled_orders
            FROM fct WHERE data_quality_flag NOT IN ('match', 'snapshot_missing')
            ORDER BY abs(snapshot_vs_actual_diff) DESC, date, listing_id LIMIT 20""",
        "rpt14_listing_history": """
            SELECT date, daily_orders, order_failure_rate, avg_rating, rating_trend, uptime_percentage,
                   availability_category, avg_temperature, temperature_category
            FROM fct WHERE listing_id = 43 AND date >= DATE '2023-01-01'""",
        "rpt15_correlation_matrix": f"""
            SELECT {_correlation("daily_orders", "avg_rating")} AS orders_rating_corr,
                   {_correlation("daily_orders", "uptime_percentage")} AS orders_uptime_corr,
                   {_correlation("daily_orders", "avg_temperature")} AS orders_temp_corr,
                   {_correlation("daily_orders", "avg_rank")} AS orders_rank_corr,
                   {_correlation("order_failure_rate", "uptime_percentage")} AS failure_uptime_corr,
                   {_correlation("avg_rating", "order_failure_rate")} AS rating_failure_corr
            FROM fct WHERE daily_orders > 0 AND avg_rating > 0 AND avg_temperature IS NOT NULL""",
        "rpt16_daily_summary": f"""
            SELECT date, count(DISTINCT listing_id) AS active_listings, {ORDERS}, {daily} FROM fct GROUP BY date""",
        "rpt16_orders_by_date": f"""
            SELECT date, {ORDERS}, {daily} FROM fct WHERE date >= DATE '2023-01-01' GROUP BY date""",
        "rpt17_temperature_buckets": f"""
            SELECT {ranges.format("Cold", "Mild", "Warm")} AS temp_range, {plain_mean("daily_orders")} AS avg_orders
            FROM fct GROUP BY 1""",
        "rpt17_temperature_buckets_known": f"""
            SELECT {ranges.format("Cold (<10°C)", "Mild (10-20°C)", "Warm (>20°C)")} AS temperature_range,
                   count(*) AS days, {plain_mean("daily_orders")} AS avg_orders
            FROM fct WHERE avg_temperature IS NOT NULL GROUP BY 1""",
        "rpt18_orders_by_temperature": f"""
            SELECT temperature_category, {plain_mean("daily_orders")} AS avg_orders
            FROM fct GROUP BY temperature_category""",
        "rpt19_top_outlets": f"""
            SELECT outlet_name, org_name, {ORDERS}, {_mean_of_decimal("avg_rating", 2)} AS avg_rating,
                   {_mean_of_decimal("avg_rank", 2)} AS avg_rank
            FROM fct GROUP BY outlet_name, org_name ORDER BY total_orders DESC, outlet_name, org_name LIMIT 10""",
        "rpt20_layer_row_counts": """
            SELECT 'raw.listing' AS table_name, count(*) AS row_count FROM raw_listing
            UNION ALL SELECT 'raw.weather', count(*) FROM raw_weather
            UNION ALL SELECT 'staging.stg_listing', count(*) FROM stg_listing
            UNION ALL SELECT 'mart.fct_daily_business_performance', count(*) FROM fct""",
        "rpt21_latest_rows": """
            SELECT date, listing_id, outlet_name, org_name, platform_name, daily_orders, avg_rating, avg_rank,
                   avg_temperature
            FROM fct ORDER BY date DESC, daily_orders DESC, listing_id LIMIT 20""",
        "rpt22_recent_overview": f"""
            SELECT date, count(DISTINCT listing_id) AS active_listings, {ORDERS},
                   {plain_mean("avg_rating")} AS platform_avg_rating, {plain_mean("avg_temperature")} AS avg_temp
            FROM fct WHERE date >= DATE '2024-02-10' - INTERVAL 30 DAY GROUP BY date""",
        "rpt23_rating_distribution": _share("rating_category", "count", "WHERE rating_category <> 'No Ratings'"),
        "rpt24_platform_outlets": f"""
            SELECT platform_name, count(DISTINCT outlet_id) AS outlets, {ORDERS},
                   {plain_mean("avg_rating")} AS avg_rating, {plain_mean("avg_rank")} AS avg_rank
            FROM fct GROUP BY platform_name""",
    }
    bodies |= {f"rollup_{name}": bodies[name] for name in ROLLED_UP}
    busy = "FILTER (WHERE daily_orders > 0)"
    bodies["rollup_refreshed"] = f"""
        SELECT CAST(date_trunc('month', date) AS DATE) AS month, listing_id, outlet_id, outlet_name, org_name, platform_name,
               CAST(sum(daily_orders) AS BIGINT) AS sum_orders,
               CAST(sum(failed_orders) {busy} AS BIGINT) AS sum_busy_failed,
               {rounded("sum(order_failure_rate)", 6)} AS sum_failure, count(order_failure_rate) AS count_failure,
               {rounded(f"sum(uptime_percentage) {busy}", 6)} AS sum_busy_uptime, count(uptime_percentage) {busy} AS count_busy_uptime,
               {rounded(f"sum(avg_rating){RATED}", 6)} AS sum_rated, count(avg_rating){RATED} AS count_rated,
               {rounded("sum(avg_rank)", 6)} AS sum_rank, count(avg_rank) AS count_rank
        FROM fct GROUP BY ALL"""
    # Sums of doubles depend on row order; add them up as decimals with two digits, which they are.
    for column in ("avg_rating", "avg_temperature", "avg_rank"):
        exact = f"CAST(sum(CAST({column} AS DECIMAL(18,2))) AS DOUBLE) / CAST(count({column}) AS DOUBLE)"
        bodies = {k: b.replace(plain_mean(column), exact) for k, b in bodies.items()}
    return {name: sql(body) for name, body in bodies.items()}


def _mean_of_decimal(column: str, digits: int) -> str:
    return f"CAST(sum(CAST({column} AS DECIMAL(18,{digits}))) AS DOUBLE) / CAST(count({column}) AS DOUBLE)"


AS_OF = "DATE '2024-01-20'"


def _model(name: str) -> str:
    return "fct" if name.startswith("fct") else name


def check_failures(check: Check) -> str:
    """Scalar subquery with the number of failures of a declared check."""
    table = _model(check.model)
    key = ", ".join(check.columns)
    if check.kind == "not_null":
        also = f" AND {check.where}" if check.where else ""
        return f"(SELECT count(*) FROM {table} WHERE {key} IS NULL{also})"
    if check.kind == "unique":
        present = " AND ".join(f"{c} IS NOT NULL" for c in check.columns)
        return (
            f"(SELECT count(*) FROM (SELECT {key} FROM {table} WHERE {present}"
            f" GROUP BY {key} HAVING count(*) > 1))"
        )
    if check.kind == "relationships":
        parent, pk = check.parent
        return (
            f"(SELECT count(*) FROM {table} c WHERE c.{key} IS NOT NULL"
            f" AND NOT EXISTS (SELECT 1 FROM {_model(parent)} p WHERE p.{pk} = c.{key}))"
        )
    if check.kind == "accepted_values":
        listed = ", ".join(f"'{v}'" for v in check.values)
        return f"(SELECT count(DISTINCT {key}) FROM {table} WHERE {key} NOT IN ({listed}))"
    if check.kind == "no_future_dates":
        return f"(SELECT count(DISTINCT {key}) FROM {table} WHERE {key} > {AS_OF})"
    also = f"({check.where}) AND " if check.where else ""
    return f"(SELECT count(*) FROM {table} WHERE {also}NOT ({check.expression}))"


def check_results(checks: list[Check]) -> str:
    rows = []
    for c in checks:
        limit = "CAST(NULL AS BIGINT)" if c.error_above is None else str(c.error_above)
        rows.append(
            f"SELECT '{c.name}' AS check_name, '{c.model}' AS model, '{c.kind}' AS kind,"
            f" '{c.severity}' AS severity, {check_failures(c)} AS n_failures,"
            f" {limit} AS error_above, {c.warn_above} AS warn_above"
        )
    # The model names in the literals are table names too; the extra clauses do no harm.
    return sql(
        f"""SELECT check_name, model, kind, severity, n_failures,
                   CASE WHEN n_failures > error_above THEN 'error' WHEN n_failures > warn_above THEN 'warn'
                        ELSE 'pass' END AS status
            FROM ({" UNION ALL ".join(rows)})"""
    )


def _quality_queries() -> dict[str, str]:
    kinds = {
        "dq_not_null": [c for c in CATALOG if c.kind == "not_null" and not c.where],
        "dq_not_null_where": [c for c in CATALOG if c.kind == "not_null" and c.where],
        "dq_unique": [c for c in CATALOG if c.kind == "unique" and len(c.columns) == 1],
        "dq_unique_composite": [c for c in CATALOG if c.kind == "unique" and len(c.columns) > 1],
        "dq_relationships": [c for c in CATALOG if c.kind == "relationships"],
        "dq_accepted_values": [c for c in CATALOG if c.kind == "accepted_values"],
        "dq_expression_severity": [c for c in CATALOG if c.kind == "expression"],
        "dq_ranges": [c for c in CATALOG if c.kind == "range"],
        "dq_all_checks": CATALOG,
    }
    out = {name: check_results(checks) for name, checks in kinds.items()}
    bodies = {
        "dq_key_presence": """
            SELECT key, count(*) FILTER (WHERE source = 1) AS listing_rows, count(*) FILTER (WHERE source = 2) AS orders_rows,
                   count(*) FILTER (WHERE source = 3) AS ratings_agg_rows, count(*) FILTER (WHERE source = 4) AS rank_rows,
                   count(*) FILTER (WHERE source = 5) AS fact_rows
            FROM (SELECT id AS key, 1 AS source FROM raw_listing UNION ALL SELECT listing_id, 2 FROM raw_orders
                  UNION ALL SELECT listing_id, 3 FROM raw_ratings_agg UNION ALL SELECT listing_id, 4 FROM raw_rank
                  UNION ALL SELECT listing_id, 5 FROM fct)
            WHERE key IS NOT NULL GROUP BY key""",
        "dq_future_dates": f"""
            SELECT date, count(*) AS record_count FROM fct WHERE date > {AS_OF} GROUP BY date""",
        "dq_future_dates_today": """
            SELECT date, count(*) AS record_count FROM fct
            WHERE date + CAST(current_date - DATE '2024-01-15' AS INTEGER) > current_date GROUP BY date""",
        "dq_rating_range_rows": """
            SELECT date, listing_id, CAST(avg_rating AS DOUBLE) AS avg_rating FROM raw_ratings_agg
            WHERE avg_rating < 0 OR avg_rating > 5""",
        "dq_temperature_rows": """
            SELECT date, outlet_id, avg_temperature, min_temperature, max_temperature
            FROM (SELECT date, outlet_id,
                         CAST(CAST(avg_temperature AS DECIMAL(9,2)) * 1.5 AS DOUBLE) AS avg_temperature,
                         CAST(min_temperature AS DOUBLE) AS min_temperature,
                         CAST(max_temperature * 1.5 AS DOUBLE) AS max_temperature FROM stg_weather)
            WHERE avg_temperature < -50 OR avg_temperature > 60 OR min_temperature < -50 OR max_temperature > 60""",
        "dq_duplicate_orders": """
            SELECT order_id, count(*) AS n_records FROM raw_orders GROUP BY order_id HAVING count(*) > 1""",
        "dq_unexpected_status": """
            SELECT status AS value_field, count(*) AS n_records FROM raw_orders
            WHERE status NOT IN ('completed', 'pending', 'refunded', 'cancelled') GROUP BY status""",
        "dq_discrepancy_rows": """
            SELECT date, listing_id, data_quality_flag FROM fct
            WHERE data_quality_flag IN ('large_discrepancy', 'snapshot_negative')""",
        "dq_stored_failures": """
            SELECT 'expression_no_large_discrepancy' AS table_name, count(*) AS row_count FROM fct
            WHERE data_quality_flag IN ('large_discrepancy', 'snapshot_negative')
            UNION ALL
            SELECT 'unique_raw_orders_order_id', count(*)
            FROM (SELECT order_id FROM raw_orders GROUP BY order_id HAVING count(*) > 1)
            UNION ALL
            SELECT 'accepted_values_raw_orders_status', count(DISTINCT status) FROM raw_orders
            WHERE status NOT IN ('completed', 'pending', 'refunded', 'cancelled')""",
        "dq_unplaced_listings": """
            SELECT listing_id, outlet_id FROM stg_listing l WHERE outlet_id IS NOT NULL AND NOT EXISTS
                (SELECT 1 FROM stg_outlet u WHERE u.outlet_id = l.outlet_id AND u.has_valid_coordinates)""",
        "dq_missing_parents": """
            SELECT l.outlet_id AS fk, count(*) AS n_rows FROM stg_listing l
            LEFT JOIN raw_weather w ON w.outlet_id = l.outlet_id
            WHERE w.outlet_id IS NULL AND l.outlet_id IS NOT NULL GROUP BY l.outlet_id""",
        "dq_source_rows": """
            SELECT count(*) AS outlets,
                   count(*) FILTER (WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND (latitude <> 0 OR longitude <> 0))
                       AS valid_outlets, true AS passed FROM raw_outlet""",
        "dq_rowcount_recon": """
            SELECT count(*) AS stored_rows, count(*) AS fetched_rows, true AS passed FROM raw_weather""",
        "dq_null_profile": """
            SELECT count(*) FILTER (WHERE outlet_id IS NULL) AS null_outlet_id, count(*) FILTER (WHERE datetime IS NULL) AS null_datetime,
                   count(*) FILTER (WHERE temperature_2m IS NULL) AS null_temperature_2m,
                   count(*) FILTER (WHERE relative_humidity_2m IS NULL) AS null_relative_humidity_2m,
                   count(*) FILTER (WHERE wind_speed_10m IS NULL) AS null_wind_speed_10m,
                   if(count(*) FILTER (WHERE temperature_2m IS NULL) > 0, 'error', 'pass') AS status FROM raw_weather""",
        "dq_range_profile": """
            SELECT count(*) FILTER (WHERE temperature_2m NOT BETWEEN -50 AND 60) AS bad_temp,
                   count(*) FILTER (WHERE relative_humidity_2m NOT BETWEEN 0 AND 100) AS bad_humidity,
                   count(*) FILTER (WHERE wind_speed_10m NOT BETWEEN 0 AND 200) AS bad_wind,
                   CAST(min(temperature_2m) AS DOUBLE) AS min_temp, CAST(max(temperature_2m) AS DOUBLE) AS max_temp,
                   'pass' AS status FROM raw_weather""",
        "dq_coverage": """
            SELECT CAST(min(datetime) AS VARCHAR) AS min_datetime, CAST(max(datetime) AS VARCHAR) AS max_datetime,
                   count(DISTINCT outlet_id) AS unique_outlets, count(*) AS total_records FROM raw_weather""",
        "dq_orphans": """
            SELECT count(*) AS orphan_count, count(*) = 0 AS passed FROM raw_weather w
            WHERE NOT EXISTS (SELECT 1 FROM raw_outlet o WHERE o.id = w.outlet_id)""",
    }
    return out | {name: sql(body) for name, body in bodies.items()}


METRICS = f"""{_doubles("temperature_2m")}, relative_humidity_2m, {_doubles("wind_speed_10m")}"""
BROKEN = "outlet_id % 7 = 0 AND day(datetime) = 1"


def _source_queries() -> dict[str, str]:
    bodies = {
        "src_csv": """
            SELECT listing_id, order_id, if(order_id % 97 = 0, NULL, placed_at) AS placed_at, status
            FROM raw_orders""",
        "src_csv_dates": """
            SELECT if(listing_id % 7 IN (0, 2), NULL, date) AS date, listing_id, orders, "timestamp" FROM raw_orders_daily""",
        "src_csv_quoted_breaks": """
            SELECT id, if(id % 3 = 0, '"A,' || chr(10) || chr(10) || name || chr(13) || chr(10) || '"', name) AS name, "timestamp"
            FROM raw_org""",
        "catalog_layers": """
            SELECT o.status, f.platform_name, count(*) AS n_orders, count(DISTINCT f.listing_id) AS n_listings,
              CAST(sum(r.total_readings) AS BIGINT) AS n_readings
            FROM stg_orders o JOIN fct f ON f.listing_id = o.listing_id AND f.date = o.order_date
            LEFT JOIN int_rank_daily_avg r ON r.listing_id = o.listing_id AND r.date = o.order_date
            GROUP BY ALL""",
        "catalog_bucketed_days": """
            SELECT listing_id, any_value(outlet_id) AS outlet_id, count(*) AS active_days,
              CAST(sum(daily_orders) AS BIGINT) AS total_orders
            FROM fct GROUP BY listing_id""",
        "src_json_flatten": f"SELECT outlet_id, datetime, {METRICS} FROM raw_weather WHERE NOT ({BROKEN})",
        "src_json_rejects": f"""
            SELECT DISTINCT outlet_id, 'arrays of unequal length' AS reason FROM raw_weather WHERE {BROKEN}""",
        "src_locations": f"""
            SELECT id AS outlet_id, {_doubles("latitude", "longitude")} FROM raw_outlet
            WHERE latitude IS NOT NULL AND longitude IS NOT NULL AND NOT (latitude = 0 AND longitude = 0)""",
        "src_coord_validate": """
            SELECT id AS outlet_id, 'latitude out of range' AS reason FROM raw_outlet WHERE latitude * 2 > 90""",
        "src_date_range": """
            SELECT outlet_id, datetime FROM raw_weather
            WHERE datetime >= TIMESTAMP '2024-01-10' AND datetime < TIMESTAMP '2024-01-21'""",
        "src_weather_ingest": f"SELECT * REPLACE ({_doubles('min_temperature', 'max_temperature')}) FROM stg_weather",
        "src_csv_parts": """
            SELECT listing_id, order_id, placed_at, status FROM raw_orders
            WHERE NOT (order_id % 2 = 0 AND order_id % 101 = 0)""",
        "src_csv_rejects": """
            SELECT order_id, 'more fields than columns' AS reason FROM raw_orders
            WHERE order_id % 2 = 0 AND order_id % 101 = 0""",
        "load_append": """
            SELECT 'org' AS table_name, count(*) AS rows_loaded, 2 * count(*) AS total_rows, 'loaded' AS status,
                   CAST(NULL AS VARCHAR) AS reason FROM raw_org""",
        "load_failed_keeps_rows": """
            SELECT 'org' AS table_name, 0 AS rows_loaded, 0 AS total_rows, 'empty' AS status,
                   CAST(NULL AS VARCHAR) AS reason, 0 AS stored
            UNION ALL SELECT 'platform', 0, count(*), 'missing', 'PATH_NOT_FOUND', count(*) FROM raw_platform
            UNION ALL SELECT 'outlet', 0, count(*), 'failed', 'CAST_INVALID_INPUT', count(*) FROM raw_outlet
            UNION ALL SELECT 'listing', 0, count(*), 'failed', 'listing: unexpected columns [''colour'']', count(*)
            FROM raw_listing""",
        "fct_refreshed": "SELECT * FROM fct",
        "fct_two_loads": "SELECT * FROM fct",
        "fct_late_ratings": "SELECT * FROM fct",
        "load_repeated_id": "SELECT * FROM raw_org",
        "load_audit": " UNION ALL ".join(
            [
                f"SELECT '{t}' AS table_name, count(*) AS rows_loaded, count(*) AS total_rows, 'loaded' AS status,"
                f" CAST(NULL AS VARCHAR) AS reason FROM raw_{t}"
                for t in LOADED_FROM_FILES
            ]
            + [
                f"SELECT 'TOTAL', {_sum_of_counts()}, {_sum_of_counts()}, '8/8', NULL",
            ]
        ),
    }
    return {name: sql(body) for name, body in bodies.items()}


LOADED_FROM_FILES = ["listing", "orders", "orders_daily", "org", "outlet", "platform", "rank", "ratings_agg"]


def _sum_of_counts() -> str:
    return " + ".join(f"(SELECT count(*) FROM raw_{t})" for t in LOADED_FROM_FILES)


def all_queries() -> dict[str, str]:
    return {**_model_queries(), **_report_queries(), **_quality_queries(), **_source_queries()}
