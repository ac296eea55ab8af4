"""The 77 declared checks of the layered model."""

from __future__ import annotations

from dailymart.functions import rules
from dailymart.plans.mart import FACT
from dailymart.quality.checks import Check

# Columns that must be present, by model ("raw_" names a raw table).
NOT_NULL = {
    "raw_listing": "id",
    "stg_listing": "listing_id outlet_id platform_id",
    "stg_orders": "order_id listing_id order_date",
    "stg_orders_daily": "date listing_id daily_orders",
    "stg_outlet": "outlet_id org_id has_valid_coordinates",
    "stg_org": "org_id org_name",
    "stg_platform": "platform_id platform_name",
    "stg_rank": "listing_id date",
    "stg_ratings_agg": "date listing_id avg_rating",
    "stg_weather": "outlet_id date avg_temperature avg_humidity avg_wind_speed",
    "int_orders_enriched": "order_id listing_id outlet_id org_id platform_id",
    "int_ratings_metrics": "date listing_id cumulative_rating_count",
    "int_rank_daily_avg": "date listing_id avg_rank",
    FACT: "date listing_id outlet_id org_id platform_id daily_orders",
}

# Unique keys; more than one column is a composite key.
UNIQUE = {
    "stg_listing": "listing_id",
    "stg_orders": "order_id",
    "stg_outlet": "outlet_id",
    "stg_org": "org_id",
    "stg_platform": "platform_id",
    "int_orders_enriched": "order_id",
    "stg_orders_daily": "date listing_id",
    "stg_ratings_agg": "date listing_id",
    "stg_weather": "date outlet_id",
    "int_ratings_metrics": "date listing_id",
    "int_rank_daily_avg": "date listing_id",
    FACT: "date listing_id",
}

# Fixed values: (child model, column, parent model); the parent key has the same name.
RELATIONSHIPS = [
    ("stg_listing", "outlet_id", "stg_outlet"),
    ("stg_listing", "platform_id", "stg_platform"),
    ("stg_orders", "listing_id", "stg_listing"),
    ("stg_orders_daily", "listing_id", "stg_listing"),
    ("stg_outlet", "org_id", "stg_org"),
    ("stg_rank", "listing_id", "stg_listing"),
    ("stg_ratings_agg", "listing_id", "stg_listing"),
    ("stg_weather", "outlet_id", "stg_outlet"),
]

TRENDS_IN_MART = [*rules.RATING_TRENDS, "No Ratings"]
WARN_ONLY = None


def _not_null() -> list[Check]:
    plain = [Check(model, "not_null", (c,)) for model, columns in NOT_NULL.items() for c in columns.split()]
    # A rank is only expected while the listing is online.
    return [*plain, Check("stg_rank", "not_null", ("rank",), where="is_online")]


def _accepted_values() -> list[Check]:
    def accepted(model: str, column: str, values: list[str], error_above: int | None = 0) -> Check:
        return Check(model, "accepted_values", (column,), values=tuple(values), error_above=error_above)

    return [
        accepted("stg_orders", "status", rules.ORDER_STATUSES),
        accepted("stg_platform", "platform_group", rules.PLATFORM_GROUPS),
        accepted("int_ratings_metrics", "rating_trend", rules.RATING_TRENDS),
        accepted(FACT, "data_quality_flag", rules.QUALITY_FLAGS, WARN_ONLY),
        accepted(FACT, "rating_trend", TRENDS_IN_MART, WARN_ONLY),
        accepted(FACT, "rating_category", rules.RATING_CATEGORIES),
        accepted(FACT, "temperature_category", rules.TEMPERATURE_CATEGORIES),
    ]


EXPRESSIONS = [
    Check(
        FACT,
        "expression",
        expression="completed_orders <= daily_orders",
        label="expression_completed_within_daily_orders",
    ),
    # Warns on any failure. The published limit of 100 is taken as intended: more than 100 is an error.
    Check(
        FACT,
        "expression",
        expression="data_quality_flag not in ('large_discrepancy', 'snapshot_negative')",
        error_above=100,
        label="expression_no_large_discrepancy",
    ),
]

FUTURE_DATES = Check(FACT, "no_future_dates", ("date",), label="no_future_dates")
RATING_RANGE = Check(FACT, "range", expression="avg_rating between 0 and 5", label="rating_range")
TEMPERATURE_RANGE = Check(
    FACT,
    "range",
    where="avg_temperature is not null",
    expression="avg_temperature between -50 and 60 and min_temperature >= -50 and max_temperature <= 60",
    label="temperature_reasonable",
)

UNIQUE_CHECKS = [Check(model, "unique", tuple(columns.split())) for model, columns in UNIQUE.items()]
RELATIONSHIP_CHECKS = [
    Check(child, "relationships", (column,), parent=(parent, column)) for child, column, parent in RELATIONSHIPS
]

CATALOG: list[Check] = [
    *_not_null(),
    *UNIQUE_CHECKS,
    *RELATIONSHIP_CHECKS,
    *_accepted_values(),
    *EXPRESSIONS,
    FUTURE_DATES,
    RATING_RANGE,
    TEMPERATURE_RANGE,
]
