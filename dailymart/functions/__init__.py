from dailymart.functions.exprs import (
    avg_where,
    clamp,
    count_where,
    domain_order,
    exact_avg,
    exact_ratio,
    mean,
    mean_ratio,
    month_of,
    pct,
    safe_corr,
    text_key,
    weekday_label,
)

__all__ = [
    "avg_where",
    "clamp",
    "count_where",
    "domain_order",
    "exact_avg",
    "exact_ratio",
    "mean",
    "mean_ratio",
    "month_of",
    "pct",
    "safe_corr",
    "text_key",
    "weekday_label",
]
