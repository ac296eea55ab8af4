"""Shares of a total, top-k and previous-record columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dailymart.functions.exprs import pct


def share_of_total(df: DataFrame, group: str, digits: int, count_as: str, share_as: str) -> DataFrame:
    """Rows per group and their percentage of all rows.

    The total is a scalar subquery over the grouped counts, so no window gathers all groups in one task.
    """
    counted = df.groupBy(group).agg(F.count("*").alias(count_as))
    total = counted.agg(F.sum(count_as)).scalar()
    return counted.withColumn(share_as, pct(F.col(count_as), total, digits))


def top_k(df: DataFrame, order: Sequence[Column], k: int, tiebreak: Sequence[str]) -> DataFrame:
    """First ``k`` rows by ``order``; the grouping keys in ``tiebreak`` make the order total."""
    ties = [F.col(c).asc_nulls_last() for c in tiebreak]
    return df.orderBy(*order, *ties).limit(k)


def prev_by(df: DataFrame, keys: Sequence[str], order: str, columns: dict[str, str]) -> DataFrame:
    """Add each column's value in the previous record of the same key: ``{new_name: column}``.

    One window serves all columns. Meant for input with one row per key and date: a key's rows are then
    bounded by the calendar, however large the key.
    """
    window = Window.partitionBy(*keys).orderBy(F.col(order).asc_nulls_last())
    return df.withColumns({name: F.lag(column).over(window) for name, column in columns.items()})
