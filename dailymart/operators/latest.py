"""Latest-wins deduplication."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], latest_by: Sequence[str]) -> DataFrame:
    """Keep one row per key: the one that sorts first by ``latest_by`` descending, NULLs first.

    Remaining columns break ties, so the result does not depend on row order. Spark turns the
    row_number filter into a group limit that runs before the shuffle as well: each map task sends at
    most one row per key, so a key that holds a third of all rows cannot overload one task.
    """
    rest = [c for c in df.columns if c not in keys and c not in latest_by]
    order = [F.col(f"`{c}`").desc_nulls_first() for c in [*latest_by, *rest]]
    place = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")
