"""Foreign-key checks as anti joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def orphan_keys(child: DataFrame, fk: str, parent: DataFrame, pk: str, null_is_orphan: bool = False) -> DataFrame:
    """Absent key values with their number of child rows.

    The child is counted per key first (map-side combine), so only distinct keys are joined.
    """
    rows = child if null_is_orphan else child.where(F.col(fk).isNotNull())
    counted = rows.groupBy(F.col(fk).alias("fk")).agg(F.count("*").alias("n_rows"))
    known = parent.select(F.col(pk).alias("fk")).where(F.col("fk").isNotNull()).distinct()
    return counted.join(known, "fk", "left_anti")


def orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, null_is_orphan: bool = False) -> DataFrame:
    """Child rows whose ``fk`` is absent from ``parent.pk``; NULL keys count only when asked to.

    Each absent key is found once and then taken back to its rows. Those of one key all match the same row, so
    the join may be split anywhere, which adaptive execution does for a key in very many of them.
    """
    absent = orphan_keys(child, fk, parent, pk).select(F.col("fk").alias(fk))
    found = child.join(absent, fk, "left_semi").select(*child.columns)
    return found.unionByName(child.where(F.col(fk).isNull())) if null_is_orphan else found
