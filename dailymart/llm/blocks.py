"""Comparing within buckets of any size: blocks of bounded size, pair by pair."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_KEYS = ["bucket", "one", "other"]


def in_blocks(members: DataFrame, key: str, most: int) -> DataFrame:
    """Members (``bucket, size`` and a key) dealt to ``block`` of about ``most``, and to pairs of blocks ``one, other``."""
    blocks = F.ceil(F.col("size") / most).cast("int")
    dealt = members.withColumns({"blocks": blocks, "block": F.pmod(F.xxhash64(key), blocks).cast("int")})
    with_each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    return dealt.withColumn("with", with_each).withColumns(
        {"one": F.least("block", "with"), "other": F.greatest("block", "with")}
    )


def sorted_blocks(df: DataFrame) -> DataFrame:
    """Rows of a pair of blocks together, in runs."""
    return df.repartition(*BLOCK_KEYS).sortWithinPartitions(*BLOCK_KEYS)


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """Runs of equal keys in sorted rows, one batch for each run."""
    open_: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(k).to_numpy(zero_copy_only=False) for k in keys], axis=1)
        cuts = [0, *(np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            key = columns[start].tobytes()
            if open_ and key != last:
                yield pa.Table.from_batches(open_).combine_chunks().to_batches()[0]
                open_ = []
            open_.append(batch.slice(start, stop - start))
            last = key
    if open_:
        yield pa.Table.from_batches(open_).combine_chunks().to_batches()[0]
