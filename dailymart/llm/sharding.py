"""Shards of bounded size by extendible hashing.

A row's address is a string of bits: 60 of the MD5 hash of its key, then 60 of a hash of its place in the
table, which only rows of equal keys ever need. The directory is indexed by prefixes of addresses. It starts
with one bucket of no bits; a bucket over the byte limit splits on its next bit, and only such a bucket.

Several bits are decided at once: bytes are summed by the next ``STEP`` bits with partial aggregation, summed
up along all shorter prefixes, and the shortest prefix that fits becomes a shard. Only rows below buckets
that are still too large take part in the next step, so a step moves sums, never rows.

Defined cases: a single row over the limit is a shard of its own (``oversized``). Null and empty texts have
no bytes. Rows with the same key, null included, lie in the same bucket until it is too large, then are
spread by their place. Other columns play no part. An empty table has no shards.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailymart.llm.store import saved

BITS = 60
STEP = 10


def key_bits(key: Column) -> Column:
    """The first 60 bits of the MD5 hash of a key as text, as a string of 0 and 1."""
    digest = F.substring(F.md5(F.encode(F.coalesce(key.cast("string"), F.lit("")), "UTF-8")), 1, BITS // 4)
    return F.lpad(F.bin(F.conv(digest, 16, 10).cast("long")), BITS, "0")


def _buckets(rows: DataFrame, base: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(cell, depth) of the shards among the next bits of ``rows``, and the cells that are still too large.

    ``cell``: the first ``base + STEP`` bits. All rows lie below buckets of ``base`` bits that must split
    (or, at the start, below the first bucket of all).
    """
    cells = rows.groupBy(F.substring("address", 1, base + STEP).alias("cell")).agg(
        F.sum("n_bytes").alias("bytes"), F.count("*").alias("rows")
    )
    cells = saved(cells, "cells")
    depths = F.explode(F.sequence(F.lit(base + 1 if base else 0), F.lit(base + STEP))).alias("depth")
    prefixes = cells.select("*", depths).withColumn("prefix", F.expr("substring(cell, 1, depth)"))
    sums = prefixes.groupBy("depth", "prefix").agg(F.sum("bytes").alias("bytes"), F.sum("rows").alias("rows"))
    fits = sums.where((F.col("bytes") <= limit) | (F.col("rows") == 1)).select("depth", "prefix")
    last = base + STEP == 2 * BITS
    found = prefixes.select("cell", "depth", "prefix").join(fits, ["depth", "prefix"], "left_semi")
    found = found.groupBy("cell").agg(F.min("depth").alias("depth"))
    both = saved(cells.select("cell").join(found, "cell", "left"), "depths")
    if last:  # equal places do not occur; the bits are used up all the same
        return both.select("cell", F.coalesce("depth", F.lit(2 * BITS)).alias("depth")), both.limit(0)
    return both.where("depth IS NOT NULL"), both.where("depth IS NULL").select("cell")


def sharded(rows: DataFrame, key: str, n_bytes: Column, limit: int) -> DataFrame:
    """``rows`` with ``n_bytes, shard, depth, shard_bytes, shard_rows, oversized``.

    ``shard`` is the prefix of ``depth`` bits that all addresses in the shard share (none: a single shard).
    """
    names = rows.columns
    place = F.lpad(F.bin(F.shiftrightunsigned(F.xxhash64(F.monotonically_increasing_id()), 64 - BITS)), BITS, "0")
    held = rows.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"), n_bytes.cast("long").alias("n_bytes"), key_bits(F.col(f"`{key}`")).alias("bits"), place.alias("place"))
    left = saved(held.withColumn("address", F.concat("bits", "place")).drop("bits", "place"), "addresses")
    done = []
    for base in range(0, 2 * BITS, STEP):
        depths, large = _buckets(left.select("address", "n_bytes"), base, limit)
        cell = F.substring("address", 1, base + STEP)
        done.append(left.withColumn("cell", cell).join(depths, "cell").drop("cell"))
        if large.isEmpty():
            break
        left = left.withColumn("cell", cell).join(large, "cell", "left_semi").drop("cell")
    placed = reduce(DataFrame.union, done).withColumn("shard", F.expr("substring(address, 1, depth)"))
    totals = placed.groupBy("shard").agg(F.sum("n_bytes").alias("shard_bytes"), F.count("*").alias("shard_rows"))
    found = placed.join(totals, "shard").withColumn("oversized", F.col("shard_bytes") > limit)
    new = ["n_bytes", "shard", "depth", "shard_bytes", "shard_rows", "oversized"]
    return found.select(*[F.col(f"row.`{c}`") for c in names if c not in new], *new)


def shards(docs: DataFrame, limit: int) -> DataFrame:
    """``doc_id, n_bytes, shard, depth, shard_bytes, shard_rows, oversized`` of every document."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).alias("n_bytes")
    rows = docs.select("doc_id", size.alias("size"))
    return sharded(rows, "doc_id", F.col("size"), limit).drop("size")


def directory(placed: DataFrame) -> DataFrame:
    """``shard, depth, shard_bytes, shard_rows``: the entries of the directory, one for each shard."""
    return placed.select("shard", "depth", "shard_bytes", "shard_rows").distinct()


def write(docs: DataFrame, limit: int, path: str) -> None:
    """All columns of ``docs`` as Parquet, a folder for each shard."""
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    placed = sharded(docs, "doc_id", size, limit).drop("n_bytes", "depth", "shard_bytes", "shard_rows", "oversized")
    folder = F.concat(F.lit("b"), F.col("shard"))
    placed.withColumn("shard", folder).repartition("shard").write.partitionBy("shard").parquet(path)


def sql(limit: int) -> str:
    """The same rows as ``shards`` for documents of distinct ids, splitting level by level."""
    return f"""
WITH sized AS (
  SELECT doc_id, COALESCE(octet_length(encode(text)), 0)::BIGINT AS n_bytes,
         lpad(bin(('0x' || substr(md5(COALESCE(doc_id::VARCHAR, '')), 1, {BITS // 4}))::BIGINT), {BITS}, '0') AS address
  FROM documents),
prefixes AS (
  SELECT d.depth::INTEGER AS depth, substr(address, 1, d.depth::BIGINT) AS shard, SUM(n_bytes)::BIGINT AS shard_bytes, COUNT(*) AS shard_rows
  FROM sized, range(0, 40) AS d(depth) GROUP BY ALL),
fitting AS (SELECT * FROM prefixes WHERE shard_bytes <= {limit} OR shard_rows = 1),
leaves AS (
  SELECT f.* FROM fitting f WHERE f.depth = 0 OR NOT EXISTS (
    SELECT 1 FROM fitting p WHERE p.depth = f.depth - 1 AND p.shard = substr(f.shard, 1, f.depth - 1)))
SELECT s.doc_id, s.n_bytes, l.shard, l.depth, l.shard_bytes, l.shard_rows, l.shard_bytes > {limit} AS oversized
FROM sized s JOIN leaves l ON substr(s.address, 1, l.depth) = l.shard"""
