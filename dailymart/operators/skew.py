"""Equi-joins that stay balanced when one key holds a large part of the left side.

A key is hot if it has more than its fair share of the left rows: more than one in as many rows as there
are shuffle partitions. At most that many keys can be hot, whatever the data. They are spread over as many salts
as fair shares they fill, and the matching right rows are copied once per salt. Other keys keep a single salt.

A single join may count its keys inside its own plan; building that runs no job. Where several joins share keys,
:class:`HotKeys` counts all keys of a table in one narrow job when first asked, and keeps the few rows: the joins' plans then hold
no counting at all, and a join without hot keys is a plain one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from threading import RLock

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def fair_shares(rows: DataFrame) -> int:
    """Parts that a shuffle deals rows to."""
    return int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def hot_keys(rows: DataFrame, key: str, shares: int | None = None) -> DataFrame:
    """Keys with more than one in ``shares`` of the rows, and the salts each needs (``_salts``).

    The total is a scalar subquery over the counts. NULL is no key here, see :func:`salted_join`.
    """
    shares = shares or fair_shares(rows)
    counted = rows.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("_n"))
    total = counted.agg(F.sum("_n")).scalar()
    hot = counted.where(F.col("_n") * shares > total)
    return hot.select(key, F.ceil(F.col("_n") * shares / total).cast("bigint").alias("_salts"))


@dataclass(frozen=True)
class Hot:
    """Hot values of one key with the salts each needs (a table of at most as many rows as there are shares)."""

    salts: DataFrame | None = None
    nulls: bool = False


@dataclass
class HotKeys:
    """Hot keys of some tables: ``tables`` are rows by name, ``keys`` the columns to count in each.

    The keys of a table are counted together, in one pass over those columns alone (map-side combine, and only the
    largest counts reach the driver: at most one for each share and key). The outcome is kept, as too many or too few
    salts never change a result; :meth:`forget` makes the next caller count again.
    """

    tables: Mapping[str, DataFrame]
    keys: Mapping[str, Sequence[str]]
    _found: dict[str, dict[str, Hot]] = field(default_factory=dict)
    _lock: RLock = field(default_factory=RLock)

    def of(self, table: str, key: str) -> Hot:
        with self._lock:
            if table not in self._found:
                self._found[table] = self._count(self.tables[table], self.keys[table])
            return self._found[table][key]

    def forget(self) -> None:
        with self._lock:
            self._found.clear()

    def _count(self, rows: DataFrame, keys: Sequence[str]) -> dict[str, Hot]:
        shares = fair_shares(rows)
        named = [F.struct(F.lit(k).alias("key"), F.col(k).cast("string").alias("value")) for k in keys]
        every = F.struct(F.lit(None).cast("string").alias("key"), F.lit(None).cast("string").alias("value"))
        counted = rows.select(F.explode(F.array(every, *named)).alias("at")).groupBy("at").agg(F.count("*").alias("n"))
        # Hot keys are among these: of each key at most ``shares`` values are in more than one in ``shares`` rows.
        largest = counted.select("at.*", "n").orderBy(F.desc("n")).limit(len(keys) * shares + 1).collect()
        total = max((r.n for r in largest if r.key is None), default=0)
        kinds = dict(rows.select(*keys).dtypes)
        found = {}
        for key in keys:
            hot = [(r.value, -(-r.n * shares // total)) for r in largest if r.key == key and r.n * shares > total]
            values = [h for h in hot if h[0] is not None]
            table = _salts(rows.sparkSession, key, kinds[key], values) if values else None
            found[key] = Hot(table, len(values) < len(hot))
        return found


def _salts(spark: SparkSession, key: str, kind: str, values: Sequence[tuple[str, int]]) -> DataFrame:
    """Hot values with their salts, as rows inside the plan."""
    columns = [pa.array([v for v, _ in values], pa.string()), pa.array([n for _, n in values], pa.int64())]
    table = spark.createDataFrame(pa.table(columns, [key, "_salts"]))
    return table.select(F.col(key).cast(kind).alias(key), "_salts")


def salted_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    how: str,
    spread: Sequence[str],
    hot_from: DataFrame | Hot | None = None,
    shares: int | None = None,
    hint: str | None = None,
) -> DataFrame:
    """Join on ``on`` (inner, left, left_semi or left_anti) with the hot values of ``on[0]`` spread over salts.

    Hot values are counted in ``hot_from``, by default ``left``; any rows with about the same distribution
    that are cheaper to count will do, as too many or too few salts do not change the result. They may also be
    given, found by :class:`HotKeys` before. ``spread`` are
    left columns that differ between the rows of one key (ids); hashing them keeps the salt repeatable when
    a lost task is run again. Rows with a NULL key match nothing: inner and semi joins leave them out
    first, the others deal them to all partitions. ``hint`` is Spark's join hint for the right side, where its
    size is hard to foresee.
    """
    hinted = lambda rows: rows.hint(hint) if hint else rows
    columns = list(left.columns)
    if how not in ("left_semi", "left_anti"):
        columns += [c for c in right.columns if c not in on]
    key = on[0]
    shares = shares or fair_shares(left)
    if how in ("inner", "left_semi"):
        left = left.where(F.col(key).isNotNull())
    if isinstance(hot_from, Hot):
        hot = hot_from.salts
        if hot is None and (how in ("inner", "left_semi") or not hot_from.nulls):
            return left.join(hinted(right), list(on), how).select(*columns)
        if hot is None:
            hot = _salts(left.sparkSession, key, dict(right.dtypes)[key], [])
    else:
        hot = hot_keys(left if hot_from is None else hot_from, key, shares)
    salts = F.coalesce(F.col("_salts"), F.lit(1).cast("bigint"))
    dealt = F.when(F.col(key).isNull(), F.lit(shares).cast("bigint")).otherwise(salts)
    salt = F.pmod(F.xxhash64(*spread), dealt)
    # At most ``shares`` rows, by the definition of hot.
    salted_left = left.join(F.broadcast(hot), key, "left").withColumn("_salt", salt).drop("_salts")
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), salts - 1))
    salted_right = right.join(F.broadcast(hot), key, "left").withColumn("_salt", copies).drop("_salts")
    return salted_left.join(hinted(salted_right), [*on, "_salt"], how).select(*columns)
