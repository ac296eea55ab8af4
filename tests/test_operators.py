"""Deduplication, skew-safe joins, references, shares and previous records."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from dailymart.operators import (
    HotKeys,
    hot_keys,
    latest_per_key,
    orphan_keys,
    orphans,
    prev_by,
    salted_join,
    share_of_total,
    top_k,
)


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_latest_prefers_null_time_then_breaks_ties(spark):
    df = spark.sql(
        """select * from values
           (1, timestamp_ntz'2024-01-02', 'dated'), (1, null, 'undated'),
           (2, timestamp_ntz'2024-01-02', 'a'), (2, timestamp_ntz'2024-01-02', 'b'),
           (3, timestamp_ntz'2024-01-01', 'old'), (3, timestamp_ntz'2024-01-02', 'new') as t(id, at, name)"""
    )
    for parts in (1, 5):
        latest = latest_per_key(df.repartition(parts), ["id"], ["at"])
        assert rows(latest.select("id", "name")) == [(1, "undated"), (2, "b"), (3, "new")]


def test_latest_limits_groups_before_the_shuffle(spark, plan_of):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), "id")
    plan = plan_of(latest_per_key(df, ["k"], ["id"]))
    assert plan.count("WindowGroupLimit") >= 2


@pytest.fixture
def sides(spark):
    # Key 0 holds two thirds of the left rows, some keys are NULL, key 7 has no match.
    left = spark.range(600).select(
        F.when(F.col("id") % 3 != 0, 0).when(F.col("id") % 50 != 0, F.col("id") % 9).alias("k"), "id"
    )
    right = spark.createDataFrame([(0, "zero"), (3, "three"), (3, "again"), (6, "six"), (None, "x")], "k long, name string")
    return left, right


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
@pytest.mark.parametrize("shares", [1, 60, None])
def test_salted_join_equals_plain_join(sides, how, shares):
    left, right = sides
    salted = salted_join(left, right, ["k"], how, spread=["id"], shares=shares)
    plain = left.join(right, "k", how).select(*salted.columns)
    assert rows(salted) == rows(plain)


def test_hot_keys_fill_more_than_a_fair_share(sides):
    left, _ = sides
    counts = {r.k: r["count"] for r in left.where("k is not null").groupBy("k").count().collect()}
    total = sum(counts.values())
    for shares in (1, 2, 20, 100):
        want = [(k, -(-n * shares // total)) for k, n in counts.items() if n * shares > total]
        assert rows(hot_keys(left, "k", shares)) == sorted(want, key=str)
        assert len(want) <= shares


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_join_with_keys_counted_before(spark, sides, how, plan_of):
    left, right = sides
    for rows_, salted in ((left, True), (left.where("k is null"), how.startswith("left") and how != "left_semi"), (left.select("id", F.col("id").alias("k")), False)):
        hot = HotKeys({"t": rows_}, {"t": ["k"]}).of("t", "k")
        joined = salted_join(rows_, right, ["k"], how, spread=["id"], hot_from=hot)
        assert rows(joined) == rows(rows_.join(right, "k", how).select(*joined.columns))
        assert ("_salt" in plan_of(joined)) == salted


def test_shared_hot_keys_are_counted_in_one_job(spark, sides):
    left, _ = sides
    keys = HotKeys({"t": left.withColumn("name", F.lit("x"))}, {"t": ["k", "id", "name"]})
    shares = int(spark.conf.get("spark.sql.shuffle.partitions"))
    counts = {r.k: r["count"] for r in left.groupBy("k").count().collect()}
    want = sorted((k, -(-n * shares // 600)) for k, n in counts.items() if k is not None and n * shares > 600)
    assert rows(keys.of("t", "k").salts) == want and keys.of("t", "k").nulls == (counts[None] * shares > 600)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("again", "keys that are known")
    try:
        assert keys.of("t", "id").salts is None
        name = keys.of("t", "name").salts
        assert not tracker.getJobIdsForGroup("again")
        assert [tuple(r) for r in name.collect()] == [("x", shares)]
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    nothing = HotKeys({"t": left.limit(0)}, {"t": ["k"]}).of("t", "k")
    assert nothing.salts is None and not nothing.nulls


def test_salted_join_deals_hot_and_null_keys(spark, sides):
    """No partition of the join holds much more than its share, though one key and NULL hold most rows."""
    left = spark.range(4000).select(F.when(F.col("id") % 2 == 0, F.lit(0)).when(F.col("id") % 4 == 1, F.col("id")).alias("k"), "id")
    right = spark.range(4000).select(F.col("id").alias("k"), F.lit("x").alias("name"))
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled", "spark.sql.shuffle.partitions")}
    try:
        for key, value in zip(before, ("-1", "false", "16")):
            spark.conf.set(key, value)
        joined = salted_join(left, right, ["k"], "left", spread=["id"])
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert sum(sizes) == 4000 and max(sizes) < 1000


def test_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 99), (3, None), (4, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (10,), (None,)], "pk int")
    assert rows(orphans(child, "fk", parent, "pk").select("id")) == [(2,), (4,)]
    assert rows(orphans(child, "fk", parent, "pk", null_is_orphan=True).select("id")) == [(2,), (3,), (4,)]
    assert rows(orphan_keys(child, "fk", parent, "pk")) == [(99, 2)]
    assert rows(orphan_keys(child, "fk", parent, "pk", null_is_orphan=True)) == [(99, 2), (None, 1)]


def test_share_of_total(spark, plan_of):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "g string")
    shares = share_of_total(df, "g", 2, "n", "share")
    assert {r.g: (r.n, str(r["share"])) for r in shares.collect()} == {"a": (2, "66.67"), "b": (1, "33.33")}
    assert "Window" not in plan_of(shares)


def test_top_k_settles_ties_by_key(spark, plan_of):
    df = spark.createDataFrame([(3, 5), (1, 5), (2, None), (4, 9)], "k int, v int")
    top = top_k(df, [F.col("v").desc_nulls_first()], 3, ["k"])
    assert [r.k for r in top.collect()] == [2, 4, 1]
    assert "TakeOrderedAndProject" in plan_of(top)


def test_previous_record_skips_calendar_gaps(spark):
    df = spark.sql(
        "select * from values (1, date'2024-01-01', 5), (1, date'2024-01-09', 8), (2, date'2024-01-02', 1) as t(k, d, v)"
    )
    assert rows(prev_by(df, ["k"], "d", {"p": "v"}).select("k", "v", "p")) == [(1, 5, None), (1, 8, 5), (2, 1, None)]
