from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from dailymart.llm import queries, sharding


def brute(rows, limit):
    """Shards by splitting one bucket after the other on the next bit of the hash."""
    address = {i: bin(int(hashlib.md5(str(i).encode()).hexdigest()[:15], 16))[2:].zfill(60) for i, _ in rows}
    out, open_ = {}, [("", rows)]
    while open_:
        prefix, own = open_.pop()
        if sum(n for _, n in own) <= limit or len(own) == 1:
            out.update({i: prefix for i, _ in own})
            continue
        sides = [[r for r in own if address[r[0]][len(prefix)] == b] for b in "01"]
        open_ += [(prefix + b, s) for b, s in zip("01", sides) if s]
    return out


@pytest.mark.parametrize("limit", [50, 700, 10**9])
def test_equals_splitting_bucket_by_bucket(spark, limit):
    rows = [(i * 7, (i * i) % 23 + (100 if i % 50 == 3 else 0)) for i in range(400)]
    docs = spark.createDataFrame([(i, "x" * n, "b") for i, n in rows], "doc_id long, text string, shard string")
    got = sharding.shards(docs.repartition(3), limit).collect()
    assert {r.doc_id: r.shard for r in got} == brute(rows, limit)
    for r in got:
        assert r.depth == len(r.shard) and r.oversized == (r.shard_bytes > limit) and (not r.oversized or r.shard_rows == 1)


def test_rows_of_one_key_are_spread(spark):
    rows = [(1, "abcdefghij")] * 300 + [(None, "abcdefghij")] * 50 + [(i, "x") for i in range(2, 40)] + [(2, None), (3, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    placed = sharding.shards(docs, 100)
    got = placed.collect()
    assert len(got) == len(rows)
    total = defaultdict(int)
    for r in got:
        total[r.shard] += r.n_bytes
    assert max(total.values()) <= 100 and {r.shard: r.shard_bytes for r in got} == dict(total)
    shards = sorted(total)
    assert not any(b.startswith(a) for a, b in zip(shards, shards[1:]))
    assert sharding.directory(placed).count() == len(shards)


def test_written_shards_and_empty_table(spark, tmp_path):
    docs = spark.createDataFrame([(i, "é" * i, i % 3, None) for i in range(60)], "doc_id long, text string, n_bytes int, depth string")
    sharding.write(docs, 400, f"{tmp_path}/out")
    back = spark.read.parquet(f"{tmp_path}/out")
    assert back.count() == 60
    sizes = back.groupBy("shard").agg(F.sum(F.octet_length("text")).alias("n")).collect()
    assert len(sizes) > 5 and max(r.n for r in sizes) <= 400
    assert sharding.shards(docs.limit(0), 10).collect() == []


def test_registered_query_splits_a_few_megabytes(spark, tmp_path):
    rows = [(i, "x" * 150_000) for i in range(24)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op7_sharding(spark, str(tmp_path)).collect()
    assert {r.doc_id: r.shard for r in got} == brute([(i, len(t)) for i, t in rows], 1 << 20)
    assert len({r.shard for r in got}) > 3
