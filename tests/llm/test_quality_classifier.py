from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from dailymart.llm import quality
from dailymart.llm.store import saved, ship

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_columns(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    got = quality.scores(docs, labels)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    rows = got.join(labels, "doc_id").collect()
    assert got.count() == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(held) > 40 and np.mean([r.predicted == r.quality for r in held]) >= 0.97
    # Nothing but the text counts, and labels of held-out rows do not.
    other = docs.select("doc_id", "text", F.lit("xx").alias("lang"), F.lit(None).cast("string").alias("score"))
    swapped = labels.withColumn("quality", F.when(F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 5 == 0, 0).otherwise(F.col("quality")))
    again = {r.doc_id: r.score for r in quality.scores(other, swapped).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score, abs=1e-6) for r in rows)


def test_rejected_documents_go(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.select("doc_id").collect()}
    marked = {r.doc_id: r.quality for r in labels.collect()}
    good = [i for i, q in marked.items() if q == 1]
    bad = [i for i, q in marked.items() if q == 0]
    assert sum(i in ids for i in good) >= 0.99 * len(good)
    assert sum(i in ids for i in bad) <= 0.1 * len(bad)


def test_nulls_conflicts_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "A good text."), (2, None), (3, ""), (None, "Some text"), (4, "word " * 50000), (4, "Other")], "doc_id long, text string"
    ).withColumn("label", F.lit(0))
    labels = spark.createDataFrame(
        [(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (99, 0), (4, 0)], "doc_id long, quality int"
    )
    got = quality.scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    none = quality.scores(docs, labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 6
    assert quality.scores(docs.limit(0), labels).collect() == []
    assert quality.accepted(docs, labels.limit(0)).count() == 6


def clouds(rng, n, share, apart=3.0):
    """Rows around two centres, ``share`` of them around the first."""
    first = rng.random(n) < share
    return np.hstack([rng.normal(np.where(first, apart, -apart)[:, None] / 2, 1, (n, 3)), np.ones((n, 1))]), first


def plain_risk(w, positives, unlabelled, prior):
    soft = lambda x: np.log1p(np.exp(x))
    negative = soft(unlabelled @ w).mean() - prior * soft(positives @ w).mean()
    return prior * soft(-(positives @ w)).mean() + max(0.0, negative) + quality.L2 / 2 * (w[:-1] ** 2).sum()


def called_negative(w, unlabelled):
    z = unlabelled @ w
    return np.log1p(np.exp(z)).mean(), unlabelled.T @ (1 / (1 + np.exp(-z))) / len(z)


def test_risk_and_gradient():
    rng = np.random.default_rng(0)
    (positives, _), (unlabelled, _) = clouds(rng, 200, 1.0), clouds(rng, 400, 0.75)
    for k in range(6):
        w, prior = rng.normal(size=4) * (1 + 2 * (k % 2)), (0.75, 0.99)[k % 2]
        value, gradient = quality.risk(w, positives, called_negative(w, unlabelled), prior)
        assert value == pytest.approx(plain_risk(w, positives, unlabelled, prior))
        steps = np.eye(4) * 1e-6
        slope = [(plain_risk(w + s, positives, unlabelled, prior) - plain_risk(w - s, positives, unlabelled, prior)) / 2e-6 for s in steps]
        assert gradient == pytest.approx(slope, abs=1e-5)


def test_training_finds_the_negatives_without_their_labels():
    rng = np.random.default_rng(1)
    (positives, _), (unlabelled, first) = clouds(rng, 3000, 1.0), clouds(rng, 6000, 0.75)
    evaluate = lambda w: quality.risk(w, positives, called_negative(w, unlabelled), 0.75)
    end = quality.minimise(np.zeros(4), evaluate, quality.ROUNDS)
    scores = 1 / (1 + np.exp(-(unlabelled @ end)))
    assert ((scores > 0.5) == first).mean() > 0.97
    assert all(evaluate(end)[0] <= evaluate(end + d)[0] + 1e-4 for d in rng.normal(size=(50, 4)) * 0.05)


@pytest.mark.parametrize("share", [0.2, 0.5, 0.9])
def test_prior_is_found_from_positives_and_unlabelled(share):
    rng = np.random.default_rng(2)
    (positives, _), (unlabelled, _) = clouds(rng, 40_000, 1.0), clouds(rng, 80_000, share)
    bins = lambda t: np.bincount((1 / (1 + np.exp(-t[:, 0])) * quality.BINS).astype(int), minlength=quality.BINS)
    assert quality.least_ratio(bins(positives), bins(unlabelled)) == pytest.approx(share, abs=0.06)


def test_scores_do_not_depend_on_the_partitions(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    one, eight = ({r.doc_id: r.score for r in quality.scores(docs.repartition(n), labels).collect()} for n in (1, 8))
    assert max(abs(one[i] - eight[i]) for i in one) < 1e-6


def test_descriptions():
    table = quality.describe([b"", "Aé a.".encode(), b"a" * 10, b"x"])
    assert table.shape == (4, quality.FEATURES) and not table[0].any()
    pairs = quality.FEATURES - quality.WORD_FEATURES
    assert table[2, 0] == pytest.approx(1) and (table[:, :pairs] ** 2).sum(1).tolist() == pytest.approx([0, 1, 1, 0])


def test_all_positives_are_learnt_from(spark):
    """Model and prior are those of one computer with every positive, also beyond a few thousand."""
    ship(spark)
    rng = np.random.default_rng(3)
    first = rng.random(9000) < 0.8
    table = rng.normal(np.where(first, 0.5, -0.5)[:, None], 1, (9000, quality.FEATURES)).astype(np.float16)
    stored = saved(spark.createDataFrame([(i, r.tobytes()) for i, r in enumerate(table)], "doc_id long, features binary"), "test-features")
    marked = np.flatnonzero(first & (rng.random(9000) < 0.9))
    labels = spark.createDataFrame([(int(i), 1) for i in marked], "doc_id long, label int")
    model, prior = quality.fit(stored, labels)

    plain = table.astype(float)
    rows = np.hstack([(plain - plain.mean(0)) / plain.std(0), np.ones((9000, 1))])
    soft = lambda z: np.logaddexp(0, z)
    positives = rows[marked]

    def apart(w):
        p, q = (1 / (1 + np.exp(-(x @ w))) for x in (positives[::2], rows))
        value = soft(-(positives[::2] @ w)).mean() + soft(rows @ w).mean() + quality.L2 / 2 * (w[:-1] ** 2).sum()
        return value, positives[::2].T @ (p - 1) / len(p) + rows.T @ q / len(q) + quality.L2 * np.append(w[:-1], 0)

    w = quality.minimise(np.zeros(quality.FEATURES + 1), apart, quality.FIRST_ROUNDS)
    bins = lambda x: np.bincount((quality.BINS / (1 + np.exp(-(x @ w)))).astype(int), minlength=quality.BINS)
    expected = quality.least_ratio(bins(positives[1::2]), bins(rows))
    assert len(marked) > 6000 and prior == pytest.approx(expected, abs=1e-6)
    start = np.append(np.zeros(quality.FEATURES), np.log(expected / (1 - expected)))
    end = quality.minimise(start, lambda w: quality.risk(w, positives, called_negative(w, rows), expected), quality.ROUNDS)
    assert model.weights == pytest.approx(end, abs=1e-5)
