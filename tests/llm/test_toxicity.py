from __future__ import annotations

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dailymart.llm import toxicity as tx

PLAIN = [f"word{i}" for i in range(300)]
INSULTS = ["zorgle", "snarfy", "vermik"]


def labelled(rng, n, mention):
    """Toxic rows hold an insult and, as in biased data, mostly mention one group; neutral ones mostly do not."""
    rows = []
    for i in range(n):
        toxic = int(rng.random() < 0.3)
        words = rng.choices(PLAIN, k=rng.randint(5, 60))
        if toxic:
            words.insert(0, rng.choice(INSULTS) + rng.choice(["", "s", "ing"]))
        if rng.random() < (mention if toxic else 0.05):
            words.insert(0, "muslims")
        rng.shuffle(words)
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.fixture(scope="module")
def biased(spark):
    rows = labelled(random.Random(6), 900, 0.9)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string").repartition(3)
    return rows, docs, spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, toxic int")


def test_held_out_accuracy(biased):
    rows, docs, labels = biased
    got = tx.scores(docs.withColumn("label", F.lit("x")), labels)
    assert got.dtypes == [("doc_id", "bigint"), ("held_out", "boolean"), ("score", "double"), ("predicted", "int")]
    truth = {i: t for i, _, t in rows}
    found = got.collect()
    assert len(found) == len(rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    held = [r for r in found if r.held_out]
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) >= 0.97


def test_mentions_do_not_carry_the_score(biased):
    """The penalty takes away what the biased labels teach about a group; insults still count."""
    _, docs, labels = biased
    learnt = labels.withColumnRenamed("toxic", "label")
    free, fair = (tx.fit(docs, learnt, fairness=w) for w in (0.0, tx.FAIRNESS))

    def odds(model, text):
        p = model.score(text)
        return np.log(p / (1 - p))

    texts = [f"{' '.join(PLAIN[k : k + 8])} {{}} {PLAIN[k + 9]}" for k in range(0, 100, 7)]
    change = {
        name: np.mean([abs(odds(m, t.format("muslims")) - odds(m, t.format("christians"))) for t in texts])
        for name, m in (("free", free), ("fair", fair))
    }
    assert change["fair"] < 0.3 * change["free"]
    assert not any(fair.score(t.format("muslims")) >= 0.5 for t in texts)
    assert all(fair.score(t.format("vermik")) >= 0.5 for t in texts)


def test_swaps_stay_within_a_kind_and_form():
    swap = tx.swaps()
    assert b"men" in swap[b"women"] and b"man" in swap[b"woman"] and b"nonbinary" in swap[b"women"]
    assert not any(term in others for term, others in swap.items())
    assert tx.variants({b"a", b"gay"}, {b"gay": [b"straight", b"lesbian"]}) == [{b"a", b"straight"}, {b"a", b"lesbian"}]
    assert swap[b"jewish"][-1] == b"people"


def test_nulls_conflicts_one_class_and_empty_tables(spark):
    docs = spark.createDataFrame(
        [(1, "zorgle here"), (2, None), (3, ""), (None, "zorgle"), (4, "word " * 60000), (4, "Other")], "doc_id long, text string"
    )
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (99, 0), (4, 0)], "doc_id long, toxic int")
    got = tx.scores(docs, labels).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.held_out is not None for r in got)
    assert {r.score for r in tx.scores(docs, labels.limit(0)).collect()} == {0.5}
    assert len({r.score for r in tx.scores(docs, labels.where("toxic = 1")).collect()}) == 1
    assert tx.scores(docs.limit(0), labels).collect() == []


def test_copies_come_as_swaps_that_lead_to_the_same_penalty():
    """What a text sends for its copies does not grow with its length, and the changes are those of whole copies."""
    swap = tx.swaps()
    texts = ["muslims and jews met " + " ".join(f"w{i}" for i in range(20_000)), "a gay person and a straight one", "old women, Old men", "", None]
    ids = pa.array(range(5), pa.int64())
    batch = pa.record_batch([ids, ids, pa.array([0, 1, 0, 1, 0], pa.int32()), pa.array(texts)], ["doc_id", "key", "label", "text"])
    out = pa.Table.from_batches(tx._sampled(swap, iter([batch])))
    assert out.nbytes < 1.1 * out.column("features").nbytes
    sets = [tx.words_of(t) for t in texts]
    features = np.unique([f for w in [*swap, *(o for others in swap.values() for o in others)] for f in tx.features_of(w)])
    changes, times = tx._changes(out.column("swapped").to_pylist(), swap, features)
    dense = lambda words: tx._dense([tx._hashes(words)], features)[0]
    want = sorted(tuple(dense(v) - dense(w)) for w in sets for v in tx.variants(w, swap))
    assert len(want) and sorted(map(tuple, np.repeat(changes, times, axis=0))) == want
    table, labels = np.random.default_rng(1).random((4, len(features))), np.array([0, 1, 0, 1])
    once, whole = tx.train(table, labels, changes, times=times), tx.train(table, labels, np.array(want))
    assert once[0] == pytest.approx(whole[0], abs=1e-2) and np.allclose(once[1], whole[1], atol=1e-2)


def test_what_reaches_the_driver_does_not_grow_with_texts():
    """Of each text the kept features and how often it has them, as counted from the whole text."""
    words = [{b"trash", b"trashed", b"fine"}, {f"w{i}".encode() for i in range(50_000)} | {b"trash"}, set()]
    features = np.unique(tx.features_of(b"trash") + tx.features_of(b"idiot")).astype(np.int64)
    ids = pa.array(range(3), pa.int64())
    rows = [tx._hashes(w) for w in words]
    batch = pa.record_batch(
        [ids, ids, pa.array([1, 0, 0], pa.int32()), pa.array(rows, pa.list_(pa.int32())), pa.array([b""] * 3)],
        ["doc_id", "key", "label", "features", "swapped"],
    )
    (out,) = tx._cut(features, iter([batch]))
    assert out.nbytes < 500
    table = np.zeros((3, len(features)))
    for k, (places, times) in enumerate(zip(out.column("places").to_pylist(), out.column("times").to_pylist())):
        table[k, np.frombuffer(places, "<i2")] = np.frombuffer(times, "<i4")
    assert np.array_equal(table, tx._dense(rows, features)) and table.sum() > 3


def test_features_are_counted_over_rows(spark):
    rows = spark.createDataFrame([(1, [5, 5, 7]), (0, [5, 7]), (1, [5]), (0, []), (1, [9, 9, 9])], "label int, features array<int>")
    assert [tuple(r) for r in tx._counted(rows).collect()] == [(5, 2, 1)]
    chi = spark.createDataFrame([(20, 30)], "a long, b long").select(tx._chi_square(50, 150)).first()[0]
    assert chi == pytest.approx(200 * (20 * 120 - 30 * 30) ** 2 / (50 * 150 * 50 * 150))


def test_exact_test_and_discovery_rate():
    assert tx.exact_p(3, 0, 3, 3) == pytest.approx(0.1)  # 1 / 20, twice
    assert tx.exact_p(8, 2, 10, 10) == pytest.approx(2 * (45 * 45 + 10 * 10 + 1) / 184_756)
    assert tx.exact_p(5, 5, 10, 10) == 1.0 and tx.exact_p(0, 0, 4, 6) == 1.0
    p = np.array([0.5, 0.001, 0.03, 0.02, 0.9])
    assert tx.significant(p, 5) == 3 and tx.significant(p, 1000) == 0 and tx.significant(np.array([]), 0) == 0


def test_scores_do_not_depend_on_partitions_or_repeated_rows(biased):
    _, docs, labels = biased
    learnt = labels.withColumnRenamed("toxic", "label")
    models = [tx.fit(d, learnt) for d in (docs.repartition(1), docs.repartition(7), docs.union(docs).repartition(4))]
    assert models[0].bias == models[1].bias == models[2].bias
    assert models[0].weights == models[1].weights == models[2].weights


def test_small_tables_are_learnt_from(spark):
    """A few hundred labelled rows. Of the six held-out toxic texts two hold no insult at all; the others are found."""
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    held = tx.scores(docs, labels).where("held_out").join(labels.where("toxic IS NOT NULL"), "doc_id").collect()
    assert sum(r.predicted for r in held if r.toxic == 1) >= 4
    assert sum(r.predicted for r in held if r.toxic == 0) <= 1
