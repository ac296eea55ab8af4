from __future__ import annotations

import subprocess

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from dailymart.llm import embeddings
from dailymart.llm.store import shared_folder


def brute(rows, cosine=0.9):
    """(links, component) of each id with a usable vector."""
    ids = np.array([i for i, _ in rows])
    table = np.array([v for _, v in rows], float)
    table /= np.linalg.norm(table, axis=1, keepdims=True)
    linked = table @ table.T >= cosine
    np.fill_diagonal(linked, False)
    component = ids.copy()
    while True:
        after = np.minimum(component, np.where(linked, component[None, :], component.max()).min(axis=1))
        if (after == component).all():
            return {int(i): (int(n), int(c)) for i, n, c in zip(ids, linked.sum(1), component)}
        component = after


def check(spark, rows, extra=(), **sizes):
    schema = "vec_id long, embedding array<double>, links string"
    frame = spark.createDataFrame([(i, v if v is None else [float(x) for x in v], "x") for i, v in [*rows, *extra]], schema)
    got = embeddings.near_duplicates(frame.repartition(4)).collect()
    assert len(got) == len(rows) + len(extra)
    return got


def clouds(rng, dim, groups, size, spread, lone):
    """Groups around centres, copies among them, and lone vectors."""
    out = []
    for _ in range(groups):
        centre = rng.normal(size=dim)
        centre /= np.linalg.norm(centre)
        out += [centre + spread * rng.normal(size=dim) / dim**0.5 for _ in range(rng.integers(1, size))]
    out += [out[k] * 2 for k in range(0, len(out), 9)] + [out[k] for k in range(0, len(out), 7)]
    out += list(rng.normal(size=(lone, dim)))
    return [(int(i), v) for i, v in zip(rng.permutation(len(out) * 2)[: len(out)], out)]


@pytest.mark.parametrize("block, guests, strip", [(8192, 32_768, 512), (37, 90, 16), (8192, 50, 7)])
def test_equal_to_all_pairs(spark, monkeypatch, block, guests, strip):
    """Many cells with guests: every link and component, however the cells are cut into blocks."""
    monkeypatch.setattr(embeddings, "PER_CELL", 60)
    monkeypatch.setattr(embeddings, "BLOCK", block)
    monkeypatch.setattr(embeddings, "GUESTS", guests)
    monkeypatch.setattr(embeddings, "STRIP", strip)
    rng = np.random.default_rng(4)
    rows = clouds(rng, 24, 30, 40, 0.33, 300)
    assert {r.vec_id: (r.n_links, r.component_id) for r in check(spark, rows)} == brute(rows)


def test_components_of_links():
    rng = np.random.default_rng(2)
    for count in (1, 5, 60):
        one, other = rng.integers(0, count, (2, count * 2 // 3))
        want = list(range(count))
        for _ in range(count):
            for a, b in zip(one, other):
                want[a] = want[b] = min(want[a], want[b])
        assert embeddings.local_components(one, other, count).tolist() == want
    chain = np.arange(999)
    assert set(embeddings.local_components(chain, chain + 1, 1000)) == {0}


def test_exact_within_one_cell_and_in_two_dimensions(spark, monkeypatch):
    rng = np.random.default_rng(5)
    rows = clouds(rng, 16, 12, 20, 0.4, 50)
    assert {r.vec_id: (r.n_links, r.component_id) for r in check(spark, rows)} == brute(rows)
    monkeypatch.setattr(embeddings, "PER_CELL", 20)
    flat = clouds(rng, 2, 5, 20, 0.3, 20)
    assert {r.vec_id: (r.n_links, r.component_id) for r in check(spark, flat)} == brute(flat)


@pytest.mark.parametrize("rank", [16, 384])
def test_every_pair_at_the_threshold_meets_whatever_the_rank(rank):
    """Vectors of few effective dimensions come nearer to borders than their nominal dimension suggests."""
    rng = np.random.default_rng(7)
    basis = np.linalg.qr(rng.normal(size=(384, rank)))[0].T
    one, across = rng.normal(size=(2, 3000, rank))
    one /= np.linalg.norm(one, axis=1, keepdims=True)
    across -= (across * one).sum(axis=1, keepdims=True) * one
    across /= np.linalg.norm(across, axis=1, keepdims=True)
    other = (0.901 * one + (1 - 0.901**2) ** 0.5 * across) @ basis
    one = one @ basis
    cells = embeddings.Cells(embeddings.spherical_kmeans(one, 60), 0.9)
    (home, there), (home_too, there_too) = cells.places(one), cells.places(other)
    row = np.arange(len(one))
    assert (home != home_too).any()
    assert (there[row, home_too] | there_too[row, home]).mean() == 1


def test_vectors_that_link_with_nothing(spark):
    rows = [(1, [1, 0]), (2, [2, 0.0]), (3, [1, -0.0]), (9, [1e300, 1e299]), (9, [1e300, 1e299])]
    extra = [
        (4, None), (5, []), (6, [0, 0]), (7, [1, float("nan")]), (8, [float("inf"), 1]), (None, [1, 0]), (None, None), (10, [1, 0, 0]), (4, [0, 1])
    ]
    got = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in check(spark, rows, extra)), key=str)
    want = [(1, 4, 1, True), (2, 4, 1, False), (3, 4, 1, False), (9, 4, 1, False), (9, 4, 1, False)]
    want += [(i, 0, i, True) for i in (4, 4, 5, 6, 7, 8, 10)] + [(None, 0, None, True)] * 2
    assert got == sorted(want, key=str)
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert embeddings.near_duplicates(empty).collect() == []
    nulls = spark.createDataFrame([(1, [1.0, None])], "vec_id long, embedding array<float>").withColumn("n", F.lit(1))
    assert [tuple(r) for r in embeddings.near_duplicates(nulls).collect()] == [(1, 0, 1, True)]


def test_disk_is_a_few_times_the_vectors(spark, monkeypatch):
    """Vectors without structure are near the borders of many cells, but are not copied to them on disk."""
    folders = [*spark._jsc.sc().env().blockManager().diskBlockManager().localDirsString(), shared_folder(spark).removeprefix("file://")]

    def used():
        return int(subprocess.run(["du", "-scB1", "--apparent-size", *folders], capture_output=True, text=True).stdout.split()[-2])

    most, save = [], embeddings.saved

    def saved(*args):
        out = save(*args)
        most.append(used())
        return out

    monkeypatch.setattr(embeddings, "PER_CELL", 60)
    rng = np.random.default_rng(9)
    table = rng.normal(size=(6000, 64)).astype(np.float32)
    table[5900:] = table[0] + rng.normal(size=(100, 64)).astype(np.float32) / 4
    rows = list(enumerate(table.tolist()))
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").repartition(4).cache()
    frame.count()
    before = used()
    monkeypatch.setattr(embeddings, "saved", saved)
    got = embeddings.near_duplicates(frame)
    assert max(most) - before < 6 * table.nbytes
    assert {r.vec_id: (r.n_links, r.component_id) for r in got.collect()} == brute(rows)
    frame.unpersist()


@pytest.mark.parametrize("rank", [24, 48])
def test_the_screen_loses_no_pair(rank):
    rng = np.random.default_rng(3)
    sample = embeddings._units(rng.normal(size=(900, rank)) @ rng.normal(size=(rank, 48)) + 0.01 * rng.normal(size=(900, 48)))
    unit = sample.astype(np.float32)
    basis = embeddings.screen(sample, 0.9)
    assert basis.shape[1] < 48
    few = embeddings.short(unit, basis.astype(np.float32))
    assert (few @ few.T >= sample @ sample.T - 52 * 1.2e-7).all()
    assert (few @ few.T >= 0.9).mean() < 0.5


def test_copies_meet_over_batches_and_packs_end():
    """A content whose copies come in several batches is one row; packs are of one dimension and bounded."""
    rng = np.random.default_rng(6)
    tables = {dim: rng.normal(size=(9, dim)).astype(np.float32) for dim in (3, 5)}
    cells = {dim: embeddings.Cells(embeddings.spherical_kmeans(embeddings._units(t), 2), 0.9) for dim, t in tables.items()}
    rows = [(dim, int(cells[dim].homes(embeddings._units(v[None]))[0]), bytes([dim, k]) + bytes(14), 100 * dim + k + 20 * c, c + 1, v.tobytes())
            for dim, t in tables.items() for k, v in enumerate(t) for c in range(3)]
    rows.sort(key=lambda r: r[:4])
    names = ["dim", "cell", "content", "node", "n", "vector"]
    kinds = [pa.int32(), pa.int32(), pa.binary(), pa.int64(), pa.int64(), pa.binary()]
    whole = pa.record_batch([pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], names)
    for size in (1, 2, 7, 100):
        batches = [whole.slice(k, size) for k in range(0, len(rows), size)]
        packs = list(embeddings._packed(cells, {3: 4, 5: 100}, iter(batches)))
        assert [(p.column("dim")[0].as_py(), len(p.column("n")[0].as_py()) // 8) for p in packs] == [(3, 4), (3, 4), (3, 1), (5, 9)]
        nodes = np.concatenate([np.frombuffer(p.column("node")[0].as_py(), np.int64) for p in packs])
        assert sorted(nodes.tolist()) == [100 * dim + k for dim in (3, 5) for k in range(9)]
        assert all((np.frombuffer(p.column("n")[0].as_py(), np.int64) == 6).all() for p in packs)


def test_homes_do_not_depend_on_the_batch():
    """Equal vectors get equal cells though centres are equal, or they would be two rows."""
    rng = np.random.default_rng(8)
    unit = embeddings._units(rng.normal(size=(500, 33)))
    cells = embeddings.Cells(np.concatenate([unit[:40], unit[:40], unit[:7]]), 0.9)
    whole = cells.homes(unit)
    assert (whole < 40).all()
    assert all((cells.homes(unit[k : k + size]) == whole[k : k + size]).all() for size in (1, 3, 64) for k in range(0, 500, size))
    assert (np.concatenate(list(map(cells.homes, embeddings._slices(unit, 9)))) == whole).all()
    assert list(map(len, embeddings._slices(unit, 300))) == [300, 200]
