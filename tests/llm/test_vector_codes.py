from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from dailymart.llm import vector_codes


def plain(rows):
    """The contract with Python integers: (vec_id, code, error, label_error) of each kept row and the hash."""
    kept = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    whole = [[math.floor(x * 4096) for x in r[1]] for r in kept]
    order = sorted(range(len(kept)), key=lambda k: (kept[k][0] is None, kept[k][0] or 0, whole[k]))
    width = len(whole[order[0]]) // 8
    parts = [[w[p * width : (p + 1) * width] for w in whole] for p in range(8)]
    codes, errors, finals = [""] * len(kept), [0] * len(kept), []
    for part in parts:
        book = [part[k] for k in order[:16]]

        def nearest(x, book):
            return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(book))

        for _ in range(6):
            owner = [nearest(x, book)[1] for x in part]
            for k in range(len(book)):
                own = [x for x, o in zip(part, owner) if o == k]
                if own:
                    book[k] = [sum(c) // len(own) for c in zip(*own)]
        for k, x in enumerate(part):
            d, e = nearest(x, book)
            codes[k] += f"{e:02x}"
            errors[k] += d
        finals += [x for e in book for x in e]
    totals = {}
    for r, e in zip(kept, errors):
        totals[r[2]] = totals.get(r[2], 0) + e
    name = hashlib.sha256(",".join(map(str, finals)).encode()).hexdigest()
    return sorted(((r[0], c, e, totals[r[2]], name) for r, c, e in zip(kept, codes, errors)), key=str)


def got(spark, rows, partitions=3):
    frame = spark.createDataFrame(
        [(i, v if v is None else [x if x is None else float(x) for x in v], label, "x", 1) for i, v, label in rows],
        "vec_id long, embedding array<double>, label int, code string, whole int",
    )
    return sorted((tuple(r) for r in vector_codes.compressed(frame.repartition(partitions)).collect()), key=str)


def clouds(rng, n, width, spread=0.1):
    centres = rng.normal(size=(9, width))
    return [(int(i), [float(x) for x in centres[rng.integers(9)] + spread * rng.normal(size=width)], int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("leaf,block", [(24, 4 << 20), (2, 8 * 32 * 50)])
def test_equals_plain_rounds(spark, monkeypatch, leaf, block):
    rng = np.random.default_rng(leaf)
    rows = clouds(rng, 300, 32)
    rows += [(None, rows[5][1], None), (7, rows[9][1], None), rows[3], (-4, [-x for x in rows[0][1]], 2)]
    monkeypatch.setattr(vector_codes, "BLOCK_BYTES", block)
    assert got(spark, rows) == plain(rows)


def test_few_coarse_vectors_with_many_ties(spark):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(x) for x in rng.integers(-2, 2, 16) / 4096], None) for i in rng.permutation(200)]
    assert got(spark, rows) == plain(rows)
    assert got(spark, rows, 1) == got(spark, rows, 7)


@pytest.mark.parametrize("leaf", [1, 3, 24])
@pytest.mark.parametrize("spread", [0, 1, 30, 3000])
def test_trees_give_what_every_point_gives(leaf, spread):
    rng = np.random.default_rng(leaf + spread)
    centres = rng.integers(-20000, 20000, (12, 5))
    whole = centres[rng.integers(12, size=700)] + rng.integers(-spread, spread + 1, (700, 5))
    book = np.concatenate([centres[:6], whole[:6], centres[:2], rng.integers(-9, 9, (2, 5))])
    want = ((whole[:, None] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    tree = vector_codes.Tree.unpack(vector_codes.grow(whole, leaf).pack())
    assert (vector_codes.assigned(tree, whole, book) == want).all()
    sums, numbers = vector_codes.gathered(tree, whole, book)
    assert (numbers == np.bincount(want, minlength=len(book))).all()
    assert (sums == [whole[want == k].sum(axis=0) for k in range(len(book))]).all()


def test_balls_hold_their_points_and_spare_most_of_them():
    rng = np.random.default_rng(8)
    centres = rng.integers(-20000, 20000, (16, 8))
    whole = centres[rng.integers(16, size=4000)] + rng.integers(-300, 300, (4000, 8))
    tree = vector_codes.grow(whole)
    assert sorted(tree.order) == list(range(4000))
    for k in range(len(tree.low)):
        own = whole[tree.order[tree.low[k] : tree.high[k]]]
        assert (own.sum(axis=0) == tree.total[k]).all()
        assert np.sqrt(((own - tree.centre[k]) ** 2).sum(axis=1)).max() <= tree.radius[k] + 1e-6
    single = []
    vector_codes.owners(tree, whole, centres, lambda e, ball, points: single.append(0 if points is None else len(points)))
    assert sum(single) < 40


def test_rows_that_are_left_out(spark):
    rows = [(1, [1.0] * 8, 1), (2, None, 1), (3, [], 1), (4, [1.0] * 7 + [None], 1), (5, [float("nan")] * 8, 1), (6, [float("inf")] * 8, 1)]
    assert got(spark, rows) == [(1, "00" * 8, 0, 0, hashlib.sha256(b",".join([b"4096"] * 8)).hexdigest())]
    assert [r[0] for r in got(spark, [*rows, (7, [1.0] * 16, 1), (8, [70_000.0] * 8, 1), (9, [-1.5] * 8, 3)])] == [1, 9]
    assert got(spark, []) == [] and got(spark, [(1, [1.0] * 9, 1)]) == [] and got(spark, [(1, None, None)]) == []
