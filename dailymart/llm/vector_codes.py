"""Vector code compression: a codebook per part of the vectors, trained on metric trees.

Components become integers, vectors are cut into ``PARTS`` equal consecutive parts, and each part position has a
codebook of at most ``ENTRIES`` entries, moved ``ROUNDS`` times to the mean of the parts nearest to them. All of it is
integer arithmetic, so the result is that of the plain rounds, digit for digit.

Vectors are kept in blocks of about ``BLOCK_BYTES``. For every block and part position a task grows an anchors hierarchy
once: anchors are placed farthest first and take over the points that are nearer to them; neighbouring balls are then
merged upwards to one root, and the points of each anchor are divided in the same way further down (middle out). Every
ball keeps the number and the sum of its points. A round goes down each tree with a list of entries that may still own points:
a ball passes its children only those that the plane half way to its nearest entry does not rule out, and when one is left,
the ball's sum and number are added without looking at its points. Only the points of the smallest balls are compared one
by one. Trees are written to the shared folder; a round reads them, sends its codebooks (at most ``PARTS * ENTRIES``
entries) to the tasks and adds up their sums, so no vector is shuffled.

Rounding cannot change the result: an entry is ruled out only by more than the error of the floating-point numbers, and
points are compared in integers.

Defined cases: rows whose vector is null, empty, or holds null or non-finite components are dropped; so are components
of ``MOST`` or more in size, whose squares would not fit, and vectors whose length is not that of the first kept
vector or no multiple of ``PARTS``. Null vec_ids come last in the order and are coded like others. Rows with equal vec_ids go by their
components. With fewer than ``ENTRIES`` vectors there are as many entries. Repeated rows are coded each. No vectors: no rows.
Null labels are one label. Other columns play no part.
"""

from __future__ import annotations

import hashlib
import io
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.llm.store import saved

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components of this size or more are dropped with their vectors.
MOST = 65_536.0

#: Integers of the vectors of a block, and points of the smallest balls.
BLOCK_BYTES = 4 << 20
LEAF = 24

ROWS = "vec_id long, label string, whole array<long>"


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors as integers; those with unusable components are left out."""
    for batch in batches:
        keep, made = [], []
        for k, values in enumerate(batch.column("embedding")):
            if not values.is_valid or not len(values.values) or values.values.null_count:
                continue
            vector = values.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if np.isfinite(vector).all() and np.abs(vector).max() < MOST:
                keep.append(k)
                made.append(np.floor(vector * SCALE).astype(np.int64))
        rows = batch.take(pa.array(keep, pa.int64()))
        yield pa.record_batch(
            [rows.column("vec_id"), rows.column("label"), pa.array(made, pa.list_(pa.int64()))], ["vec_id", "label", "whole"]
        )


@dataclass
class Tree:
    """Balls over points in ``order``: ball ``k`` holds ``order[low[k]:high[k]]``; ball 0 is the root.

    ``child`` is the first of its two children, which are numbered in a row, or -1.
    """

    order: np.ndarray
    low: np.ndarray
    high: np.ndarray
    child: np.ndarray
    centre: np.ndarray
    radius: np.ndarray
    total: np.ndarray

    def pack(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, **vars(self))
        return out.getvalue()

    @staticmethod
    def unpack(data: bytes) -> Tree:
        with np.load(io.BytesIO(data)) as stored:
            return Tree(**{k: stored[k] for k in stored.files})


def anchors(points: np.ndarray, count: int) -> np.ndarray:
    """For each point the number of the nearest of ``count`` anchors at most, placed one by one.

    The next anchor is the point farthest from its own. It takes points only from anchors that it is nearer to than
    twice their radius, and of their points only those farther from the anchor than half the way to the new one.
    """
    owner = np.zeros(len(points), np.int64)
    pivots = [0]
    away = np.sqrt(((points - points[0]) ** 2).sum(axis=1))
    while len(pivots) < count:
        pivot = int(away.argmax())
        if away[pivot] == 0:
            break  # only equal points are left
        between = np.sqrt(((points[pivots] - points[pivot]) ** 2).sum(axis=1))
        maybe = np.flatnonzero(away > between[owner] / 2)
        apart = np.sqrt(((points[maybe] - points[pivot]) ** 2).sum(axis=1))
        nearer = apart < away[maybe]
        taken = maybe[nearer]
        owner[taken], away[taken] = len(pivots), apart[nearer]
        pivots.append(pivot)
    return owner


class _Ball:
    def __init__(self, members: np.ndarray, points: np.ndarray, children: tuple[_Ball, _Ball] | None = None):
        self.members, self.children = members, children
        own = points[members]
        self.centre = own.mean(axis=0)
        self.radius = float(np.sqrt(((own - self.centre) ** 2).sum(axis=1).max()))


def _merged(balls: list[_Ball], points: np.ndarray) -> _Ball:
    """Two balls at a time become one, those first whose common ball is smallest, until one is left."""
    centres = np.array([b.centre for b in balls])
    radii = np.array([b.radius for b in balls])
    balls = list(balls)
    alive = np.ones(len(balls), bool)
    gaps = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(axis=2))
    size = (gaps + radii[:, None] + radii[None]) / 2
    np.fill_diagonal(size, np.inf)
    for _ in range(len(balls) - 1):
        a, b = divmod(int(size.argmin()), len(balls))
        balls[a] = _Ball(np.concatenate([balls[a].members, balls[b].members]), points, (balls[a], balls[b]))
        centres[a], radii[a], alive[b] = balls[a].centre, balls[a].radius, False
        size[b] = size[:, b] = np.inf
        others = np.flatnonzero(alive)
        others = others[others != a]
        new = (np.sqrt(((centres[others] - centres[a]) ** 2).sum(axis=1)) + radii[others] + radii[a]) / 2
        size[a, others] = size[others, a] = new
        root = a
    return balls[root] if len(balls) > 1 else balls[0]


def _divided(members: np.ndarray, points: np.ndarray, leaf: int) -> _Ball:
    """Middle out: anchors over the points, balls merged above them, each anchor's points divided below."""
    if len(members) > leaf:
        owner = anchors(points[members], int(np.ceil(len(members) ** 0.5)))
        if owner.any():
            groups = [members[owner == k] for k in range(owner.max() + 1)]
            return _merged([_divided(g, points, leaf) for g in groups if len(g)], points)
    return _Ball(members, points)


def grow(whole: np.ndarray, leaf: int = LEAF) -> Tree:
    """The tree over the rows of ``whole`` (integers, at least one row)."""
    points = whole.astype(np.float64)
    root = _divided(np.arange(len(points)), points, leaf)
    balls, child, low = [root], [], [0]
    for k, ball in enumerate(balls):  # grows while it is read
        child.append(len(balls) if ball.children else -1)
        if ball.children:
            left, right = ball.children
            balls += [left, right]
            low += [low[k], low[k] + len(left.members)]
    low = np.array(low)
    high = low + [len(b.members) for b in balls]
    return Tree(
        order=root.members,
        low=low,
        high=high,
        child=np.array(child),
        centre=np.array([b.centre for b in balls]),
        radius=np.array([b.radius for b in balls]),
        total=np.array([whole[b.members].sum(axis=0) for b in balls]),
    )


def owners(tree: Tree, whole: np.ndarray, book: np.ndarray, visit) -> None:
    """Call ``visit(entries, ball, points)``: for a wholly owned ball its entry, else the entries of single points.

    ``ball`` is None where ``points`` are given and their numbers otherwise belong to the ball.
    """
    exact = book.astype(np.float64)
    # An entry equal to an earlier one owns nothing.
    first = [k for k in range(len(book)) if not (book[:k] == book[k]).all(axis=1).any()]
    apart = np.sqrt(((exact[:, None] - exact[None]) ** 2).sum(axis=2))
    todo = [(0, np.array(first))]
    while todo:
        ball, maybe = todo.pop()
        if len(maybe) > 1:
            away = ((exact[maybe] - tree.centre[ball]) ** 2).sum(axis=1)
            nearest = int(away.argmin())
            # Twice the way from the centre to the plane between the two, times their distance.
            lead = away - away[nearest]
            reach = 2 * tree.radius[ball] * apart[maybe[nearest], maybe]
            slack = 1e-9 * (away + away[nearest] + reach) + 1e-6
            maybe = maybe[(lead <= reach + slack) | (maybe == maybe[nearest])]
        if len(maybe) == 1:
            visit(int(maybe[0]), ball, None)
        elif tree.child[ball] >= 0:
            todo += [(tree.child[ball], maybe), (tree.child[ball] + 1, maybe)]
        else:
            points = tree.order[tree.low[ball] : tree.high[ball]]
            away = ((whole[points][:, None] - book[maybe][None]) ** 2).sum(axis=2)
            visit(maybe[away.argmin(axis=1)], None, points)  # the first of equal ones has the lower index


def gathered(tree: Tree, whole: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sums, numbers) of the points each entry owns."""
    sums, numbers = np.zeros_like(book), np.zeros(len(book), np.int64)

    def visit(entries, ball, points):
        if points is None:
            sums[entries] += tree.total[ball]
            numbers[entries] += tree.high[ball] - tree.low[ball]
        else:
            np.add.at(sums, entries, whole[points])
            np.add.at(numbers, entries, 1)

    owners(tree, whole, book, visit)
    return sums, numbers


def assigned(tree: Tree, whole: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The entry of each point."""
    out = np.empty(len(whole), np.int64)

    def visit(entries, ball, points):
        out[tree.order[tree.low[ball] : tree.high[ball]] if points is None else points] = entries

    owners(tree, whole, book, visit)
    return out


BLOCKS = "vec_ids array<long>, labels array<string>, whole binary, trees array<binary>"


def _cut(whole: np.ndarray) -> list[np.ndarray]:
    return np.split(whole, PARTS, axis=1)


def _grown(width: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of vectors with a tree for each part position."""
    most = max(1, BLOCK_BYTES // (8 * width))

    def block(rows: pa.Table) -> pa.RecordBatch:
        column = rows.column("whole").combine_chunks()
        whole = column.flatten().to_numpy().reshape(-1, width)
        trees = [grow(part).pack() for part in _cut(whole)]
        columns = [
            pa.array([rows.column("vec_id").to_pylist()], pa.list_(pa.int64())),
            pa.array([rows.column("label").to_pylist()], pa.list_(pa.string())),
            pa.array([whole.tobytes()], pa.binary()),
            pa.array([trees], pa.list_(pa.binary())),
        ]
        return pa.record_batch(columns, ["vec_ids", "labels", "whole", "trees"])

    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            room = most - sum(b.num_rows for b in waiting)
            waiting.append(batch.slice(0, room))
            batch = batch.slice(room)
            if sum(b.num_rows for b in waiting) == most:
                yield block(pa.Table.from_batches(waiting))
                waiting = []
    if waiting and sum(b.num_rows for b in waiting):
        yield block(pa.Table.from_batches(waiting))


SUMS = "part int, entry int, position int, total long, number long"


def _opened(batch: pa.RecordBatch, k: int, width: int) -> tuple[list[np.ndarray], list[Tree]]:
    whole = np.frombuffer(batch.column("whole")[k].as_py(), np.int64).reshape(-1, width)
    return _cut(whole), [Tree.unpack(t) for t in batch.column("trees")[k].as_py()]


def _summed(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and numbers of all blocks of a task; ``books`` by part, entry and position."""
    parts, entries, width = books.shape
    sums, numbers = np.zeros_like(books), np.zeros((parts, entries), np.int64)
    for batch in batches:
        for k in range(batch.num_rows):
            for part, (whole, tree) in enumerate(zip(*_opened(batch, k, parts * width))):
                more, count = gathered(tree, whole, books[part])
                sums[part] += more
                numbers[part] += count
    part, entry, position = (x.ravel().astype(np.int32) for x in np.indices(books.shape))
    yield pa.record_batch(
        [part, entry, position, sums.ravel(), np.repeat(numbers.ravel(), width)], ["part", "entry", "position", "total", "number"]
    )


def _coded(books: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parts, _, width = books.shape
    for batch in batches:
        for k in range(batch.num_rows):
            pieces, trees = _opened(batch, k, parts * width)
            codes = [assigned(t, w, b) for t, w, b in zip(trees, pieces, books)]
            error = sum(((w - b[c]) ** 2).sum(axis=1) for w, b, c in zip(pieces, books, codes))
            texts = [row.tobytes().hex() for row in np.array(codes, np.uint8).T.copy()]
            ids = pa.array(batch.column("vec_ids")[k].as_py(), pa.int64())
            labels = pa.array(batch.column("labels")[k].as_py(), pa.string())
            yield pa.record_batch([ids, labels, pa.array(texts, pa.string()), pa.array(error, pa.int64())], ["vec_id", "label", "code", "error"])


def _moved(books: np.ndarray, blocks: DataFrame) -> np.ndarray:
    """The codebooks after a round; what comes to the driver is one row for each number in them."""
    found = blocks.mapInArrow(partial(_summed, books), SUMS).groupBy("part", "entry", "position")
    found = found.agg(F.sum("total").alias("total"), F.sum("number").alias("number"))
    after = books.copy()
    for part, entry, position, total, number in found.collect():
        if number:
            after[part, entry, position] = total // number  # goes down for negative sums too
    return after


def fingerprint(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def codes(vectors: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``vec_id, label, code, error`` (stored) and the codebooks by part, entry and position."""
    read = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("string").alias("label"), "embedding")
    whole = saved(read.mapInArrow(_integers, ROWS), "integers")
    order = [F.col("vec_id").asc_nulls_last(), "whole"]
    first = whole.orderBy(*order).limit(1).collect()
    width = len(first[0].whole) if first else 0
    if not width or width % PARTS:
        return whole.limit(0).select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), np.zeros((PARTS, 0, 0), np.int64)
    alike = whole.where(F.size("whole") == width)
    start = np.array([r.whole for r in alike.orderBy(*order).limit(ENTRIES).collect()], np.int64)
    books = np.stack(_cut(start))
    blocks = saved(alike.mapInArrow(partial(_grown, width), BLOCKS), "trees")
    for _ in range(ROUNDS):
        books = _moved(books, blocks)
    return saved(blocks.mapInArrow(partial(_coded, books), "vec_id long, label string, code string, error long"), "codes"), books


def compressed(vectors: DataFrame) -> DataFrame:
    """``vec_id, code, error, label_error, codebooks_sha256``: one row per kept row of ``vectors``.

    ``code``: two hex digits for each part. ``label_error``: errors of all rows with an equal label.
    """
    coded, books = codes(vectors)
    by_label = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))


def sql() -> str:
    """The same as plain rounds for DuckDB, over vectors of one length; no tree and no shortcut."""
    nearest = """
near{k} AS MATERIALIZED (
  SELECT id, part, min(struct_pack(d := d, entry := entry)) AS best FROM (
    SELECT p.id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d
    FROM parts p JOIN book{k} b USING (part, position) GROUP BY ALL
  ) GROUP BY ALL
)"""
    move = """
book{n} AS MATERIALIZED (
  SELECT b.part, b.entry, b.position, coalesce(m.x, b.x) AS x FROM book{k} b LEFT JOIN (
    SELECT part, best.entry AS entry, position,
      CAST(sum(x) AS BIGINT) // count(*) - CASE WHEN CAST(sum(x) AS BIGINT) % count(*) < 0 THEN 1 ELSE 0 END AS x
    FROM near{k} JOIN parts USING (id, part) GROUP BY ALL
  ) m USING (part, entry, position)
)"""
    rounds = [f.format(k=k, n=k + 1) for k in range(ROUNDS) for f in (nearest, move)]
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, list_transform(embedding, lambda x: floor(x::DOUBLE * {SCALE}))) AS id,
    vec_id, label, embedding
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
parts AS MATERIALIZED (
  SELECT id, CAST(floor((k - 1) / (n // {PARTS})) AS INTEGER) AS part, (k - 1) % (n // {PARTS}) AS position, x FROM (
    SELECT id, len(embedding) AS n, unnest(range(1, len(embedding) + 1)) AS k,
      CAST(floor(unnest(embedding)::DOUBLE * {SCALE}) AS BIGINT) AS x
    FROM kept
  )
),
book0 AS MATERIALIZED (SELECT part, CAST(id - 1 AS INTEGER) AS entry, position, x FROM parts WHERE id <= {ENTRIES}),
{",".join(rounds)},{nearest.format(k=ROUNDS)},
coded AS (
  SELECT id, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near{ROUNDS} GROUP BY id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
  (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, position)) FROM book{ROUNDS}) AS codebooks_sha256
FROM kept JOIN coded USING (id)
"""
