"""Near-duplicate embeddings: spherical k-means cells, packs of vectors that meet in memory, one vector kept per group.

Equal vectors are one with a count. The centres are fitted on a bounded sample (``SAMPLE`` vectors by hash of
their content); every vector is assigned to a cell. Vectors are stored once, as they came (floats stay floats), in packs
of at most ``GUESTS`` vectors in order of their cells. Every two packs that may hold a link meet in a task that reads both
(a Cartesian product of packs, which moves nothing to disk), so what is written grows with the vectors, not with pairs.

Vectors of two cells are on either side of the hyperplane between the two centres, or their signed distances
say otherwise; in any case these add up to at most the distance of the two. So a pair at the threshold has distances that
add up to at most the distance at the threshold, whatever the data: only rows within that are multiplied, and no link is
missed. One of the two is then within half of it; packs without such vectors are not paired. What is left is first multiplied
in a few directions only, with the length of the rest as one more: this is never less than the cosine. Products are of
32-bit numbers; those too near to the threshold for these are made again in doubles.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components link with nothing
and are kept; so do rows with a null vec_id, whose component is null. Vectors of different dimensions are
never compared. Rows that share a vec_id are one node. Other columns, label among them, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dailymart.llm.graph import components
from dailymart.llm.store import saved

SAMPLE = 20_000
#: Vectors for each centre, and most centres: a centre needs some of the sample to be fitted on.
PER_CELL = 2048
CENTRES = SAMPLE // 16
ITERATIONS = 8
#: Vectors of a pack at most, also in bytes of 32-bit numbers, and packs that are made of few vectors.
GUESTS, GUEST_BYTES = 32_768, 1 << 20
PACKS = 24
#: Rows that are multiplied at once with as many others at most.
STRIP, BLOCK = 256, 8192
#: Work on a pair that passes the screen, in components of a product of many, and pairs that are gathered for it.
PAIR_WORK = 6000
WAITING = 1 << 17
#: Bytes of packs in a file and for a task, and parts of the packs at least: as many tasks as pairs of parts.
FILE_BYTES, PART_BYTES, PARTS = 4 << 20, 16 << 20, 8
#: Pairs of packs go to Python one by one if they are larger than this; Spark would gather 64 MB.
BATCH_BYTES = 1 << 20

CONTENT_BYTES = 16
VECTORS = "vec_id long, dim int, content binary, vector binary"
ASSIGNED = "dim int, cell int, content binary, node long, n long, vector binary"
PACKED = "first binary, dim int, inside array<int>, near array<int>, cell binary, node binary, n binary, content binary, vector binary"
FOUND = "content binary, node long, links long, first long"


def _units(table: np.ndarray) -> np.ndarray:
    """Rows as doubles of length 1; rows are finite and not zero."""
    table = table.astype(np.float64)
    table /= np.abs(table).max(axis=1, keepdims=True)
    return table / np.sqrt((table * table).sum(axis=1, keepdims=True))


def _usable(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, their vectors as doubles), some MB of vectors of one dimension at a time."""
    lists = batch.column("embedding")
    starts, lengths = lists.offsets.to_numpy()[:-1], np.diff(lists.offsets.to_numpy())
    usable = batch.column("vec_id").is_valid().to_numpy(zero_copy_only=False) & lists.is_valid().to_numpy(zero_copy_only=False)
    nulls = np.concatenate([[0], np.cumsum(lists.values.is_null().to_numpy(zero_copy_only=False))])
    usable &= (lengths > 0) & (nulls[starts + lengths] == nulls[starts])
    values = lists.values.to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths[usable]):
        rows = np.flatnonzero(usable & (lengths == dim))
        most = max(1, (4 << 20) // (8 * int(dim)))
        for low in range(0, len(rows), most):
            part = rows[low : low + most]
            table = values[starts[part][:, None] + np.arange(dim)].astype(np.float64) + 0.0  # -0 counts as 0
            largest = np.abs(table).max(axis=1)
            keep = np.isfinite(largest) & (largest > 0)
            yield part[keep], table[keep]


def _read(whole: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors that can be compared, with a hash of the input; null for others. ``whole``: with the components.

    Components are 32-bit numbers if these are exact, else doubles.
    """
    for batch in batches:
        dims, contents, vectors = ([None] * batch.num_rows for _ in range(3))
        for rows, table in _usable(batch):
            with np.errstate(over="ignore", under="ignore"):
                small = table.astype(np.float32)
            exact = (small == table).all(axis=1)
            for k, row in enumerate(rows.tolist()):
                dims[row], contents[row] = table.shape[1], xxhash.xxh3_128_digest(table[k].tobytes())
                if whole:
                    vectors[row] = (small if exact[k] else table)[k].tobytes()
        columns = [batch.column("vec_id"), pa.array(dims, pa.int32()), pa.array(contents, pa.binary()), pa.array(vectors, pa.binary())]
        yield pa.record_batch(columns, ["vec_id", "dim", "content", "vector"])


def _table(column: pa.Array, dim: int) -> np.ndarray:
    """Rows of components as they were stored; as doubles if any of them are."""
    rows = column.to_pylist()
    if all(len(row) == 4 * dim for row in rows):
        return np.frombuffer(b"".join(rows), np.float32).reshape(-1, dim)
    return np.array([np.frombuffer(row, np.float32 if len(row) == 4 * dim else np.float64) for row in rows], np.float64)


def spherical_kmeans(sample: np.ndarray, count: int) -> np.ndarray:
    """``count`` centres of length 1."""
    centres = sample[np.linspace(0, len(sample) - 1, count).astype(int)].copy()
    for _ in range(ITERATIONS):
        nearest = (sample @ centres.T).argmax(axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        norms = np.linalg.norm(sums, axis=1)
        centres[norms > 0] = sums[norms > 0] / norms[norms > 0, None]
    return centres


def short(unit: np.ndarray, basis: np.ndarray) -> np.ndarray:
    """Rows in the directions of ``basis`` and, last, the length of the rest: products are not less than those of whole rows."""
    part = unit @ basis
    rest = np.maximum(1 - (part.astype(np.float64) ** 2).sum(axis=1), 0) + (unit.shape[1] + 4) * 2.4e-7
    return np.concatenate([part, np.sqrt(rest)[:, None]], axis=1).astype(np.float32)


def screen(sample: np.ndarray, cosine: float) -> np.ndarray | None:
    """Directions for :func:`short`, as many as make the least work on pairs of the sample; None if all are needed."""
    dim, most = sample.shape[1], min(1024, -(-len(sample) // 3))
    basis = np.linalg.svd(sample[:most], full_matrices=False)[2].T
    left, right = sample[most : 2 * most], sample[2 * most : 3 * most]
    best, least = None, float(dim)
    for count in (k for k in (8, 12, 16, 20, 24, 28, 32, 40, 48, 64, 96, 128, 192, 256) if k <= min(basis.shape[1], dim // 2)):
        passing = (short(left, basis[:, :count]) @ short(right, basis[:, :count]).T >= cosine).mean() if len(right) else 0
        if (work := count + 1 + PAIR_WORK * passing) < least:
            best, least = basis[:, :count], work
    return best


class Cells:
    """The centres for one dimension, who is a guest where, and the directions of the screen."""

    def __init__(self, centres: np.ndarray, cosine: float, basis: np.ndarray | None = None):
        self.centres, self.basis = centres, basis
        #: Never less than the distance of two centres: more is compared then, not less.
        self.apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-6))
        self.reach = max(2 - 2 * cosine, 0.0) ** 0.5
        # Half the distance of a pair at the threshold, and a little for rounding.
        self.margin = self.reach / 2 + 1e-7

    def homes(self, table: np.ndarray) -> np.ndarray:
        """The cell of each row: the nearest centre in whole numbers, whose sums are exact and so the same in any batch."""
        scale = 2048
        whole, centres = (np.rint(x * scale).astype(np.float32) for x in (table, self.centres))
        return (whole @ centres.T).argmax(axis=1)

    def places(self, table: np.ndarray, home: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """(home, whether home or guest in each cell); the home is that of the nearest centre if it is not given."""
        near = table @ self.centres.T
        home = near.argmax(axis=1) if home is None else home
        row = np.arange(len(table))
        gap = (near[row, home][:, None] - near) / self.apart[home]
        there = gap <= self.margin
        there[row, home] = True
        return home, there


def _assigned(cells: dict[int, Cells], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Vectors with their cells; copies within a batch are one row with the smallest id."""
    for batch in batches:
        batch = batch.filter(batch.column("content").is_valid())
        rows = pa.table([*batch.select(["dim", "content", "vec_id"]).columns, pa.array(np.arange(batch.num_rows))], ["dim", "content", "vec_id", "row"])
        once = rows.group_by(["dim", "content"]).aggregate([("vec_id", "min"), ("vec_id", "count"), ("row", "min")])
        dims = once.column("dim").to_numpy()
        for dim in np.unique(dims).tolist():
            own = once.filter(pa.array(dims == dim)).combine_chunks()
            most = max(1, (8 << 20) // (8 * dim))
            for low in range(0, own.num_rows, most):
                part = own.slice(low, most).combine_chunks()
                vector = batch.column("vector").take(part.column("row_min").combine_chunks())
                home = np.concatenate([cells[dim].homes(_units(x)) for x in _slices(_table(vector, dim))])
                columns = [pa.array(home, pa.int32()), *(part.column(c).combine_chunks() for c in ("content", "vec_id_min", "vec_id_count"))]
                columns = [pa.array(np.full(len(home), dim), pa.int32()), *columns, vector]
                yield pa.record_batch(columns, ["dim", "cell", "content", "node", "n", "vector"])


def _slices(table: np.ndarray, most: int = 1024) -> Iterator[np.ndarray]:
    for low in range(0, len(table), most):
        yield table[low : low + most]


def _pack(cells: Cells, rows: pa.Table) -> pa.RecordBatch:
    """Rows of one dimension and of distinct contents as one row."""
    rows = rows.sort_by("cell").combine_chunks()
    dim = rows.column("dim")[0].as_py()
    cell = rows.column("cell").to_numpy()
    table = _table(rows.column("vector").combine_chunks(), dim)
    near = np.zeros(len(cells.centres), bool)
    for low in range(0, len(table), 1024):
        near |= cells.places(_units(table[low : low + 1024]), cell[low : low + 1024])[1].any(axis=0)
    contents = rows.column("content").to_pylist()
    numbers = (x.tobytes() for x in (cell, rows.column("node").to_numpy(), rows.column("n").to_numpy()))
    values = [min(contents), dim, np.unique(cell).tolist(), np.flatnonzero(near).tolist(), *numbers, b"".join(contents), table.tobytes()]
    kinds = [pa.binary(), pa.int32(), pa.list_(pa.int32()), pa.list_(pa.int32()), *[pa.binary()] * 5]
    names = ["first", "dim", "inside", "near", "cell", "node", "n", "content", "vector"]
    return pa.record_batch([pa.array([v], k) for v, k in zip(values, kinds)], names)


def _packed(cells: dict[int, Cells], most: dict[int, int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packs of sorted rows, in which copies follow each other, those of the smallest id first."""
    held: list[pa.Table] = []  # of one dimension and of distinct contents
    last = b""

    def out(rows: pa.Table) -> pa.RecordBatch:
        return _pack(cells[rows.column("dim")[0].as_py()], rows)

    for batch in batches:
        contents = np.frombuffer(b"".join([last or bytes(CONTENT_BYTES), *batch.column("content").to_pylist()]), f"V{CONTENT_BYTES}")
        new = contents[1:] != contents[:-1]
        if batch.num_rows and not last:
            new[0] = True
        starts = np.flatnonzero(new)
        n = batch.column("n").to_numpy()
        if len(n) and not new[0]:  # copies of the last row so far
            more = int(n[: starts[0] if len(starts) else len(n)].sum())
            n_at = held[-1].column_names.index("n")
            counts = held[-1].column("n").to_numpy().copy()
            counts[-1] += more
            held[-1] = held[-1].set_column(n_at, "n", pa.array(counts))
        if not len(starts):
            continue
        last = contents[-1].tobytes()
        rows = pa.Table.from_batches([batch.take(pa.array(starts))])
        rows = rows.set_column(rows.column_names.index("n"), "n", pa.array(np.add.reduceat(n, starts)))
        dims = rows.column("dim").to_numpy()
        cuts = [0, *(np.flatnonzero(dims[1:] != dims[:-1]) + 1).tolist(), len(dims)]
        for low, high in zip(cuts, cuts[1:]):
            dim = int(dims[low])
            if held and held[-1].column("dim")[0].as_py() != dim:
                yield out(pa.concat_tables(held))
                held = []
            held.append(rows.slice(low, high - low))
            if sum(h.num_rows for h in held) > most[dim]:  # the last row may have more copies
                every = pa.concat_tables(held)
                while every.num_rows > most[dim]:
                    yield out(every.slice(0, most[dim]))
                    every = every.slice(most[dim])
                held = [every.combine_chunks()]
    if held:
        yield out(pa.concat_tables(held))


def local_components(one: np.ndarray, other: np.ndarray, count: int) -> np.ndarray:
    """For each of ``count`` rows the first row it reaches by links ``(one, other)``."""
    label = np.arange(count)
    while True:
        low = np.minimum(label[one], label[other])
        after = label.copy()
        np.minimum.at(after, label[one], low)
        np.minimum.at(after, label[other], low)
        while True:
            jumped = after[after]
            if (jumped == after).all():
                break
            after = jumped
        if (after == label).all():
            return label
        label = after


class Pack:
    """A pack's rows; those of ``inside[k]`` are ``starts[k]`` to ``starts[k + 1]``."""

    def __init__(self, batch: pa.RecordBatch, which: str, row: int, cells: dict[int, Cells]):
        column = lambda name, kind: np.frombuffer(batch.column(f"{which}_{name}")[row].as_buffer(), kind)
        self.first = batch.column(f"{which}_first")[row].as_py()
        self.dim = batch.column(f"{which}_dim")[row].as_py()
        self.cell, self.node, self.n = column("cell", np.int32), column("node", np.int64), column("n", np.int64)
        self.content = column("content", np.uint8).reshape(-1, CONTENT_BYTES)
        vector = batch.column(f"{which}_vector")[row].as_buffer()
        self.table = np.frombuffer(vector, np.float32 if len(vector) == 4 * self.dim * len(self.n) else np.float64).reshape(-1, self.dim)
        self.unit = np.concatenate([_units(x).astype(np.float32) for x in _slices(self.table)])
        basis = cells[self.dim].basis
        self.short = self.unit if basis is None else np.concatenate([short(x, basis.astype(np.float32)) for x in _slices(self.unit)])
        self.inside, starts = np.unique(self.cell, return_index=True)
        self.starts = [*starts.tolist(), len(self.cell)]

    def gaps(self, cells: Cells, others: np.ndarray) -> np.ndarray:
        """How much nearer each row is to its own centre than to each of ``others``, as products."""
        centres = cells.centres.astype(np.float32)
        own = np.concatenate([(x * centres[self.cell[k * 1024 : k * 1024 + 1024]]).sum(axis=1) for k, x in enumerate(_slices(self.unit))])
        return own[:, None] - self.unit @ centres[others].T


def _hits(flat: np.ndarray) -> np.ndarray:
    """Where ``flat`` is true; eight at a time, as hardly any are."""
    whole = len(flat) // 8 * 8
    words = np.flatnonzero(flat[:whole].view(np.uint64))
    if len(words) * 16 > whole:
        return np.flatnonzero(flat)
    at = (words[:, None] * 8 + np.arange(8)).ravel()
    return np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])


class _Links:
    """Links among the rows of two packs: their numbers by row, and the first row of each group so far."""

    def __init__(self, one: Pack, other: Pack, cosine: float):
        self.one, self.other, self.cosine = one, other, cosine
        self.shift = 0 if one is other else len(one.n)
        self.count = np.zeros(self.shift + len(other.n), np.int64)
        self.label = np.arange(len(self.count))
        #: More than 32-bit products of vectors of length 1 are off.
        self.slack = (one.dim + 4) * 1.2e-7
        self.screened = one.short is not one.unit
        #: Pairs yet to be joined, with their products if these are known.
        self.waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray | None]] = []
        self.pairs = 0

    def products(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Of pairs, one by one."""
        most = max(1, (2 << 20) // (4 * self.one.dim))
        parts = (slice(k, k + most) for k in range(0, len(row), most))
        return np.concatenate([np.einsum("ij,ij->i", self.one.unit[row[at]], self.other.unit[column[at]]) for at in parts])

    def exact(self, row: np.ndarray, column: np.ndarray) -> np.ndarray:
        """Whether pairs reach the threshold in doubles."""
        most = max(1, (8 << 20) // (8 * self.one.dim))
        out = np.zeros(len(row), bool)
        for low in range(0, len(row), most):
            at = slice(low, low + most)
            product = (_units(self.one.table[row[at]]) * _units(self.other.table[column[at]])).sum(axis=1)
            out[at] = product >= self.cosine
        return out

    def meet(self, rows: np.ndarray, columns: np.ndarray, left: np.ndarray, right: np.ndarray, twice: bool) -> None:
        """Compare ``rows`` of one pack with ``columns`` of the other, whose vectors for the screen are given.

        ``twice``: rows are among the columns, where each pair counts once.
        """
        product = left @ right.T
        found = _hits((product >= self.cosine - self.slack).ravel())
        if not len(found):
            return
        known = not self.screened
        if not known and len(found) * PAIR_WORK > product.size * self.one.dim:
            # So many pass that the products of all are less work.
            known, product = True, self.one.unit[rows] @ self.other.unit[columns].T
            found = _hits((product >= self.cosine - self.slack).ravel())
        row, column = np.divmod(found, len(columns))
        row, column = rows[row], columns[column]
        product = product.ravel()[found] if known else None
        if twice:
            once = row < column
            row, column, product = row[once], column[once], product[once] if known else None
        self.waiting.append((row, column, product))
        self.pairs += len(row)
        if self.pairs >= WAITING:
            self.join()

    def join(self) -> None:
        """Count the pairs that wait and join their groups."""
        waiting, self.waiting, self.pairs = [w for w in self.waiting if len(w[0])], [], 0
        for known in (True, False):
            if part := [w for w in waiting if (w[2] is not None) == known]:
                row, column = (np.concatenate([w[k] for w in part]) for k in (0, 1))
                self.add(row, column, np.concatenate([w[2] for w in part]) if known else self.products(row, column))

    def add(self, row: np.ndarray, column: np.ndarray, product: np.ndarray) -> None:
        keep = product >= self.cosine - self.slack
        near = np.flatnonzero(keep & (product < self.cosine + self.slack))
        if len(near):
            keep[near] = self.exact(row[near], column[near])
        row, column = row[keep], column[keep]
        if not len(row):
            return
        # Sums of counts are whole numbers, which doubles hold.
        size = len(self.count)
        self.count += np.bincount(row, self.other.n[column], size).astype(np.int64)
        self.count += np.bincount(column + self.shift, self.one.n[row], size).astype(np.int64)
        one, other = self.label[row], self.label[column + self.shift]
        apart = one != other
        if apart.any():
            ends = np.unique(one[apart] * size + other[apart])
            one, other = np.divmod(ends, size)
            busy = np.unique(np.concatenate([one, other]))
            joined = np.arange(size)
            joined[busy] = busy[local_components(np.searchsorted(busy, one), np.searchsorted(busy, other), len(busy))]
            self.label = joined[self.label]

    def batch(self) -> pa.RecordBatch | None:
        """Per linked row: links to other contents (counting copies), and one link towards its group's first."""
        self.join()
        busy = np.flatnonzero(self.count)
        if not len(busy):
            return None
        both = [self.one] if self.one is self.other else [self.one, self.other]
        node, content = np.concatenate([p.node for p in both]), np.concatenate([p.content for p in both])[busy]
        ends = np.arange(0, content.size + 1, CONTENT_BYTES, dtype=np.int32)
        content = pa.Array.from_buffers(pa.binary(), len(busy), [None, pa.py_buffer(ends), pa.py_buffer(content.tobytes())])
        columns = [content, pa.array(node[busy]), pa.array(self.count[busy]), pa.array(node[self.label[busy]])]
        return pa.record_batch(columns, ["content", "node", "links", "first"])


def _met(one: Pack, other: Pack, cells: Cells, cosine: float, strip: int, block: int) -> _Links:
    """The links between two packs, or within one."""
    links = _Links(one, other, cosine)
    mine, yours = one.gaps(cells, other.inside), other.gaps(cells, one.inside)
    # A pair's distances to the hyperplane between two centres add up to its own distance at most.
    most = cells.reach * cells.apart[np.ix_(one.inside, other.inside)] + 4 * links.slack
    low, beside = np.minimum.reduceat(mine, one.starts[:-1]), np.minimum.reduceat(yours, other.starts[:-1]).T
    for a, b in zip(*(x.tolist() for x in np.nonzero(low + beside <= most))):
        alike = one.inside[a] == other.inside[b]
        if one is other and a > b:
            continue
        rows, columns = np.arange(one.starts[a], one.starts[a + 1]), np.arange(other.starts[b], other.starts[b + 1])
        if not alike:
            gap, across = mine[rows, b], yours[columns, a]
            rows, columns = rows[gap <= most[a, b] - beside[a, b]], columns[across <= most[a, b] - low[a, b]]
            rows, columns = rows[mine[rows, b].argsort()], columns[yours[columns, a].argsort()]
            gap, across = mine[rows, b], yours[columns, a]
        twice = alike and one is other
        left, right = one.short[rows], other.short[columns]
        for k in range(0, len(rows), strip):
            stop = len(columns) if alike else int(np.searchsorted(across, most[a, b] - gap[k], "right"))
            for at in range(k if twice else 0, stop, block):
                end = min(stop, at + block)
                links.meet(rows[k : k + strip], columns[at:end], left[k : k + strip], right[at:end], twice)
    return links


def _linked(cells: dict[int, Cells], cosine: float, strip: int, block: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per pair of packs and vector: links to other contents (counting copies), and one link towards its group's first."""
    one = None
    for batch in batches:
        for row in range(batch.num_rows):
            if one is None or batch.column("one_first")[row].as_py() != one.first:
                one = Pack(batch, "one", row, cells)
            other = one if batch.column("other_first")[row].as_py() == one.first else Pack(batch, "other", row, cells)
            found = _met(one, other, cells[one.dim], cosine, strip, block).batch()
            if found is not None:
                yield found


@contextmanager
def _small_batches(spark: SparkSession) -> Iterator[None]:
    """Within, rows go to Python in batches of about ``BATCH_BYTES``."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def near_duplicates(vectors: DataFrame, cosine: float = 0.9) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``; see the module's text.

    ``n_links``: other vectors at ``cosine`` or more; ``component_id``: smallest vec_id reachable by links.
    ``vectors`` is read several times; only ids and hashes of it are stored besides the packs.
    """
    source = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    every = saved(source.mapInArrow(partial(_read, False), VECTORS).select("vec_id", "dim", "content"), "vectors")
    table = source.mapInArrow(partial(_read, True), VECTORS).where("vector IS NOT NULL")
    rows = every.where("content IS NOT NULL")
    kinds = saved(rows.groupBy("dim", "content").agg(F.min("vec_id").alias("node"), F.count("*").alias("n")), "kinds")

    cells, most, size = {}, {}, 0
    for dim, count in sorted(kinds.groupBy("dim").count().collect()):
        contents = kinds.where(F.col("dim") == dim).orderBy("content").limit(SAMPLE)
        last = contents.agg(F.max("content")).first()[0]
        sample = table.where((F.col("dim") == dim) & (F.col("content") <= F.lit(bytes(last)))).dropDuplicates(["content"])
        sample = sample.orderBy("content").select("vector").toArrow().column("vector").combine_chunks()
        sample = _units(_table(sample, dim))
        centres = max(1, min(count // PER_CELL, CENTRES, len(sample) // 16))
        cells[dim] = Cells(spherical_kmeans(sample, centres), cosine, screen(sample, cosine))
        most[dim] = max(1, min(GUESTS, GUEST_BYTES // (4 * dim), max(1024, -(-count // PACKS))))
        size += count * (4 * dim + 36)
    parts = max(PARTS, -(-size // PART_BYTES), int((4 * vectors.sparkSession.sparkContext.defaultParallelism) ** 0.5))

    # A row for each content and batch is sorted into packs; cells of any size are cut by content.
    order = ["dim", "cell", "content"]
    assigned = table.mapInArrow(partial(_assigned, cells), ASSIGNED).repartitionByRange(*order).sortWithinPartitions(*order, "node")
    packs = assigned.coalesce(max(PARTS, -(-size // FILE_BYTES))).mapInArrow(partial(_packed, cells, most), PACKED)
    packs = saved(packs, "packs").coalesce(parts)
    one, other = (packs.select(*(F.col(c).alias(f"{side}_{c}") for c in packs.columns)) for side in ("one", "other"))
    # One of the two vectors of a link is at most half its length from the border between their cells.
    close = F.arrays_overlap("one_inside", "other_near") | F.arrays_overlap("one_near", "other_inside")
    ahead = F.col("one_first") <= F.col("other_first")
    pairs = one.hint("shuffle_replicate_nl").join(other, ahead & (F.col("one_dim") == F.col("other_dim")) & close)
    pairs = pairs.drop(*(f"{side}_{c}" for side in ("one", "other") for c in ("inside", "near")))
    with _small_batches(vectors.sparkSession):
        found = saved(pairs.mapInArrow(partial(_linked, cells, cosine, STRIP, BLOCK), FOUND), "links")

    copies = rows.join(kinds, ["dim", "content"]).where("vec_id <> node").select(F.col("node").alias("a"), F.col("vec_id").alias("b"))
    links = found.select(F.col("first").alias("a"), F.col("node").alias("b")).union(copies)
    grouped = components(links.where("a <> b")).withColumnsRenamed({"node": "vec_id", "component": "found"})
    beyond = found.groupBy("content").agg(F.sum("links").alias("beyond"))
    counts = (
        rows.join(kinds.select("dim", "content", "n"), ["dim", "content"])
        .join(beyond, "content", "left")
        .select("vec_id", (F.coalesce("beyond", F.lit(0)) + F.col("n") - 1).alias("n_links"))
    )
    rest = every.where("content IS NULL").select("vec_id", F.lit(0).cast("long").alias("n_links"))
    return (
        counts.union(rest)
        .join(grouped, "vec_id", "left")
        .select("vec_id", "n_links", F.coalesce("found", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
    )
