"""Near-duplicate documents: HyperMinHash registers, banding, corrected estimates, exact verification.

A text's words are those between ASCII white space, A-Z in lower case; its set holds the distinct runs of
``size`` words (all words as one run if there are fewer). Each of ``BANDS * ROWS`` buckets keeps the
smallest value of one seeded permutation as leading-zero count (6 bits) and mantissa (10 bits). With
buckets as permutations, not as a partition of the shingles, short texts fill every bucket.

1. Texts with the same set form one class, represented by its smallest doc_id.
2. ``ROWS`` registers in a row make a band; texts sharing a band meet in a bucket. At the threshold 0.8
   a pair misses all 24 bands with probability 3e-6, at 0.85 with 2e-8.
3. In each bucket all compare with one centre, the member that meets most others. Pairs whose estimate
   from all registers, corrected for accidental equality, is six standard errors below the threshold
   stop here (a pair at the threshold with probability 4e-8 at 0.8, 6e-8 at 0.85); the rest is verified
   on full sets.
4. Buckets whose members are then still in several components are compared in full, in blocks of bounded
   size, across components only. No pairs are shuffled: blocks hold registers first, then the full sets
   of the members that passed. So no link between components is lost to the choice of centres.

Defined cases: null, empty and word-free texts have an empty set and are linked with nothing. Rows with a
null doc_id are returned with a null component and kept. Rows that share a doc_id count as one document,
linked by the sets of all its rows. Other columns, whatever their names, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.llm.blocks import BLOCK_KEYS, groups, in_blocks, sorted_blocks
from dailymart.llm.graph import components
from dailymart.llm.store import matching, saved
from dailymart.llm.texts import U64, byte_texts, chunks, gram_hashes, mixed, word_hashes, words_of

BANDS, ROWS = 24, 4
REGISTERS = BANDS * ROWS
MANTISSA_BITS = 10
#: Members of a bucket that one block holds at most.
BLOCK = 1024

_SEEDS = mixed(np.arange(1, REGISTERS + 1, dtype=U64)) | U64(1)
_SHIFTS = mixed(np.arange(1001, REGISTERS + 1001, dtype=U64))

SIGNATURES = "doc_id long, n_shingles long, set_id binary, registers binary, bands array<long>"


def shingle_set(text: bytes, size: int) -> np.ndarray:
    """Sorted distinct shingle hashes of one text."""
    hashes = word_hashes(words_of(text))
    if 0 < len(hashes) < size:
        return gram_hashes(hashes, len(hashes))
    return np.unique(gram_hashes(hashes, size))


def registers_of(flat: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Registers (rows: sets) of sets that lie one after the other in ``flat``; none may be empty.

    The upper bits of a float64 are what a register needs: the exponent counts leading zeros, the first
    mantissa bits follow it.
    """
    out = np.empty((len(starts), REGISTERS), np.uint16)
    for j in range(REGISTERS):
        values = flat * _SEEDS[j]
        values ^= _SHIFTS[j]
        lowest = np.minimum.reduceat(values, starts)
        top = lowest.astype(np.float64).view(U64) >> U64(52 - MANTISSA_BITS)
        zeros = U64(1023 + 64) - np.minimum(top >> U64(MANTISSA_BITS), U64(1023 + 64))
        out[:, j] = (np.minimum(zeros, U64(63)) << U64(MANTISSA_BITS) | top & U64(1023)).astype(np.uint16)
    return out


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band; the band's number is part of it."""
    packed = np.ascontiguousarray(registers).view(U64)
    return mixed(packed ^ mixed(np.arange(1, BANDS + 1, dtype=U64))).view(np.int64)


def _signatures(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        sets = [shingle_set(t, size) for t in byte_texts(batch)]
        lengths = np.array([len(s) for s in sets], np.int64)
        full = np.flatnonzero(lengths)
        registers: list[bytes | None] = [None] * len(sets)
        bands: list[np.ndarray | None] = [None] * len(sets)
        set_ids: list[bytes | None] = [None] * len(sets)
        if len(full):
            starts = np.concatenate([[0], np.cumsum(lengths[full])[:-1]])
            table = registers_of(np.concatenate([sets[i] for i in full]), starts)
            keys = band_keys(table)
            for row, i in enumerate(full):
                registers[i], bands[i] = table[row].tobytes(), keys[row]
                set_ids[i] = xxhash.xxh3_128_digest(sets[i].tobytes())
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                pa.array(lengths),
                pa.array(set_ids, pa.binary()),
                pa.array(registers, pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
            ],
            ["doc_id", "n_shingles", "set_id", "registers", "bands"],
        )


def signatures(docs: DataFrame, size: int = 5) -> DataFrame:
    """``SIGNATURES`` of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_signatures, size), SIGNATURES)


def _accidental() -> np.ndarray:
    """Share of registers that agree by accident for disjoint sets of 2^0 .. 2^40 elements."""
    zeros, mantissa = np.arange(64)[:, None], np.arange(1 << MANTISSA_BITS)[None, :]
    low = 2.0 ** -(zeros + 1.0) * (1 + mantissa / 1024)
    high = low + 2.0 ** -(zeros + 11.0)
    out = []
    for power in range(41):
        n = 2.0**power
        chance = np.exp(n * np.log1p(-low)) - np.exp(n * np.log1p(-np.minimum(high, 1 - 1e-16)))
        out.append(float((chance**2).sum()))
    return np.array(out)


ACCIDENTAL = _accidental()


def estimates(one: np.ndarray, many: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Jaccard similarity of row(s) ``one`` to the rows ``many`` from equal registers, less accidental ones.

    ``n``: size of the smaller set of each pair.
    """
    equal = (one == many).mean(axis=1)
    accident = ACCIDENTAL[np.clip(np.log2(np.maximum(n, 1)).astype(int), 0, 40)]
    return (equal - accident) / (1 - accident)


def lowest_estimate(similarity: float) -> float:
    return similarity - 6 * (similarity * (1 - similarity) / REGISTERS) ** 0.5


def linked(shared: np.ndarray, n_one: np.ndarray, n_other: np.ndarray, percent: int) -> np.ndarray:
    """Exact test: 100 * intersection >= percent * union."""
    return 100 * shared >= percent * (n_one + n_other - shared)


def _matrix(column: pa.Array, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), -1)


def _estimated(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            n = np.minimum(batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy())
            found = estimates(
                _matrix(batch.column("registers_a"), np.uint16), _matrix(batch.column("registers_b"), np.uint16), n
            )
            yield batch.select(["a", "b"]).filter(pa.array(found >= lowest_estimate(percent / 100)))


def _verified(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for one, other in zip(batch.column("set_a").to_pylist(), batch.column("set_b").to_pylist()):
            one, other = np.frombuffer(one, U64), np.frombuffer(other, U64)
            shared = len(np.intersect1d(one, other, assume_unique=True))
            keep.append(bool(linked(shared, len(one), len(other), percent)))
        yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))


def _sets(size: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        found = [shingle_set(t, size).tobytes() for t in byte_texts(batch)]
        yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.binary())], ["doc", "shingles"])


def _sets_of(docs: DataFrame, size: int, needed: DataFrame) -> DataFrame:
    """Full sets ``(doc, shingles)`` of the documents in ``needed(doc_id)``."""
    rows = matching(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), needed, ["doc_id"])
    return saved(rows.mapInArrow(partial(_sets, size), "doc long, shingles binary"), "sets")


def _pairs_of(group: pa.RecordBatch, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each member the later ones that may be linked: other component, other block, sizes, estimate.

    A pair that meets in several buckets counts in the first band it shares only.
    """
    component = group.column("component").to_numpy()
    if (component == component[0]).all():
        return
    n, block = group.column("n_shingles").to_numpy(), group.column("block").to_numpy()
    registers = _matrix(group.column("registers"), np.uint16)
    keys = band_keys(registers)
    band = int(np.flatnonzero(keys[0] == group.column("bucket")[0].as_py())[0])
    values, counts = np.unique(component, return_counts=True)
    common = component == values[counts.argmax()]
    two_blocks = group.column("one")[0].as_py() != group.column("other")[0].as_py()
    rest = np.flatnonzero(~common)
    for i in rest:
        # Members of the most common component have their pairs from the other side.
        others = np.flatnonzero((component != component[i]) & (common | (np.arange(len(n)) > i)))
        if two_blocks:
            others = others[block[others] != block[i]]
        smaller, larger = np.minimum(n[others], n[i]), np.maximum(n[others], n[i])
        others = others[100 * smaller >= percent * larger]
        if len(others):
            first = (keys[others] == keys[i]).argmax(axis=1)
            near = estimates(registers[i], registers[others], np.minimum(n[others], n[i]))
            others = others[(first == band) & (near >= lowest_estimate(percent / 100))]
        if len(others):
            yield int(i), others


def _screened(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for group in groups(batches, BLOCK_KEYS):
        hit = np.zeros(group.num_rows, bool)
        for i, others in _pairs_of(group, percent):
            hit[i] = True
            hit[others] = True
        yield group.select([*BLOCK_KEYS, "block", "doc", "component", "n_shingles", "registers"]).filter(pa.array(hit))


def _compared(percent: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links found on full sets in a block: at most one for each member and component."""
    for group in groups(batches, BLOCK_KEYS):
        docs, component = group.column("doc").to_numpy(), group.column("component").to_numpy()
        n = group.column("n_shingles").to_numpy()
        flat = np.frombuffer(b"".join(group.column("shingles").to_pylist()), U64)
        ends = np.cumsum(n)
        starts = ends - n
        links = set()
        for i, others in _pairs_of(group, percent):
            own = flat[starts[i] : ends[i]]
            pieces = np.concatenate([flat[starts[o] : ends[o]] for o in others])
            at = np.minimum(np.searchsorted(own, pieces), len(own) - 1)
            shared = np.add.reduceat(own[at] == pieces, np.concatenate([[0], np.cumsum(n[others])[:-1]]), dtype=np.int64)
            for o in others[linked(shared, n[others], n[i], percent)]:
                links.add((int(component[i]), int(component[o])))
        yield pa.record_batch(
            [pa.array([x for x, _ in links], pa.int64()), pa.array([x for _, x in links], pa.int64())], ["a", "b"]
        )


def links(docs: DataFrame, signed: DataFrame, size: int, percent: int) -> DataFrame:
    """``(node, component)`` of all documents with links; ``signed``: stored signatures of ``docs``."""
    rows = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = rows.groupBy("set_id").agg(F.min("doc_id").alias("doc"))
    copies = rows.join(classes, "set_id").where("doc_id <> doc").select(F.col("doc").alias("a"), F.col("doc_id").alias("b"))
    # One row per class. A representative with several rows (same id, other text) stays once per set.
    kept = rows.withColumn("doc", F.col("doc_id")).join(classes, ["set_id", "doc"], "left_semi")
    kept = kept.dropDuplicates(["doc", "set_id"])

    met = kept.select(F.explode("bands").alias("bucket"), "doc", "set_id")
    buckets = met.groupBy("bucket").agg(F.count("*").alias("size")).where("size > 1")
    members = saved(met.join(buckets, "bucket"), "members")

    busy = members.groupBy("doc", "set_id").agg(F.sum("size").alias("met"))
    centres = (
        members.join(busy, ["doc", "set_id"])
        .groupBy("bucket")
        .agg(F.max(F.struct("met", (-F.col("doc")).alias("low"), "set_id")).alias("best"))
        .select("bucket", (-F.col("best.low")).alias("centre"), F.col("best.set_id").alias("centre_set"))
    )
    slim = kept.select("doc", "set_id", "n_shingles", "registers")
    tried = (
        members.join(centres, "bucket")
        .where("set_id <> centre_set")
        .select("doc", "set_id", "centre", "centre_set")
        .distinct()
        .join(slim, ["doc", "set_id"])
        .withColumnsRenamed({"doc": "a", "set_id": "s_a", "n_shingles": "n_a", "registers": "registers_a"})
        .withColumnsRenamed({"centre": "doc", "centre_set": "set_id"})
        .join(slim, ["doc", "set_id"])
        .withColumnsRenamed({"doc": "b", "n_shingles": "n_b", "registers": "registers_b"})
        .where(100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
        .select("a", "b", "n_a", "n_b", "registers_a", "registers_b")
        .mapInArrow(partial(_estimated, percent), "a long, b long")
    )
    tried = saved(tried.where("a <> b").distinct(), "tried")
    needed = saved(tried.select("a").union(tried.select("b")).distinct().toDF("doc_id"), "needed")
    sets = _sets_of(docs, size, needed)
    first = (
        tried.join(sets.toDF("a", "set_a"), "a")
        .join(sets.toDF("b", "set_b"), "b")
        .mapInArrow(partial(_verified, percent), "a long, b long")
    )
    first = saved(first.union(copies).distinct(), "first")
    grouped = saved(components(first), "grouped")

    own = F.coalesce("component", "doc").alias("component")
    placed = members.join(grouped.withColumnRenamed("node", "doc"), "doc", "left").select(*members.columns, own)
    mixed_buckets = placed.groupBy("bucket").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y")
    blocks = in_blocks(placed.join(mixed_buckets.select("bucket"), "bucket"), "doc", BLOCK).join(slim, ["doc", "set_id"])
    fields = "bucket long, one int, other int, block int, doc long, component long, n_shingles long, registers binary"
    screened = sorted_blocks(
        blocks.select("bucket", "one", "other", "block", "doc", "component", "n_shingles", "registers")
    ).mapInArrow(partial(_screened, percent), fields)
    screened = saved(screened, "screened")
    if screened.isEmpty():
        return grouped
    needed = saved(screened.select(F.col("doc").alias("doc_id")).distinct(), "needed")
    sets = _sets_of(docs, size, needed)
    full = screened.join(sets, "doc").where(F.octet_length("shingles") == 8 * F.col("n_shingles"))
    second = sorted_blocks(full).mapInArrow(partial(_compared, percent), "a long, b long").distinct()
    return components(first.union(saved(second, "second")))


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``: one row per row of ``docs``; see the module's text.

    Documents are linked if 100 * shared shingles >= ``percent`` * shingles of either.
    """
    signed = saved(signatures(docs, size), "signatures")
    grouped = links(docs, signed, size, percent).withColumnsRenamed({"node": "doc_id", "component": "found"})
    return (
        signed.select("doc_id", "n_shingles")
        .join(grouped, "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("found", "doc_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
    )


def one_of_each(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose document represents its group, all columns as they are."""
    gone = near_duplicates(docs, size, percent).where("NOT kept").select("doc_id").distinct()
    return docs.join(saved(gone, "gone"), "doc_id", "left_anti").select(*docs.columns)
