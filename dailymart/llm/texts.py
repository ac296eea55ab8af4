"""Bytes and word hashes of texts in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

U64 = np.uint64
CHUNK_BYTES = 4 << 20

_STEP = U64(0x9E3779B97F4A7C15)
_MIX1 = U64(0xBF58476D1CE4E5B9)
_MIX2 = U64(0x94D049BB133111EB)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mix (the splitmix64 finaliser)."""
    x = (x ^ (x >> U64(30))) * _MIX1
    x = (x ^ (x >> U64(27))) * _MIX2
    return x ^ (x >> U64(31))


def byte_texts(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as empty."""
    values = batch.column(column)
    kind = pa.large_binary() if pa.types.is_large_string(values.type) else pa.binary()
    return [v or b"" for v in values.cast(kind).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows in slices of a few MB of text each (a longer single text comes alone)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
        block = np.cumsum(lengths) // CHUNK_BYTES
        cuts = [0, *(np.flatnonzero(np.diff(block)) + 1), batch.num_rows]
        for start, stop in zip(cuts, cuts[1:]):
            yield batch.slice(start, stop - start)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z in lower case; other bytes stay as they are."""
    return text.lower().split()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), dtype=U64, count=len(words))


def gram_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """A hash for each run of ``size`` words, in order."""
    count = len(words) - size + 1
    if count <= 0:
        return np.empty(0, U64)
    total = np.full(count, U64(size))
    for i in range(size):
        total = total * _STEP + words[i : i + count]
    return mixed(total)
