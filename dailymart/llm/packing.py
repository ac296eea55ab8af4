"""Packing token sequences: a configuration linear program over the length histogram.

Documents become token ids plus one closing id. Longer ones than ``CAPACITY`` are cut into pieces of that
many tokens, the last may be shorter. Which lengths share a sequence is decided on the histogram of lengths
alone, whose size does not depend on the corpus:

* A *configuration* is a multiset of lengths that fits a sequence. The linear program takes as few
  configurations as cover all counts. It is solved by multiplicative weights: a length's price is its
  volume times a weight that falls with the share of its count already covered. For each length short of
  cover, the longest first, a dynamic program over capacities (a knapsack) finds the best configuration
  with it at these prices, among lengths drawn from those that are short of cover too.
* Rounding uses whole multiples of the configurations, then each once more where all its lengths are left
  and hardly any room is lost. What then remains is solved again as a smaller program, and the last few
  lengths by best fit.

Spark numbers the pieces of each length by partial counts and looks their places up in the plan.

Defined cases: null and empty texts are one closing id. Rows are pieces in their own right whatever their
ids, null and repeated ones included. Other columns play no part.
"""

from __future__ import annotations

import string
import unicodedata
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dailymart.llm.store import saved
from dailymart.llm.texts import byte_texts, chunks

CAPACITY = 4096
END = 1
#: Words whose ids a worker remembers (some 200 bytes each); past that it forgets them all.
REMEMBERED = 500_000

#: ASCII punctuation that begins a token of its own behind a letter or digit; an apostrophe may begin "'s".
_TAIL = string.punctuation.replace("'", "").encode()


def _byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies (fixed by that format)."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in shown else next(spare)) for b in range(256)]


_CHARACTERS = _byte_characters()


def _ends_in_letter(word: bytes) -> bool:
    """Whether a word ends in a letter or digit, also once it is normalised: that may end in a mark, which joins punctuation."""
    return unicodedata.normalize("NFC", word.decode()[-1]).lower()[-1].isalnum()


class Words(dict):
    """Ids of words as bytes, remembered.

    The vocabulary joins no text across white space, keeps letters apart from punctuation and ignores the
    case of A-Z, so a text's ids are those of its words in order.
    """

    def __init__(self, path: str):
        super().__init__()
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model

    def __missing__(self, word: bytes) -> bytes:
        core = word.rstrip(_TAIL)
        if core and len(core) < len(word) and _ends_in_letter(core):
            code = self[core] + self[word[len(core) :]]
        else:
            code = self._code(word)
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = code
        return code

    def _code(self, word: bytes) -> bytes:
        text = word.decode()
        if text.isalpha() and text == text.lower() and unicodedata.is_normalized("NFC", text):
            # Letters only: one token group, which the model cuts without looking for groups first.
            tokens = self.model.tokenize("".join([_CHARACTERS[b] for b in word]))
            return array("I", [t.id for t in tokens]).tobytes()
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def encode(self, text: bytes) -> bytes:
        """Ids of a text as little-endian 32-bit numbers."""
        if b"<|" in text:  # may hold a special token, which is found as it is written
            return array("I", self.tokenizer.encode(text.decode(), add_special_tokens=False).ids).tobytes()
        return b"".join(map(self.__getitem__, text.lower().split()))


_tokenizers: dict[str, Words] = {}


def words_for(path: str) -> Words:
    if path not in _tokenizers:
        _tokenizers[path] = Words(path)
    return _tokenizers[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ids binary"


def _tokenized(path: str, capacity: int, end: int, keep: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = words_for(path)
    closing = np.array([end], "<u4").tobytes()
    for batch in chunks(batches):
        rows = []
        for doc, text in zip(batch.column("doc_id").to_pylist(), byte_texts(batch)):
            ids = words.encode(text) + closing
            for number, at in enumerate(range(0, len(ids), 4 * capacity)):
                piece = ids[at : at + 4 * capacity]
                rows.append((doc, number, at // 4, len(piece) // 4, zlib.crc32(piece), piece if keep else None))
        kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        yield pa.record_batch(
            [pa.array(list(c), k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in PIECES.split(", ")]
        )


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, keep: bool = True) -> DataFrame:
    """``PIECES`` of all documents; ``ids``: little-endian 32-bit token ids, null unless ``keep``."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(partial(_tokenized, path, capacity, end, keep), PIECES)


# ---- the plan -------------------------------------------------------------------------------------------


#: Lengths that one dynamic program offers.
OFFERED = 32
#: Tokens of a sequence that a configuration leaves free without another try.
WASTE = 8
#: Sequences from which on a configuration that leaves more free is taken; fewer are left to best fit.
MANY = 32


def knapsack(lengths: np.ndarray, most: np.ndarray, prices: np.ndarray, space: int) -> dict[int, int]:
    """The configuration of highest price that fits ``space``, with at most ``most`` pieces of each length.

    Dynamic program over capacities; multiples are split into powers of two.
    """
    parts = []
    for x, m, price in zip(lengths.tolist(), most.tolist(), prices.tolist()):
        many = 1
        while m > 0 and x * min(many, m) <= space:
            parts.append((x, min(many, m), price * min(many, m)))
            m -= many
            many *= 2
    best = np.zeros(space + 1)
    taken = np.zeros((len(parts), space + 1), bool)
    for k, (x, many, price) in enumerate(parts):
        size = x * many
        with_it = best[: space + 1 - size] + price
        np.greater(with_it, best[size:], out=taken[k, size:])
        best[size:] = np.maximum(with_it, best[size:])
    out: dict[int, int] = {}
    for k in range(len(parts) - 1, -1, -1):
        x, many, _ = parts[k]
        if taken[k, space]:
            out[x] = out.get(x, 0) + many
            space -= x * many
    return out


def fractional(counts: np.ndarray, capacity: int, rounds: int = 8, eta: float = 0.1) -> dict[tuple, float]:
    """Configurations and how often to take them, covering ``counts`` (by length) evenly round by round.

    A round opens its share of each count, in whole pieces: fractions of a piece would be lost in rounding.
    Long lengths come first, as they are the hard ones to place. Each gets the configuration that the
    dynamic program finds best among lengths drawn by what is left of their cover in this round.
    """
    rng = np.random.default_rng(0)
    lengths = np.flatnonzero(counts)
    number = counts[lengths].astype(float)
    place = np.zeros(len(counts), np.int64)
    place[lengths] = np.arange(len(lengths))
    cover = np.zeros(len(lengths))
    volume = lengths / capacity
    taken: dict[tuple, float] = {}
    for turn in range(1, rounds + 1):
        room = np.ceil(number * turn / rounds) - cover
        for k in range(len(lengths) - 1, -1, -1):
            for _ in range(8):
                if room[k] <= 1e-9:
                    break
                space = capacity - int(lengths[k])
                open_ = np.flatnonzero(room[: np.searchsorted(lengths, space, "right")] > 0.05 * room[k])
                if len(open_) > OFFERED:
                    # Spread over the sizes that fit: exact fits need long and short ones.
                    open_ = np.unique(open_[(rng.random(OFFERED) * len(open_)).astype(np.int64)])
                # Multiplicative weights: what is short of cover in this round costs a little more.
                prices = volume[open_] * np.exp(eta * room[open_] / number[open_])
                most = np.maximum(room[open_] / room[k], 1).astype(np.int64)
                config = knapsack(lengths[open_], most, prices, space)
                if space - sum(x * a for x, a in config.items()) > WASTE:
                    # Too few of them to go around: take more of each for fewer sequences.
                    config = knapsack(lengths[open_], np.maximum(room[open_], 1).astype(np.int64), prices, space)
                config[int(lengths[k])] = config.get(int(lengths[k]), 0) + 1
                at = place[list(config)]
                each = np.array(list(config.values()))
                amount = (room[at] / each).min()
                if amount <= 1e-9:
                    break
                cover[at] += each * amount
                room[at] -= each * amount
                key = tuple(sorted(config.items(), reverse=True))
                taken[key] = taken.get(key, 0.0) + amount
    return taken


def best_fit(counts: np.ndarray, capacity: int) -> list[tuple]:
    """Configurations (each once) for the lengths in ``counts``: longest first, each into the fullest place."""
    spaces: list[int] = []
    holders: dict[int, list[dict[int, int]]] = {}
    done: list[dict[int, int]] = []
    for length in np.flatnonzero(counts)[::-1].tolist():
        for _ in range(int(counts[length])):
            at = bisect_left(spaces, length)
            if at < len(spaces):
                space = spaces.pop(at)
                config = holders[space].pop()
            else:
                space, config = capacity, {}
            config[length] = config.get(length, 0) + 1
            if space == length:
                done.append(config)
            else:
                insort(spaces, space - length)
                holders.setdefault(space - length, []).append(config)
    rest = [c for group in holders.values() for c in group]
    return [tuple(sorted(c.items(), reverse=True)) for c in done + rest]


def configurations(counts: np.ndarray, capacity: int) -> list[tuple[tuple, int]]:
    """Configurations and their whole multiples that take up ``counts`` (by length) exactly."""
    left = counts.astype(np.int64).copy()
    plan: list[tuple[tuple, int]] = []
    full = int(left[capacity])
    if full:
        plan.append((((capacity, 1),), full))
        left[capacity] = 0
    while left.sum():
        before = left.sum()
        taken = fractional(left, capacity)
        for whole in (True, False):
            for config, amount in sorted(taken.items(), key=lambda x: (-(x[1] % 1) if not whole else -x[1], x[0])):
                times = min(left[x] // a for x, a in config)
                times = int(min(times, int(amount) if whole else 1))
                # Room is lost only where the program found no better way for many sequences.
                if times and (times >= MANY or sum(x * a for x, a in config) >= capacity - WASTE):
                    plan.append((config, times))
                    for x, a in config:
                        left[x] -= a * times
        if before - left.sum() < before / 4:
            plan += [(config, 1) for config in best_fit(left, capacity)]
            break
    return plan


class Plan:
    """For each length the ranks that go to each configuration, and where."""

    def __init__(self, counts: np.ndarray, capacity: int):
        taken = np.zeros(len(counts), np.int64)
        rows = []
        sequence = 0
        for config, times in configurations(counts, capacity):
            offset = 0
            for length, each in config:
                rows.append((length, taken[length], each, sequence, offset))
                taken[length] += each * times
                offset += length * each
            sequence += times
        self.sequences = sequence
        table = np.array(sorted(rows), np.int64).reshape(-1, 5)
        self.length, self.low, self.each, self.first, self.offset = table.T.copy()
        self.starts = np.searchsorted(self.length, np.arange(len(counts) + 1))

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the ``rank``-th piece of each length."""
        sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
        for x in np.unique(length):
            own = length == x
            a, b = self.starts[x], self.starts[x + 1]
            at = a + np.searchsorted(self.low[a:b], rank[own], "right") - 1
            inside = rank[own] - self.low[at]
            sequence[own] = self.first[at] + inside // self.each[at]
            offset[own] = self.offset[at] + inside % self.each[at] * x
        return sequence, offset


def _placed(plan: Plan, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            sequence, offset = plan.places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            own = batch.drop_columns(["rank"])
            yield pa.record_batch([*own.columns, sequence, offset], [*own.schema.names, "sequence_id", "offset"])


def packed(cut: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``cut`` (pieces with their ``length``, at most ``capacity``) with ``sequence_id`` and ``offset``."""
    rows = saved(cut.withColumn("row", F.monotonically_increasing_id()), "pieces")
    part = F.shiftright("row", 33).alias("part")
    by_part = rows.groupBy("length", part).agg(F.count("*").alias("n"))
    by_part = saved(by_part, "lengths")
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_part.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan = Plan(counts, capacity)
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    base = by_part.select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0).cast("long")).alias("base"))
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("row")) - 1
    ranked = rows.withColumn("part", part).withColumn("within", within).join(base, ["length", "part"])
    ranked = ranked.select(*cut.columns, (F.col("base") + F.col("within")).alias("rank"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in cut.schema)
    return ranked.mapInArrow(partial(_placed, plan), f"{fields}, sequence_id long, offset long")


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``sequence_id, ids array<int>``: the packed sequences themselves, ``capacity`` tokens at most each."""
    placed = packed(pieces(docs, path, capacity, end), capacity)
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts")
    return placed.groupBy("sequence_id").agg(parts).mapInArrow(_joined, "sequence_id long, ids array<int>")


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = [np.frombuffer(b"".join(p["ids"] for p in parts), "<i4") for parts in batch.column("parts").to_pylist()]
        yield pa.record_batch([batch.column("sequence_id"), pa.array(ids, pa.list_(pa.int32()))], ["sequence_id", "ids"])


def placements(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` of every piece."""
    return packed(pieces(docs, path, capacity, end, keep=False).drop("ids"), capacity)
