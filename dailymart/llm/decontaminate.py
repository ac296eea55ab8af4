"""Benchmark decontamination: rare n-gram seeds and Smith-Waterman alignment.

Words are the runs between ASCII white space and punctuation, in lower case. Aligning a document's words with an
item's gives +2 for equal words, -1 for others, for a word left out and for one put in. The best local score over
2 * words of the item is the ``score``; 1 is a literal copy. From ``THRESHOLD`` on, the document is contaminated by the item.

*Seeds* are pairs of an item's words that are neighbours or have one word between them; a document has a seed where the two
words stand in the same order with at most one word between them. No copy at the threshold t of an item of n words is without:
with m equal words and e errors 2m - e >= 2tn, so of the m - 1 steps from one equal word to the next at least
tn - 1 hold at most one error each, and such a step is a seed. They begin at different words of the item, so the seeds that begin at any
tn - 2 of its words may be left out. Those of the words whose seeds stand in most documents are, and what is left are the
item's rare seeds: counted over all documents, chosen per item. Items of fewer than ``SHORT`` words, which a few common words could make
reach the threshold, have runs of ``GRAM`` words as seeds (all their words if they have fewer).

Around its seeds an item is aligned with all words an alignment at the threshold can reach. A stretch that has too few of the
item's words to reach the threshold, were they all in order, is not aligned; it cannot match.

Documents are read twice, to count and to match, and not shuffled; only matches are. Test items go to the tasks in
blocks of at most ``BLOCK_WORDS`` words; the driver holds one block at a time.

Defined cases: null and empty texts, and items without words, match nothing. Null ids are carried along.
Several matches of an item in a document are one row, the best (then first) one. Rows that share an id are
one document (or item); other columns play no part.
"""

from __future__ import annotations

import string
from collections.abc import Iterator
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.llm.store import saved
from dailymart.llm.texts import U64, chunks, gram_hashes, mixed, word_hashes

GRAM = 4
#: Items of fewer words have seeds of their own kind.
SHORT = 8
THRESHOLD = 0.5
BLOCK_WORDS = 1_000_000

_SPACED = bytes(32 if chr(i) in string.punctuation + string.whitespace else i for i in range(256))


def words_of(text: str | None) -> list[bytes]:
    return (text or "").lower().encode().translate(_SPACED).split()


def _pairs(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all pairs of words with at most one between them, and where they begin."""
    turned = mixed(words)
    near = mixed((words[:-1] * _STEP) ^ turned[1:])
    far = mixed((words[:-2] * _STEP) ^ turned[2:])
    return np.concatenate([near, far]), np.concatenate([np.arange(len(near)), np.arange(len(far))])


_STEP = U64(0x9E3779B97F4A7C15)
#: The kind of the pairs, beside the lengths of runs.
PAIRS = 0


class Seeds:
    """Where the seeds of a block of items occur: sorted hashes with item and place, by kind."""

    def __init__(self, texts: list[str | None], threshold: float = THRESHOLD):
        self.threshold = threshold
        self.words = [word_hashes(words_of(t)) for t in texts]
        self.lengths = np.array([len(w) for w in self.words], np.int64)
        self.bags = [np.unique(w, return_counts=True) for w in self.words]
        kinds = np.where(self.lengths >= SHORT, PAIRS, np.minimum(self.lengths, GRAM))
        self.tables = {}
        for kind in sorted({PAIRS if n >= SHORT else min(GRAM, n) for n in self.lengths.tolist()}):
            own = [i for i in np.flatnonzero(kinds == kind) if len(self.words[i])]
            if own:
                found = [self._of(kind, self.words[i]) for i in own]
                item = np.repeat(own, [len(h) for h, _ in found])
                self._keep(kind, np.concatenate([h for h, _ in found]), item, np.concatenate([p for _, p in found]))

    @staticmethod
    def _of(kind: int, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if kind == PAIRS:
            return _pairs(words)
        hashes = gram_hashes(words, kind)
        return hashes, np.arange(len(hashes))

    def _keep(self, kind: int, gram: np.ndarray, item: np.ndarray, place: np.ndarray) -> None:
        order = np.lexsort((place, item, gram))
        present = np.zeros(1 << 22, bool)
        present[gram & U64(len(present) - 1)] = True
        self.tables[kind] = gram[order], item[order], place[order], present

    def counted(self) -> np.ndarray:
        """The different pairs, which are counted in the documents."""
        return np.unique(self.tables[PAIRS][0]) if PAIRS in self.tables else np.empty(0, U64)

    def held(self, words: np.ndarray) -> np.ndarray:
        """Which of the counted pairs a text has."""
        if PAIRS not in self.tables:
            return np.empty(0, U64)
        gram, _, _, present = self.tables[PAIRS]
        own = _pairs(words)[0]
        own = np.unique(own[present[own & U64(len(present) - 1)]])
        at = np.searchsorted(gram, own)
        at[at == len(gram)] = 0
        return own[gram[at] == own]

    def rare(self, pairs: np.ndarray, documents: np.ndarray) -> None:
        """Leave out the most common seeds: of an item of n words those that begin at any ``threshold * n - 2`` of them."""
        if PAIRS not in self.tables:
            return
        gram, item, place, _ = self.tables[PAIRS]
        often = np.zeros(len(gram), np.int64)
        if len(pairs):
            at = np.searchsorted(pairs, gram)
            at[at == len(pairs)] = 0
            often = np.where(pairs[at] == gram, documents[at], 0)
        starts = np.concatenate([[0], np.cumsum(self.lengths)])
        # How many documents have a seed that begins at a word, counted by seed.
        load = np.bincount(starts[item] + place, weights=often, minlength=starts[-1])
        kept = np.ones(starts[-1], bool)
        for i in np.unique(item):
            low, n = starts[i], self.lengths[i]
            spare = int(np.ceil(self.threshold * n - 1e-9)) - 2
            if spare > 0:
                kept[low + np.argsort(-load[low : low + n - 1], kind="stable")[:spare]] = False
        chosen = kept[starts[item] + place]
        self._keep(PAIRS, gram[chosen], item[chosen], place[chosen])

    def common(self, item: int, words: np.ndarray) -> int:
        """How many words of an item are among ``words``, repeated ones as often as in both."""
        own, counts = self.bags[item]
        at = np.searchsorted(own, words)
        at[at == len(own)] = 0
        return int(np.minimum(np.bincount(at[own[at] == words], minlength=len(own)), counts).sum())

    def hits(self, words: np.ndarray) -> tuple[np.ndarray, ...] | None:
        """(item, place in item, place in text) of all seeds in a text."""
        found = []
        for kind, (gram, item, place, present) in self.tables.items():
            own, where = self._of(kind, words)
            at = np.flatnonzero(present[own & U64(len(present) - 1)])
            if not len(at):
                continue
            low = np.searchsorted(gram, own[at], "left")
            many = np.searchsorted(gram, own[at], "right") - low
            at, low, many = at[many > 0], low[many > 0], many[many > 0]
            if len(at):
                index = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
                at = np.repeat(where[at], many)
                found.append((item[index], place[index], at))
        return tuple(np.concatenate(c) for c in zip(*found)) if found else None


def margin(length: np.ndarray) -> np.ndarray:
    """Words a window reaches beyond the item's place on either side.

    An alignment at a threshold of a half or more puts in at most as many words as the item has.
    """
    return length


def align(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each item with its window, and the window's word after its (first) end.

    All pairs go down their items word by word together; the gap along the window is a running maximum.
    """
    count = len(items)
    rows, width = max(map(len, items)), max(map(len, windows))
    grid = np.zeros((count, width), U64)
    inside = np.zeros((count, width), bool)
    for k, w in enumerate(windows):
        grid[k, : len(w)] = w
        inside[k, : len(w)] = True
    slope = np.arange(width, dtype=np.int32)
    above = np.zeros((count, width + 1), np.int32)
    best, end = np.zeros(count, np.int32), np.zeros(count, np.int64)
    for i in range(rows):
        word = np.array([w[i] if i < len(w) else 0 for w in items], U64)
        active = np.array([i < len(w) for w in items])
        equal = (grid == word[:, None]) & inside
        here = np.maximum(np.where(equal, above[:, :-1] + 2, above[:, :-1] - 1), above[:, 1:] - 1)
        here = np.maximum(here, 0)
        here = np.maximum.accumulate(here + slope, axis=1) - slope
        here[~inside | ~active[:, None]] = 0
        above[:, 1:] = here
        at = here.argmax(axis=1)
        top = here[np.arange(count), at]
        better = top > best
        best[better], end[better] = top[better], at[better] + 1
    return best, end


MATCHES = "doc_id long, item_id long, score double, first_word long, last_word long"


def _aligned(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, ...]:
    """(score, first word, word after the last) of the best match of each item in its window."""
    order = sorted(range(len(items)), key=lambda k: (len(windows[k]), len(items[k])))
    scores, begins, ends = np.zeros(len(items)), np.zeros(len(items), np.int64), np.zeros(len(items), np.int64)
    low = 0
    while low < len(order):
        # About a million cells at once, whatever the lengths.
        high = low + 1
        while high < len(order) and high - low < 256 and (high - low) * len(windows[order[high]]) < 1 << 20:
            high += 1
        own = order[low:high]
        best, end = align([items[k] for k in own], [windows[k] for k in own])
        back, length = align([items[k][::-1] for k in own], [windows[k][:e][::-1] for k, e in zip(own, np.maximum(end, 1))])
        for k, score, e, n in zip(own, best, end, length):
            scores[k] = score / (2 * len(items[k]))
            begins[k], ends[k] = e - n, e
        low = high
    return scores, begins, ends


def _windows(seeds: Seeds, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(item, begin, end) of each stretch of touching windows around the seeds of an item."""
    hits = seeds.hits(words)
    if hits is None:
        return
    item, place, at = hits
    order = np.lexsort((at - place, item))
    item, place, at = (x[order] for x in (item, place, at))
    length = seeds.lengths[item]
    reach = margin(length)
    begin, end = np.maximum(at - place - reach, 0), np.minimum(at - place + length + reach, len(words))
    cut = np.concatenate([[True], (item[1:] != item[:-1]) | (begin[1:] > end[:-1])])
    lows = np.flatnonzero(cut)
    for low, high in zip(lows, [*lows[1:], len(item)]):
        yield int(item[low]), int(begin[low]), int(end[low:high].max())


def _found(seeds: Seeds, ids: list[int | None], threshold: float, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The matches of a block of items; equal words around seeds of an item are aligned once in a chunk."""
    for batch in chunks(batches):
        rows: list[tuple] = []
        distinct: dict[tuple[int, bytes], int] = {}
        for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
            words = word_hashes(words_of(text))
            for item, begin, end in _windows(seeds, words):
                window = words[begin:end]
                # Every equal word scores 2 at most: with fewer in common no alignment reaches the threshold.
                if seeds.common(item, window) / len(seeds.words[item]) >= threshold:
                    rows.append((doc, ids[item], begin, distinct.setdefault((item, window.tobytes()), len(distinct))))
        if not rows:
            continue
        scores, begins, ends = _aligned([seeds.words[i] for i, _ in distinct], [np.frombuffer(w, U64) for _, w in distinct])
        docs, items, firsts, pairs = (list(c) for c in zip(*rows))
        pair, first = np.array(pairs), np.array(firsts, np.int64)
        kept = pa.array(scores[pair] >= threshold)
        columns = [pa.array(docs, pa.int64()), pa.array(items, pa.int64()), scores[pair], first + begins[pair], first + ends[pair] - 1]
        yield pa.record_batch([pa.array(c) for c in columns], MATCHES.replace(" long", "").replace(" double", "").split(", ")).filter(kept)


def _blocks(items: DataFrame) -> Iterator[list]:
    """The items in lists of about ``BLOCK_WORDS`` words at most."""
    words = items.select(F.sum(F.octet_length("text"))).first()[0] or 0
    count = -(-words // (2 * BLOCK_WORDS)) or 1
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(count))
    for k in range(count):
        yield items.where(block == k).select("item_id", "text").collect()


def _holding(seeds: Seeds, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many documents of a task have each pair, one row for each that any has."""
    pairs = seeds.counted()
    documents = np.zeros(len(pairs), np.int64)
    for batch in chunks(batches):
        for text in batch.column("text").to_pylist():
            documents[np.searchsorted(pairs, seeds.held(word_hashes(words_of(text))))] += 1
    some = np.flatnonzero(documents)
    yield pa.record_batch([pairs[some].view(np.int64), documents[some]], ["pair", "documents"])


def _documents(texts: DataFrame, seeds: Seeds) -> tuple[np.ndarray, np.ndarray]:
    """The pairs of a block of items with the number of documents that have them."""
    held = texts.mapInArrow(partial(_holding, seeds), "pair long, documents long")
    counts = held.groupBy("pair").agg(F.sum("documents").alias("documents")).toArrow()
    pairs = counts.column("pair").to_numpy().view(U64)
    order = np.argsort(pairs)
    return pairs[order], counts.column("documents").to_numpy()[order]


def matches(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``MATCHES``: the contaminated documents, one row for each with each test item in it.

    ``first_word`` and ``last_word`` are the ends of the aligned stretch, counted in words of the text.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("length(text) > 0")
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text IS NOT NULL")
    items = saved(items.distinct(), "items")
    found = []
    for block in _blocks(items):
        seeds = Seeds([r.text for r in block], threshold)
        seeds.rare(*_documents(texts, seeds))
        # Stored at once: neither the block nor its seeds are kept.
        found.append(saved(texts.mapInArrow(partial(_found, seeds, [r.item_id for r in block], threshold), MATCHES), "matches"))
    scored = reduce(DataFrame.union, found)
    best = F.max(F.struct("score", (-F.col("first_word")).alias("first"), "last_word")).alias("best")
    return (
        scored.groupBy("doc_id", "item_id")
        .agg(best)
        .select("doc_id", "item_id", "best.score", (-F.col("best.first")).alias("first_word"), "best.last_word")
    )


def clean(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` without any contaminated document, all columns as they are.

    Rows with a null doc_id cannot be told apart and stay.
    """
    bad = saved(matches(docs, benchmark, threshold).select("doc_id").distinct(), "contaminated")
    return docs.join(bad, "doc_id", "left_anti").select(*docs.columns)
