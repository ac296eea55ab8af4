"""Toxicity classifier with a counterfactual penalty: swapping identity terms shall not change a score.

A text is its distinct words (runs of letters and digits, in lower case), each with the beginnings of
``PREFIXES`` bytes it has, which catch forms of a word not seen before. The log-odds are a bias plus the sum
of the weights of all of these, so a score depends on what a text holds, not on its length.

Words and beginnings are counted by class over a bounded sample of labelled rows (``SAMPLE`` ids of each class
by hash of the id; different texts of an id all count, up to ``3 * SAMPLE`` by hash). Of the ``KEPT`` with the largest
chi-square those get a weight that are linked to the class at a false discovery rate of ``FALSE`` by Fisher's exact test (but at least
``LEAST``, so that few labels still give a model), and all identity terms. Spark counts; what reaches the driver are the kept
features, how often each sampled text has them, and the numbers of its swaps, however long the texts are. The weights minimise logistic loss, an L2 penalty and ``FAIRNESS`` times the mean squared change of the log-odds between
a labelled text and its copies in which an identity term is replaced by the others of its kind and by a
neutral word. A neutral mention of a group therefore cannot carry the score, whatever the labelled rows suggest.

Defined cases: null and empty texts have the score of the bias. Labels of null, ids without a text and texts
without a label are fine; ids with both labels count as unlabelled. With labels of one class or none every
score is the share of that class (0.5 without labels). Rows with a null doc_id are scored and count as not
held out. Rows that repeat an id and text are learnt from once. Other columns, lang and source among them, play no part.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from math import lgamma

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dailymart.llm.quality import _agreed
from dailymart.llm.store import fold, saved
from dailymart.llm.texts import chunks

#: Identity terms by kind; terms in the same place of a kind's tuples are forms of one group.
IDENTITY_TERMS = {
    "gender": [("woman", "women", "female"), ("man", "men", "male"), ("nonbinary",)],
    "religion": [("muslim", "muslims"), ("christian", "christians"), ("jew", "jews", "jewish"), ("hindu", "hindus"), ("buddhist", "buddhists"), ("atheist", "atheists")],
    "orientation": [("gay", "gays"), ("lesbian", "lesbians"), ("straight",), ("bisexual",), ("transgender",)],
    "origin": [("black",), ("white",), ("asian", "asians"), ("african", "africans"), ("european", "europeans"), ("arab", "arabs"), ("latino", "latinos"), ("immigrant", "immigrants"), ("refugee", "refugees")],
    "ability": [("disabled",), ("blind",), ("deaf",), ("autistic",)],
    "age": [("old", "elderly"), ("young",)],
}

#: Stands for any term, in the same forms: a mention shall count no more than none.
NEUTRAL = ("person", "people")

PREFIXES = (4, 5, 6)
SAMPLE = 6000
KEPT = 2048
LEAST = 16
FALSE = 0.1
FAIRNESS = 10.0
L2 = 1e-3
STEPS = 300
RATE = 0.05
#: Features are 24-bit hashes.
SPACE = 1 << 24
#: Words whose weight a worker remembers; past that it forgets them all.
REMEMBERED = 400_000

_WORD = regex.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: str | None) -> set[bytes]:
    return set(_WORD.findall((text or "").lower().encode()))


def features_of(word: bytes) -> list[int]:
    """The word itself and its beginnings, as hashes that tell one from the other."""
    parts = [word + b"$", *(word[:n] for n in PREFIXES if len(word) >= n)]
    return [xxhash.xxh3_64_intdigest(p) % SPACE for p in parts]


def swaps(terms: dict[str, list[tuple]] = IDENTITY_TERMS) -> dict[bytes, list[bytes]]:
    """For each identity term those of the other groups of its kind and a neutral word, in the same form if they have it."""
    out: dict[bytes, list[bytes]] = {}
    for groups in terms.values():
        for group in groups:
            for form, term in enumerate(group):
                others = [other[min(form, len(other) - 1)] for other in [*groups, NEUTRAL] if other is not group]
                out[term.encode()] = [o.encode() for o in others]
    return out


def variants(words: set[bytes], swap: dict[bytes, list[bytes]]) -> list[set[bytes]]:
    """``words`` with each identity term replaced by each of its alternatives."""
    return [words - {term} | {other} for term in sorted(words & swap.keys()) for other in swap[term]]


def _hashes(words: set[bytes]) -> np.ndarray:
    return np.array([f for w in words for f in features_of(w)], "<i4")


def pairs(swap: dict[bytes, list[bytes]]) -> list[tuple[bytes, bytes]]:
    """(term, other) of all swaps."""
    return [(term, other) for term in sorted(swap) for other in swap[term]]


def _swapped(words: set[bytes], swap: dict[bytes, list[bytes]], number: dict[tuple[bytes, bytes], int]) -> list[int]:
    """For each of ``variants`` its pair: 2 * number, and 1 more if the other word is there already."""
    return [2 * number[term, other] + (other in words) for term in sorted(words & swap.keys()) for other in swap[term]]


def _sampled(swap: dict[bytes, list[bytes]], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of labelled rows, and the swaps that lead to their counterfactual copies."""
    number = {pair: k for k, pair in enumerate(pairs(swap))}
    for batch in chunks(batches):
        texts = [words_of(t) for t in batch.column("text").to_pylist()]
        own = pa.array([_hashes(w) for w in texts], pa.list_(pa.int32()))
        swapped = pa.array([np.array(_swapped(w, swap, number), "<i4").tobytes() for w in texts], pa.binary())
        kept = [batch.column(c) for c in ("doc_id", "key", "label")]
        yield pa.record_batch([*kept, own, swapped], ["doc_id", "key", "label", "features", "swapped"])


def _cut(features: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Which of ``features`` each row has, and how often."""
    for batch in batches:
        rows = [np.unique(_places(np.asarray(f, np.int64), features), return_counts=True) for f in batch.column("features").to_pylist()]
        places = pa.array([p.astype("<i2").tobytes() for p, _ in rows], pa.binary())
        times = pa.array([t.astype("<i4").tobytes() for _, t in rows], pa.binary())
        kept = [batch.column(c) for c in ("doc_id", "key", "label", "swapped")]
        yield pa.record_batch([*kept, places, times], ["doc_id", "key", "label", "swapped", "places", "times"])


def _changes(swapped: list[bytes], swap: dict[bytes, list[bytes]], features: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different changes that swaps make to the counts of ``features``, and how often each occurs."""
    kinds, times = np.unique(np.frombuffer(b"".join(swapped), "<i4"), return_counts=True)
    every = pairs(swap)
    gone = [np.array(features_of(every[k // 2][0]), "<i4") for k in kinds]
    come = [np.array([] if k % 2 else features_of(every[k // 2][1]), "<i4") for k in kinds]
    return _dense(come, features) - _dense(gone, features), times


class Model:
    """Bias and weights of the hashed features that have one."""

    def __init__(self, bias: float, features: np.ndarray, weights: np.ndarray):
        self.bias = bias
        self.weights = dict(zip(features.tolist(), weights.tolist()))
        self.known: dict[bytes, float] = {}

    def __getstate__(self):
        return {**self.__dict__, "known": {}}

    def score(self, text: str | None) -> float:
        known, total = self.known, self.bias
        if len(known) > REMEMBERED:
            known.clear()
        for word in words_of(text):
            weight = known.get(word)
            if weight is None:
                weight = known[word] = sum(self.weights.get(f, 0.0) for f in features_of(word))
            total += weight
        return float(1 / (1 + np.exp(-np.clip(total, -30, 30))))


def _counted(rows: DataFrame) -> DataFrame:
    """``feature, a, b``: in how many rows of label 1 and of label 0 each feature occurs, if in three or more."""
    each = rows.select("label", F.explode(F.array_distinct("features")).alias("feature"))
    counted = each.groupBy("feature").agg(F.count_if(F.col("label") == 1).alias("a"), F.count_if(F.col("label") == 0).alias("b"))
    return counted.where("a + b >= 3")


def _chi_square(ones: int, zeros: int) -> Column:
    """Of the table of a feature and the label."""
    a, b = F.col("a").cast("double"), F.col("b").cast("double")
    c, d = ones - a, zeros - b
    across = a * d - b * c
    margins = (a + b) * (c + d) * (a + c) * (b + d)
    return across * across * (a + b + c + d) / F.greatest(margins, F.lit(1e-9))


def exact_p(a: int, b: int, ones: int, zeros: int) -> float:
    """Fisher's exact test (twice the smaller tail): ``a`` of the ``ones`` and ``b`` of the ``zeros`` have the feature."""

    def chance(k: int) -> float:
        rest = a + b - k
        parts = (ones, k, 1), (zeros, rest, 1), (ones + zeros, a + b, -1)
        return np.exp(sum(sign * (lgamma(n + 1) - lgamma(m + 1) - lgamma(n - m + 1)) for n, m, sign in parts))

    above = sum(chance(k) for k in range(a, min(a + b, ones) + 1))
    below = sum(chance(k) for k in range(max(0, a + b - zeros), a + 1))
    return float(min(1.0, 2 * min(above, below)))


def significant(p: np.ndarray, among: int) -> int:
    """How many of the smallest ``p`` may be kept at a false discovery rate of ``FALSE`` out of ``among`` tests."""
    below = np.flatnonzero(np.sort(p) <= FALSE * np.arange(1, len(p) + 1) / max(among, 1))
    return int(below[-1]) + 1 if len(below) else 0


def _chosen(rows: DataFrame, ones: int, zeros: int, always: np.ndarray) -> np.ndarray:
    """The features that tell the classes apart, and ``always``."""
    counted = saved(_counted(rows), "features")
    best = counted.orderBy(_chi_square(ones, zeros).desc(), "feature").limit(KEPT).collect()
    p = np.array([exact_p(r.a, r.b, ones, zeros) for r in best])
    kept = np.argsort(p, kind="stable")[: max(LEAST, significant(p, counted.count()))]
    return np.union1d(np.array([best[k].feature for k in kept], np.int64), always)


def _places(row: np.ndarray, features: np.ndarray) -> np.ndarray:
    """The place in ``features`` of each number of ``row`` that is one of them."""
    at = np.searchsorted(features, row)
    at[at == len(features)] = 0
    return at[features[at] == row]


def _dense(rows: list[np.ndarray], features: np.ndarray) -> np.ndarray:
    """How often each of ``features`` occurs among the words of each row."""
    table = np.zeros((len(rows), len(features)), np.float32)
    for k, row in enumerate(rows):
        np.add.at(table[k], _places(row, features), 1)
    return table


def train(
    table: np.ndarray, labels: np.ndarray, changes: np.ndarray, fairness: float = FAIRNESS, times: np.ndarray | None = None
) -> tuple[float, np.ndarray]:
    """Bias and weights by Adam; ``changes``: features of counterfactual copies less those of their texts, each so many ``times``."""
    table, changes = table.astype(np.float32, copy=False), changes.astype(np.float32, copy=False)
    times = np.ones(len(changes)) if times is None else times
    share = (times / max(times.sum(), 1)).astype(np.float32)
    weights, bias = np.zeros(table.shape[1], np.float32), 0.0
    first, second = np.zeros(len(weights) + 1), np.zeros(len(weights) + 1)
    # Both classes weigh alike, or the rarer one would be missed at the usual threshold.
    weigh = np.where(labels == 1, 0.5 / max((labels == 1).sum(), 1), 0.5 / max((labels == 0).sum(), 1))
    for step in range(1, STEPS + 1):
        p = 1 / (1 + np.exp(-np.clip(table @ weights + bias, -30, 30)))
        wrong = ((p - labels) * weigh).astype(np.float32)
        gradient = table.T @ wrong + L2 * weights
        if len(changes):
            gradient += 2 * fairness * (changes.T @ (share * (changes @ weights)))
        gradient = np.append(gradient, wrong.sum())
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        move = RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
        weights, bias = (weights - move[:-1]).astype(np.float32), float(bias - move[-1])
    return bias, weights


def fit(docs: DataFrame, labels: DataFrame, terms: dict[str, list[tuple]] = IDENTITY_TERMS, fairness: float = FAIRNESS) -> Model:
    """A model from the labels ``doc_id, label`` to learn from."""
    stored = saved(labels.join(docs.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    counts = {r.label: r["count"] for r in stored.groupBy("label").count().collect()}
    none = np.empty(0, np.int64)
    if counts.get(0, 0) == 0 or counts.get(1, 0) == 0:
        share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)
        return Model(float(np.log(share / (1 - share))), none, none)
    by_hash = [F.xxhash64("doc_id"), "doc_id"]
    sample = [stored.where(F.col("label") == c).orderBy(*by_hash).limit(SAMPLE) for c in (0, 1)]
    swap = swaps(terms)
    rows = docs.join(F.broadcast(sample[0].union(sample[1])), "doc_id").withColumn("key", F.xxhash64("text"))
    kinds = "doc_id long, key long, label int"
    found = rows.mapInArrow(partial(_sampled, swap), f"{kinds}, features array<int>, swapped binary")
    found = saved(found.dropDuplicates(["doc_id", "key"]), "sampled")
    # Ids with many texts do not make the sample larger.
    most = found.select("doc_id", "key").orderBy(F.xxhash64("doc_id", "key"), "doc_id", "key").limit(3 * SAMPLE)
    found = found.join(F.broadcast(most), ["doc_id", "key"], "left_semi")
    total = {r.label: r["count"] for r in found.groupBy("label").count().collect()}
    if not total:
        return Model(0.0, none, none)
    identity = np.unique([f for term in swap for f in features_of(term)]).astype(np.int64)
    chosen = _chosen(found, total.get(1, 0), total.get(0, 0), identity)
    cut = found.mapInArrow(partial(_cut, chosen), f"{kinds}, swapped binary, places binary, times binary").toArrow()
    cut = cut.sort_by([("doc_id", "ascending"), ("key", "ascending")])
    table = np.zeros((cut.num_rows, len(chosen)), np.float32)
    for k, (places, times) in enumerate(zip(cut.column("places").to_pylist(), cut.column("times").to_pylist())):
        table[k, np.frombuffer(places, "<i2")] = np.frombuffer(times, "<i4")
    changes, times = _changes(cut.column("swapped").to_pylist(), swap, chosen)
    bias, weights = train(table, cut.column("label").to_numpy(), changes, fairness, times)
    return Model(bias, chosen, weights)


def _scored(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [model.score(t) for t in batch.column("text").to_pylist()]
        yield pa.record_batch([batch.column("doc_id"), pa.array(found, pa.float64())], ["doc_id", "score"])


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``labels``: doc_id and toxic.

    Rows whose fold is 0 are held out: their labels are not learnt from.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    model = fit(rows, _agreed(labels, "toxic").where(fold() != 0))
    return rows.mapInArrow(partial(_scored, model), "doc_id long, score double").select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
