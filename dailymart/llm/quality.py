"""Quality classifier from trusted positives and unlabelled text: non-negative unbiased risk.

A text is described by numbers that do not depend on its language or length: how kinds of characters
follow each other (square roots of the shares of all pairs) and how its words repeat. On these a logistic
model minimises

    prior * risk+(positives) + max(0, risk-(unlabelled) - prior * risk-(positives)),

the unbiased risk of learning without negatives, kept from going below zero (where it would,
nothing but the positives' own risk is left). Negatives are never trained on.

The unlabelled side is the whole corpus, the positives are all texts whose label says so and may be learnt from. In each of at
most ``ROUNDS`` rounds every task sums loss and gradient of either over its rows, the sums are added up, and the driver takes one step
(L-BFGS, a shorter one where the risk did not fall). So the model is that of one computer with all rows, however they are dealt to
tasks; the driver gets sums only.

The class prior is estimated from positives and unlabelled text alone, unless it is given: a first model tells one half of
the positives (every other id) from the unlabelled, and of all its thresholds that at least ``SEEN`` of the other half pass, the least ratio of the
share of the unlabelled that passes to that of the other half is the prior. Where hardly any negative passes, all that pass are
positives. A single positive is no half; the prior is then 0.5.

Defined cases: null and empty texts are described by zeros and scored like any other. Labels of null,
ids without a text and texts without a label are fine; ids with both labels count as unlabelled. Without
positives to learn from every score is next to 0 (0.5 without any label). Rows with a null doc_id are scored
and count as not held out. Other columns, lang and source among them, play no part.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dailymart.llm.store import fold, matching, saved
from dailymart.llm.texts import byte_texts, chunks, words_of

ROUNDS = 25
#: Rounds of the first model, which tells positives from unlabelled text.
FIRST_ROUNDS = 10
BATCH = 8192
L2 = 1e-3
#: Share of the positives above a threshold that the prior is estimated at, and bins of scores.
SEEN = 0.5
BINS = 1000

#: Kinds of bytes: bytes of one kind are interchangeable to the classifier.
KINDS = ["abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789", " \t", "\n\r", ".", ",;:", "!?", "%&*$#@+=^~", "|\\/_", "<>()[]{}", "\"'`-"]
_KIND = np.full(256, len(KINDS), np.uint8)  # control characters and bytes beyond ASCII
for _number, _members in enumerate(KINDS):
    _KIND[list(_members.encode())] = _number
_COUNT = len(KINDS) + 1
WORD_FEATURES = 6
FEATURES = _COUNT * _COUNT + WORD_FEATURES


def word_features(text: bytes) -> list[float]:
    """How words repeat: distinct share, commonest share, same word twice running, and their lengths."""
    words = words_of(text)
    if not words:
        return [0.0] * WORD_FEATURES
    n = len(words)
    counts = Counter(words)
    again = sum(a == b for a, b in zip(words, words[1:]))
    long_ = sum(map(len, words)) / n
    # Distinct words grow as a power of all words in prose; in repetitive text they do not.
    return [
        np.log1p(len(counts)) / np.log1p(n),
        max(counts.values()) / n,
        again / n,
        min(long_, 40) / 10,
        len(counts) / n,
        1 / n,
    ]


def describe(texts: list[bytes]) -> np.ndarray:
    """The features of each text, one row each."""
    lengths = np.array([len(t) for t in texts])
    kinds = _KIND[np.frombuffer(b"".join(texts), np.uint8)].astype(np.int64)
    out = np.zeros((len(texts), FEATURES), np.float32)
    if len(kinds) > 1:
        owner = np.repeat(np.arange(len(texts)), lengths)
        pair = (owner[1:] * _COUNT + kinds[:-1]) * _COUNT + kinds[1:]
        pair = pair[owner[1:] == owner[:-1]]
        table = np.bincount(pair, minlength=len(texts) * _COUNT * _COUNT).reshape(len(texts), -1)
        out[:, : _COUNT * _COUNT] = np.sqrt(table / np.maximum(lengths - 1, 1)[:, None])
    out[:, _COUNT * _COUNT :] = [word_features(t) for t in texts]
    return out


def _described(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in chunks(batches):
        table = describe(byte_texts(batch)).astype(np.float16)
        rows = pa.array([r.tobytes() for r in table], pa.binary())
        yield pa.record_batch([batch.column("doc_id"), rows], ["doc_id", "features"])


def described(docs: DataFrame) -> DataFrame:
    """``doc_id, features`` (16-bit floats) of every row."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return rows.mapInArrow(_described, "doc_id long, features binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.float16).reshape(len(column), -1).astype(np.float32)


class Model:
    """Weights, bias, and the centre and scale of the features."""

    def __init__(self, width: int):
        self.weights = np.zeros(width + 1)
        self.centre, self.scale = np.zeros(width), np.ones(width)

    def standard(self, table: np.ndarray) -> np.ndarray:
        return np.hstack([(table - self.centre) / self.scale, np.ones((len(table), 1))])

    def scores(self, table: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.standard(table) @ self.weights, -30, 30)))


def _softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def called_negative(weights: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Number of ``rows``, the summed loss of calling them negative, and its gradient."""
    z = rows @ weights
    return np.array([len(z), _softplus(z).sum(), *(rows.T @ (1 / (1 + np.exp(-np.clip(z, -30, 30)))))])


def risk_of_means(
    weights: np.ndarray, positives: tuple[float, np.ndarray, np.ndarray], unlabelled: tuple[float, np.ndarray], prior: float
) -> tuple[float, np.ndarray]:
    """The non-negative risk with its gradient, from mean loss and gradient of calling rows negative; of positives the mean row too."""
    loss, slope, centre = positives
    # Calling a row positive costs as much as calling it negative, less its z.
    value, gradient = prior * (loss - centre @ weights), prior * (slope - centre)
    negative = unlabelled[0] - prior * loss
    if negative > 0:
        value += negative
        gradient = gradient + unlabelled[1] - prior * slope
    held = np.append(weights[:-1], 0.0)
    return value + L2 / 2 * held @ held, gradient + L2 * held


def risk(weights: np.ndarray, positives: np.ndarray, unlabelled: tuple[float, np.ndarray], prior: float) -> tuple[float, np.ndarray]:
    """:func:`risk_of_means` with the positives as rows."""
    number, loss, *slope = called_negative(weights, positives)
    return risk_of_means(weights, (loss / number, np.array(slope) / number, positives.mean(0)), unlabelled, prior)


def told_apart(
    weights: np.ndarray, positives: tuple[float, np.ndarray, np.ndarray], unlabelled: tuple[float, np.ndarray], _: float
) -> tuple[float, np.ndarray]:
    """The risk of taking unlabelled rows for negatives, both sides weighing the same; see :func:`risk_of_means`."""
    loss, slope, centre = positives
    held = np.append(weights[:-1], 0.0)
    return loss - centre @ weights + unlabelled[0] + L2 / 2 * held @ held, slope - centre + unlabelled[1] + L2 * held


def minimise(start: np.ndarray, evaluate: Callable[[np.ndarray], tuple[float, np.ndarray]], rounds: int, memory: int = 10) -> np.ndarray:
    """L-BFGS with halved steps; every call of ``evaluate`` counts as a round."""
    weights = start
    value, gradient = evaluate(weights)
    steps: list[tuple[np.ndarray, np.ndarray]] = []
    left = rounds - 1
    while left > 0 and np.abs(gradient).max() > 1e-6:
        direction = gradient.copy()
        marks = []
        for s, y in reversed(steps):
            marks.append(s @ direction / (s @ y))
            direction -= marks[-1] * y
        if steps:
            s, y = steps[-1]
            direction *= (s @ y) / (y @ y)
        else:
            direction /= max(1.0, np.abs(gradient).sum())
        for (s, y), mark in zip(steps, reversed(marks)):
            direction += (mark - y @ direction / (s @ y)) * s
        size = 1.0
        while left > 0:
            left -= 1
            trial = weights - size * direction
            after, slope = evaluate(trial)
            if after <= value - 1e-4 * size * gradient @ direction:
                break
            size /= 2
        else:
            return weights
        if (trial - weights) @ (slope - gradient) > 1e-12:
            steps = [*steps, (trial - weights, slope - gradient)][-memory:]
        weights, value, gradient = trial, after, slope
    return weights


def _losses(model: Model, table: np.ndarray) -> np.ndarray:
    return called_negative(model.weights, model.standard(table))


def _bins(model: Model, table: np.ndarray) -> np.ndarray:
    return np.bincount(np.minimum((model.scores(table) * BINS).astype(int), BINS - 1), minlength=BINS).astype(float)


def _moments(table: np.ndarray) -> np.ndarray:
    """Number of rows, totals of the features and of their squares."""
    table = table.astype(np.float64)
    return np.array([len(table), *table.sum(0), *(table**2).sum(0)])


def _summed(of: Callable[[np.ndarray], np.ndarray], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What ``of`` makes of features, added up over a task's rows by kind."""
    totals: dict[int, np.ndarray] = {}
    for batch in batches:
        for low in range(0, batch.num_rows, BATCH):
            part = batch.slice(low, BATCH)
            kinds = part.column("kind").to_numpy()
            for kind in np.unique(kinds).tolist():
                own = part.column("features").filter(pa.array(kinds == kind))
                totals[kind] = totals.get(kind, 0.0) + of(_matrix(own))
    for kind, total in totals.items():
        columns = [np.full(len(total), kind, np.int32), np.arange(len(total), dtype=np.int32), total]
        yield pa.record_batch(columns, ["kind", "index", "value"])


def _sums(rows: DataFrame, of: Callable[[np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """The sum of ``of`` over all ``rows`` (``kind, features``) of each kind."""
    parts = rows.mapInArrow(partial(_summed, of), "kind int, index int, value double")
    sums = parts.groupBy("kind", "index").agg(F.sum("value").alias("value"))
    out: dict[int, list[float]] = {}
    for kind, _, value in sorted(sums.collect()):
        out.setdefault(kind, []).append(value)
    return {kind: np.array(values) for kind, values in out.items()}


def least_ratio(positives: np.ndarray, unlabelled: np.ndarray) -> float:
    """The prior, from how many of either fall into each bin of scores."""
    passed = np.cumsum(positives[::-1]) / positives.sum()
    other = np.cumsum(unlabelled[::-1]) / unlabelled.sum()
    return float(np.clip((other / np.maximum(passed, 1e-9))[passed >= SEEN].min(), 0.0, 1.0))


def _agreed(labels: DataFrame, label: str) -> DataFrame:
    """``doc_id, label`` where all rows of an id agree."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).dropna()
    both = known.groupBy("doc_id").agg(F.min("label").alias("label"), F.max("label").alias("other"))
    return both.where("label = other").select("doc_id", "label")


#: Kinds of rows: all texts, and the positives with an even and with an odd number in the order of ids.
UNLABELLED, EVEN, ODD = range(3)


def _positives(table: DataFrame, chosen: DataFrame) -> tuple[DataFrame, int]:
    """``kind, features`` of the ids in ``chosen`` (stored), one row for each, and their number."""
    # Of rows that share an id the first by their features.
    rows = matching(table, chosen, ["doc_id"]).groupBy("doc_id").agg(F.min("features").alias("features"))
    rows = saved(rows.orderBy("doc_id").select("features", F.monotonically_increasing_id().alias("row")), "positives")
    part, within = F.shiftright("row", 33), F.col("row").bitwiseAND((1 << 33) - 1)
    number, odd = 0, []
    for at, n in sorted(rows.groupBy(part).count().collect()):
        odd += [at] if number % 2 else []
        number += n
    turned = (within + part.isin(odd).cast("long")) % 2
    return rows.select(F.when(turned == 0, EVEN).otherwise(ODD).alias("kind"), "features"), number


def fit(table: DataFrame, labels: DataFrame, prior: float | None = None) -> tuple[Model, float]:
    """The model and the prior from stored features and the labels ``doc_id, label`` to learn from; ``prior`` may be given."""
    stored = saved(labels.join(table.select("doc_id").distinct(), "doc_id", "left_semi"), "labels")
    model = Model(FEATURES)
    known, number = _positives(table, stored.where("label = 1").select("doc_id"))
    if not number:
        # No positive is known: none is expected where there are labels.
        prior = 0.5 if prior is None and stored.isEmpty() else prior or 0.0
        model.weights[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
        return model, prior
    rows = table.select(F.lit(UNLABELLED).alias("kind"), "features").unionByName(known)
    moments = _sums(rows, _moments)
    count, total, square = np.split(moments[UNLABELLED], [1, 1 + FEATURES])
    model.centre = total / count
    model.scale = np.sqrt(np.maximum(square / count - model.centre**2, 1e-6))

    def trained(start: np.ndarray, loss: Callable, kinds: list[int], rounds: int) -> np.ndarray:
        own = rows.where(F.col("kind").isin(UNLABELLED, *kinds))
        count, total, _ = np.split(sum(moments[k] for k in kinds), [1, 1 + FEATURES])
        centre = model.standard(total[None] / count)[0]

        def evaluate(weights: np.ndarray) -> tuple[float, np.ndarray]:
            model.weights = weights
            sums = _sums(own, partial(_losses, model))
            every, positive = (s[1:] / s[0] for s in (sums[UNLABELLED], sum(sums[k] for k in kinds)))
            return loss(weights, (positive[0], positive[1:], centre), (every[0], every[1:]), prior)

        return minimise(start, evaluate, rounds)

    if prior is None and number == 1:
        prior = 0.5
    if prior is None:
        model.weights = trained(np.zeros(FEATURES + 1), told_apart, [EVEN], FIRST_ROUNDS)
        bins = _sums(rows.where(F.col("kind") != EVEN), partial(_bins, model))
        prior = least_ratio(bins[ODD], bins[UNLABELLED])
    start = np.zeros(FEATURES + 1)
    start[-1] = np.log(max(prior, 1e-6) / max(1 - prior, 1e-6))
    model.weights = trained(start, risk_of_means, [EVEN, ODD][:number], ROUNDS)
    return model, prior


def _scored(model: Model, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if batch.num_rows:
            scores = model.scores(_matrix(batch.column("features")))
            yield pa.record_batch([batch.column("doc_id"), scores], ["doc_id", "score"])


def scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, prior: float | None = None) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row; ``labels``: doc_id and quality. ``prior``: see :func:`fit`.

    Rows whose fold is 0 are held out: their labels are not learnt from.
    """
    table = saved(described(docs), "features")
    model, _ = fit(table, _agreed(labels, "quality").where(fold() != 0), prior)
    rows = table.mapInArrow(partial(_scored, model), "doc_id long, score double")
    return rows.select(
        "doc_id",
        F.coalesce(fold() == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns as they are.

    Rows with a null doc_id cannot be told apart and stay; an id with several rows goes only if all are rejected.
    """
    by_id = scores(docs, labels, threshold).groupBy("doc_id").agg(F.max("predicted").alias("predicted"))
    gone = saved(by_id.where("predicted = 0 AND doc_id IS NOT NULL").select("doc_id"), "rejected")
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)
