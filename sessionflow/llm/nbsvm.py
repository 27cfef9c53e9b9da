"""Quality classifier: Naive Bayes support vectors over n-gram indicators.

Features are indicators of word 1-grams and 2-grams (letters lowered) and of shapes of words, which tell how
words are written (capitals, digits, signs, repeated words, length), hashed into 2^18 places. Each
is scaled by its class log-count ratio; a linear hinge-loss model over the scaled indicators is fitted by dual
coordinate descent, each class weighing the same. Scores are probabilities: a logistic curve fitted to
the margins of labelled training rows that the weights were not fitted on.

The log-count ratios are counted over all labelled training rows, in Spark. Weights are fitted on at most
SAMPLE rows of each label, and the curve on at most HELD of each, those with the least hashes of
text; both are parameters. Training rows are those with crc32(doc_id) mod 4 other than 2; labels of the
rest are never read. The score uses the text alone.

NULL text is empty; a text without words has the score that the bias and the shape features give.
NULL doc_id counts as the empty text in the split and has no label. Label rows with NULL quality are ignored;
of several labels of a document the least counts. Repeated rows are scored each.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .hashing import SPACE, Words, mixed, words_of
from .store import stored

FOLDS, HELD_OUT = 4, 2
BITS = 18
SAMPLE, HELD = 2000, 1000
EPOCHS, PENALTY = 12, 0.1
CUTOFF = 0.7


def held_out(doc_id: Column) -> Column:
    name = F.coalesce(doc_id.cast("long").cast("string"), F.lit(""))
    return F.crc32(name) % FOLDS == HELD_OUT


# --- features -------------------------------------------------------------------------------


def shapes(w: Words) -> np.ndarray:
    """Shape of each word as a small number: first byte's kind, all capitals, signs, digits, length."""
    kind = KIND[w.data]
    upto = np.zeros((4, len(kind) + 1), np.int32)
    for k in range(4):
        np.cumsum(kind == k, out=upto[k, 1:])
    capital, small, digit, sign = (upto[:, w.ends] - upto[:, w.starts]).astype(np.int64)
    length = w.ends - w.starts
    shape = (capital > 1) & (small == 0)
    shape = shape + 2 * (capital == 1) + 4 * np.minimum(sign, 3) + 16 * (digit > 0)
    return shape + 32 * np.minimum(length // 4, 7)


KIND = np.full(256, 1, np.int8)
KIND[ord("A") : ord("Z") + 1] = 0
KIND[ord("0") : ord("9") + 1] = 2
KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 3


def indicators(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row in the slice, feature) pairs without repetitions, and where each row's pairs begin."""
    size = 1 << BITS
    low = texts.cast(pa.large_binary())
    for plain, w in zip(words_of(low, SPACE, False), words_of(low, SPACE, True)):
        n = len(w.first) - 1
        text = np.repeat(np.arange(n), np.diff(w.first))
        second = (text[1:] == text[:-1]) if len(text) else np.empty(0, bool)
        pair = mixed(w.hashes[:-1] * np.uint64(3) ^ w.hashes[1:])[second]
        again = (w.hashes[1:] == w.hashes[:-1]) & second if len(text) else second
        shape = shapes(plain)
        # how many words of a text have a shape, in powers of two of their share
        table = np.bincount(text * 257 + np.minimum(shape, 255), minlength=n * 257)
        table = table.reshape(n, 257)
        table[:, 256] = np.bincount(text[1:][again], minlength=n)
        words = np.maximum(np.diff(w.first), 1)[:, None]
        share = np.where(table > 0, 8 + np.floor(np.log2(np.maximum(table, 1) / words)), -1)
        row, column = np.nonzero(share >= 0)
        made = mixed((np.uint64(1 << 40) + (column * 16 + share[row, column]).astype(np.uint64)))
        pairs = np.concatenate(
            [
                text * size + (w.hashes & np.uint64(size - 1)).astype(np.int64),
                text[1:][second] * size + (pair & np.uint64(size - 1)).astype(np.int64),
                row * size + (made & np.uint64(size - 1)).astype(np.int64),
            ]
        )
        pairs = np.unique(pairs)
        yield pairs & (size - 1), np.searchsorted(pairs, np.arange(n + 1) * size)


# --- training -------------------------------------------------------------------------------


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def margins(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Decision value of each row: the mean of its weights, over the root of its size."""
        total = np.concatenate([[0.0], np.cumsum(self.weights[features])])
        size = np.diff(first)
        return (total[first[1:]] - total[first[:-1]]) / np.sqrt(np.maximum(size, 1)) + self.bias

    def scores(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        value = self.slope * self.margins(features, first) + self.shift
        return 1 / (1 + np.exp(-np.clip(value, -500, 500)))


def log_count_ratios(counts: np.ndarray) -> np.ndarray:
    """log of the smoothed share of each feature among label 1 over that among label 0."""
    p = (counts + 1) / (counts + 1).sum(axis=1, keepdims=True)
    return np.log(p[1] / p[0])


def dual_coordinate_descent(
    rows: list[np.ndarray], labels: np.ndarray, ratios: np.ndarray, seed: int = 0
) -> tuple[np.ndarray, float]:
    """Weights (times ratios) and bias of the L2-regularised hinge loss; x is ratios / sqrt(size)."""
    y = np.where(labels > 0, 1.0, -1.0)
    share = np.array([(labels == k).mean() for k in (0, 1)])
    upper = PENALTY * 0.5 / np.maximum(share, 1e-9)[labels]
    values = [ratios[f] / np.sqrt(max(1, len(f))) for f in rows]
    norm = np.array([float(v @ v) + 1.0 for v in values])
    alpha, weights, bias = np.zeros(len(rows)), np.zeros(len(ratios)), 0.0
    rng = np.random.default_rng(seed)
    for _ in range(EPOCHS):
        for i in rng.permutation(len(rows)):
            f, x = rows[i], values[i]
            gradient = y[i] * (weights[f] @ x + bias) - 1
            new = min(max(alpha[i] - gradient / norm[i], 0.0), upper[i])
            change = (new - alpha[i]) * y[i]
            if change:
                weights[f] += change * x
                bias += change
                alpha[i] = new
    return weights * ratios, bias


def logistic_curve(margin: np.ndarray, labels: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve, with softened targets (Platt)."""
    n1, n0 = (labels == 1).sum(), (labels == 0).sum()
    target = np.where(labels == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -500, 500)))
        w, e = p * (1 - p), target - p
        h = np.array(
            [[(w * margin * margin).sum() + 1e-3, (w * margin).sum()], [(w * margin).sum(), w.sum() + 1e-3]]
        )
        da, db = np.linalg.solve(h, [(e * margin).sum() - 1e-3 * a, e.sum() - 1e-3 * b])
        a, b = a + np.clip(da, -2, 2), b + np.clip(db, -2, 2)
    return max(float(a), 1e-3), float(b)


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(text, label) of the labelled training rows. The join shuffles at every size: labels grow with
    the documents, so they are never broadcast."""
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
        .where(~held_out(F.col("doc_id")))
        .groupBy(F.col("doc_id").cast("long").alias("labelled_id"))
        .agg(F.min("quality").cast("int").alias("label"))
    )
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string").alias("text"))
    rows = rows.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    same = F.col("doc_id") == F.col("labelled_id")
    return rows.join(known.hint("shuffle_merge"), same).select("text", "label")


def feature_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Features of each row, with its label and a number fixed by the features."""
    for batch in batches:
        labels, at = batch["label"].to_numpy(), 0
        for features, first in indicators(batch["text"]):
            n = len(first) - 1
            lists = pa.ListArray.from_arrays(
                pa.array(first.astype(np.int32)), pa.array(features.astype(np.int32))
            )
            total = np.concatenate(
                [[0], np.cumsum(mixed(features.astype(np.uint64)).view(np.int64))]
            )
            order = mixed((total[first[1:]] - total[first[:-1]]).view(np.uint64)).view(np.int64)
            yield pa.record_batch(
                [pa.array(labels[at : at + n], pa.int32()), pa.array(order), lists],
                names=["label", "place", "features"],
            )
            at += n


def feature_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros((2, 1 << BITS), np.int64)
    for batch in batches:
        label = batch["label"].to_numpy()
        lists = batch["features"]
        own = np.repeat(label, lists.value_lengths().to_numpy())
        for k in (0, 1):
            counts[k] += np.bincount(lists.flatten().to_numpy()[own == k], minlength=1 << BITS)
    use = np.flatnonzero(counts.any(axis=0))
    yield pa.record_batch(
        [pa.array(use, pa.int32()), pa.array(counts[0, use]), pa.array(counts[1, use])],
        names=["feature", "n0", "n1"],
    )


def trained(docs: DataFrame, labels: DataFrame) -> Model:
    """The classifier from all counts and the bounded samples."""
    rows = stored(
        labelled(docs, labels).mapInArrow(
            feature_rows, "label int, place long, features array<int>"
        ),
        "labelled-features",
    )
    counted = (
        rows.where("label in (0, 1)")
        .mapInArrow(feature_counts, "feature int, n0 long, n1 long")
        .groupBy("feature")
        .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
        .toArrow()  # at most 2^18 rows
    )
    counts = np.zeros((2, 1 << BITS))
    feature = counted["feature"].to_numpy()
    counts[0, feature], counts[1, feature] = counted["n0"].to_numpy(), counted["n1"].to_numpy()
    ratios = log_count_ratios(counts)
    taken, held, y, z = [], [], [], []
    for label in (0, 1):
        features = sampled(rows.where(F.col("label") == label), SAMPLE + HELD)
        for k, f in enumerate(features):  # every third for the curve
            (held if k % 3 == 2 else taken).append(f)
            (z if k % 3 == 2 else y).append(label)
    y, z = np.array(y, np.int64), np.array(z, np.int64)
    if len(set(y.tolist())) < 2:  # nothing to tell apart
        return Model(np.zeros(1 << BITS), 0.0, 1.0, 2.0 if 1 in y else -2.0 if 0 in y else 0.0)
    model = Model(*dual_coordinate_descent(taken, y, ratios))
    if len(set(z.tolist())) == 2:
        first = np.concatenate([[0], np.cumsum([len(f) for f in held])])
        model.slope, model.shift = logistic_curve(
            model.margins(np.concatenate(held), first), z
        )
    return model


def sampled(rows: DataFrame, size: int) -> list[np.ndarray]:
    """Features of about ``size`` different rows with the least places, never more than twice as many.

    Places are hashes, so a limit on them leaves about that many; only rows below it are compared
    or leave their tasks. Copies have one place and count once.
    """
    n = rows.agg(F.approx_count_distinct("place", 0.02)).head()[0] or 0
    if n > size:
        rows = rows.where(F.col("place") < F.lit(-(1 << 63) + (1 << 64) * size // n))
    some = rows.groupBy("place").agg(F.first("features").alias("features")).limit(2 * size)
    return [np.array(r["features"], np.int64) for r in sorted(some.collect())]


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    broadcast = docs.sparkSession.sparkContext.broadcast(model)

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = broadcast.value
        for batch in batches:
            scores = [fitted.scores(*x) for x in indicators(batch["text"])]
            scores = np.concatenate(scores) if scores else np.empty(0)
            yield pa.record_batch(
                [
                    batch["doc_id"],
                    batch["held_out"],
                    pa.array(scores),
                    pa.array((scores >= CUTOFF).astype(np.int32)),
                ],
                names=["doc_id", "held_out", "score", "predicted"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long"),
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(
        of_batches, "doc_id long, held_out boolean, score double, predicted int"
    )
