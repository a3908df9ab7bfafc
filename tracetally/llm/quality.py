"""Quality classifier: support vectors over n-gram indicators scaled by naive Bayes ratios.

1. Each text becomes the set of its n-grams, hashed to FEATURES numbers: words and pairs of words,
   word shapes (letter case, digits and punctuation, runs shortened) and pairs of shapes, and two
   marks: a word that repeats the one before, a line that repeats the one before. A text is cut
   into the fewest equal windows of at most WINDOW bytes, and each number counts by the share of
   windows that have it: in one set of a text of some MB the few n-grams that tell, such as a shape,
   would drown among all words that came up once.
2. Over all labelled rows, the log ratio of each n-gram's smoothed frequency between the classes.
3. On a bounded sample of the labelled rows (``most`` per class, those with the smallest hash of
   their id, and no more than have SAMPLE_FEATURES n-grams), a linear hinge-loss model on the
   indicators times their ratios, fitted by dual coordinate descent in one task, and a logistic
   curve through the margins of a quarter that the fit does not see (of all rows, where a class has
   too few to spare some), weighted as the classes are in all labelled rows.
4. Every text is scored by the model.

Labels, source, language and ids are never features; ids only choose rows.

Defined results: NULL and empty text have no n-gram and get the score of the model's constant; a
row without an id has no label; labels of one id that contradict count as the lowest; without rows
of both classes every score is the share of class 1, or 0.5 without labels; repeated rows get equal
scores; empty tables give empty results; columns called like the result's are replaced.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracetally.llm.common import ship, stored, without

ship(__name__)

#: Numbers that n-grams are hashed to; those of a window set less than a hundredth of them.
BITS = 22
FEATURES = 1 << BITS
#: Labelled rows per class that the hinge-loss model is fitted to, at most.
SAMPLE = 4000
#: Features of the rows that the model is fitted to, in all, at most (some 16 bytes each); beyond it,
#: rows are only taken for a class that has FEWEST at most.
SAMPLE_FEATURES, FEWEST = 20_000_000, 4
#: Labels are broadcast up to this many (some 50 bytes each), beyond that texts are shuffled.
BROADCAST_LABELS = 1_000_000
#: Bytes of a text whose n-grams make one set, at most; pairs across a cut are kept.
WINDOW = 1 << 16
#: Shares are multiples of this, so that their sums are exact in any order.
SHARE = 2.0**-20
#: Rows whose features leave a task together.
ROWS = 1000
EPOCHS, COST, SMOOTHING = 20, 1.0, 1.0
THRESHOLD = 0.3
ADDED = ("score", "predicted")
_SHAPE = bytes(
    65 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else 97 if 97 <= c <= 122 or c >= 128 else c
    for c in range(256)
)


class Model(NamedTuple):
    """Weight of each feature, ratio included; the constant; slope and shift of the curve."""

    weights: np.ndarray
    constant: float
    slope: float
    shift: float

    def scores(self, grams: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
        margins = np.array([_margin(*g, self.weights, self.constant) for g in grams])
        return 1 / (1 + np.exp(-np.clip(self.slope * margins + self.shift, -30, 30)))


def _margin(
    features: np.ndarray, shares: np.ndarray, weights: np.ndarray, constant: float
) -> float:
    return float((weights[features] * shares).sum(dtype=float) / math.sqrt(shares.sum(dtype=float) + 1) + constant)


def _grams(words: list[bytes], salt: int) -> np.ndarray:
    one = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    one ^= np.uint64(salt)
    two = one[:-1] * np.uint64(0x9E3779B97F4A7C15) + (one[1:] ^ (one[1:] >> np.uint64(31)))
    both = np.concatenate([one, two]) * np.uint64(0xBF58476D1CE4E5B9)
    return (both >> np.uint64(64 - BITS)).astype(np.int32)


def _windows(whole: bytes) -> Iterator[bytes]:
    """The text in equal parts of at most WINDOW bytes, cut after white space where there is some."""
    parts = -(-len(whole) // WINDOW)
    start = 0
    for part in range(1, parts + 1):
        stop = len(whole) * part // parts
        if part < parts:
            cut = max(whole.rfind(b" ", start, stop), whole.rfind(b"\n", start, stop)) + 1
            stop = cut or stop
        yield whole[start:stop]
        start = stop


def ngrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """The sorted different features of a text and the share of its windows that have each, in time
    linear in its length."""
    whole = (text or "").encode()
    seen = np.zeros(FEATURES if len(whole) > WINDOW else 0, np.int32)
    found, tail, line, parts = np.empty(0, np.int32), [], None, 0
    for piece in _windows(whole):
        # A word cut in two by a piece's end is two words; the pair across it is kept.
        words = tail + piece.split()
        shape = np.frombuffer(piece.translate(_SHAPE), np.uint8)
        shape = shape[np.concatenate([[True], shape[1:] != shape[:-1]])]
        marks = []
        if any(a == b for a, b in zip(words, words[1:])):
            marks.append(0)
        for now in piece.split(b"\n"):
            if now and now == line:
                marks.append(1)
                break
            line = now or line
        grams = _grams(words, 0x51ED270B), _grams(shape.tobytes().split(), 0x2545F491)
        found = np.unique(np.concatenate([*grams, np.array(marks, np.int32)]))
        if len(seen):
            seen[found] += 1
        tail = words[-1:]
        parts += 1
    if parts < 2:
        return found, np.ones(len(found), np.float32)
    found = np.flatnonzero(seen).astype(np.int32)
    return found, (np.maximum(np.rint(seen[found] / parts / SHARE), 1) * SHARE).astype(np.float32)


def held_out(key: Column) -> Column:
    """One row in five, by CRC-32 of the id as text; these never teach."""
    return F.coalesce(F.crc32(key.cast("string")) % 5 == 0, F.lit(False))


def labelled(docs: DataFrame, labels: DataFrame, key: str, text: str, label: str) -> DataFrame:
    """``id``, ``label``, ``features`` and ``shares`` of the labelled rows that may teach, stored.

    ``shares`` are empty where all are 1, as in a text of one window.
    """

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(at, ROWS) for b in batches for at in range(0, b.num_rows, ROWS)):
            grams = [ngrams(value.as_py()) for value in batch.column(2)]
            features = [f for f, _ in grams]
            shares = [s if (s < 1).any() else [] for _, s in grams]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(features, pa.list_(pa.int32())),
                    pa.array(shares, pa.list_(pa.float32())),
                ],
                ["id", "label", "features", "shares"],
            )

    known = (
        labels.where(F.col(label).isin(0, 1) & ~held_out(F.col(key)))
        .groupBy(F.col(key).alias("id"))
        .agg(F.min(label).cast("int").alias("label"))
    )
    known = F.broadcast(known) if labels.count() <= BROADCAST_LABELS else known.hint("shuffle_hash")
    rows = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).join(known, "id")
    kind = docs.schema[key].dataType.simpleString()
    return stored(
        rows.select("id", "label", "text").mapInArrow(
            extract, f"id {kind}, label int, features array<int>, shares array<float>"
        )
    )


def ratios(rows: DataFrame) -> tuple[DataFrame, list[int]]:
    """Log-count ratio of every feature seen over all ``rows``, and the number of rows per class.

    The ratios stay with Spark, in rows of many ``features`` and their ``ratios``; two sums and two
    counts reach the driver.
    """
    seen = dict(rows.groupBy("label").count().collect())
    totals = [seen.get(0, 0), seen.get(1, 0)]
    whole = rows.where(F.size("shares") == 0).select(
        "label", F.explode("features").alias("feature"), F.lit(1.0).alias("share")
    )
    parts = rows.where(F.size("shares") > 0).select(
        "label", F.inline(F.arrays_zip(F.col("features"), F.col("shares").alias("share")))
    )
    of = [F.when(F.col("label") == label, F.col("share").cast("double")).otherwise(0.0) for label in (0, 1)]
    counted = stored(
        whole.union(parts.toDF("label", "feature", "share"))
        .groupBy("feature")
        .agg((F.sum(of[0]) + SMOOTHING).alias("n0"), (F.sum(of[1]) + SMOOTHING).alias("n1"))
    )
    sums = [float(n or 0) for n in counted.agg(F.sum("n0"), F.sum("n1")).first()]

    def divide(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n0, n1 = (batch.column(at).to_numpy() for at in (1, 2))
            found = np.log((n1 / sums[1]) / (n0 / sums[0])).astype(np.float32)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([batch.column(0).to_numpy()], pa.list_(pa.int32())),
                    pa.array([found], pa.list_(pa.float32())),
                ],
                ["features", "ratios"],
            )

    return counted.select("feature", "n0", "n1").mapInArrow(
        divide, "features array<int>, ratios array<float>"
    ), totals


def dual_coordinate_descent(
    grams: list[tuple[np.ndarray, np.ndarray]], signs: np.ndarray, ratio: np.ndarray
) -> tuple[np.ndarray, float]:
    """Weights (times ratio) and constant that minimise the hinge loss with L2 regularisation.

    Rows are scaled to comparable length; one dual variable at a time moves to its optimum
    between 0 and COST, in a new random order each epoch.
    """
    rows = [row for row, _ in grams]
    values = [ratio[row].astype(float) * shares / math.sqrt(shares.sum(dtype=float) + 1) for row, shares in grams]
    norms = np.array([float(v @ v) + 1 for v in values])
    dual = np.zeros(len(rows))
    weights, constant = np.zeros(FEATURES), 0.0
    random = np.random.default_rng(7)
    for _ in range(EPOCHS):
        largest = 0.0
        for at in random.permutation(len(rows)):
            row, value, sign = rows[at], values[at], signs[at]
            slope = sign * (float(weights[row] @ value) + constant) - 1
            moved = min(max(dual[at] - slope / norms[at], 0.0), COST)
            step = (moved - dual[at]) * sign
            if step:
                weights[row] += step * value
                constant += step
                largest = max(largest, abs(step))
                dual[at] = moved
        if largest < 1e-3:
            break
    return weights * ratio, constant


def logistic_curve(margins: np.ndarray, truth: np.ndarray, weight: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the logistic curve with the largest weighted likelihood, by Newton steps.

    A slight pull towards slope 1 keeps it finite where the margins separate the classes.
    """
    point = np.array([1.0, 0.0])
    design = np.stack([margins, np.ones_like(margins)], axis=1)
    for _ in range(50):
        chance = 1 / (1 + np.exp(-np.clip(design @ point, -30, 30)))
        pull = 1e-2 * (point - [1.0, 0.0])
        slope = design.T @ (weight * (chance - truth)) + pull
        curve = (design * (weight * chance * (1 - chance))[:, None]).T @ design + 1e-2 * np.eye(2)
        step = np.linalg.solve(curve, slope)
        point = point - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return float(point[0]), float(point[1])


def fit(rows: DataFrame, most: int = SAMPLE) -> Model:
    """The model from labelled ``rows`` (``id``, ``label``, ``features``, ``shares``).

    The fit is one task over at most ``2 * most`` rows and the ratios, some 8 bytes each; its result
    is one row with the weights of the features that these rows have.
    """
    ratio_rows, totals = ratios(rows)
    if not min(totals):
        share = totals[1] / sum(totals) if sum(totals) else 0.5
        share = min(max(share, 1e-6), 1 - 1e-6)
        return Model(np.zeros(FEATURES, np.float32), 0.0, 1.0, math.log(share / (1 - share)))

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grams, classes, size, taken = [], [], 0, [0, 0]
        ratio = np.zeros(FEATURES, np.float32)
        for batch in batches:
            for label, features, shares in zip(*batch.columns):
                label = label.as_py()
                if label is None:
                    ratio[np.array(features.values, np.int32)] = np.array(shares.values, np.float32)
                    continue
                size += len(features)
                if size > SAMPLE_FEATURES and taken[label] >= FEWEST:
                    size -= len(features)
                    continue
                taken[label] += 1
                classes.append(label)
                features = np.array(features.values, np.int32)
                # A view of one 1 where all are: no second array for each row.
                ones = np.broadcast_to(np.float32(1), len(features))
                grams.append((features, np.array(shares.values, np.float32) if len(shares) else ones))
        classes = np.array(classes)
        checked = np.arange(len(classes)) % 4 == 3
        if min(len(set(classes[checked])), len(set(classes[~checked]))) < 2:
            checked[:] = True
            fitted = np.flatnonzero(checked)
        else:
            fitted = np.flatnonzero(~checked)
        weights, constant = dual_coordinate_descent(
            [grams[at] for at in fitted], 2.0 * classes[fitted] - 1, ratio
        )
        rest = np.flatnonzero(checked)
        margins = np.array([_margin(*grams[at], weights, constant) for at in rest])
        truth = classes[rest].astype(float)
        here = np.array([(truth == c).sum() for c in (0, 1)])
        weight = np.array(totals) / max(sum(totals), 1) / np.maximum(here / len(rest), 1e-9)
        slope, shift = logistic_curve(margins, truth, weight[classes[rest]])
        used = np.flatnonzero(weights).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([used], pa.list_(pa.int32())),
                pa.array([weights[used].astype(np.float32)], pa.list_(pa.float32())),
                pa.array([[constant, slope, shift]]),
            ],
            ["features", "weights", "rest"],
        )

    order = F.xxhash64(F.col("id").cast("string"))
    chosen = [
        # About twice the rows needed, so that no task sends more on than it must.
        rows.where(F.col("label") == label)
        .where(F.pmod(order, F.lit(1 << 20)) < (1 << 21) * most / totals[label])
        .orderBy(order, "id")
        .limit(most)
        for label in (0, 1)
    ]
    # Sorted by a hash over both classes, so that each fourth row is a fair quarter of each.
    sample = chosen[0].union(chosen[1]).coalesce(1).sortWithinPartitions(order, "id")
    # In the same task as the rows, in any order: they are used when all have been read.
    asked = ratio_rows.select(F.lit(None).cast("int").alias("label"), "features", F.col("ratios").alias("shares"))
    model = (
        sample.select("label", "features", "shares")
        .union(asked)
        .coalesce(1)
        .mapInArrow(train, "features array<int>, weights array<float>, rest array<double>")
        .toArrow()
    )
    features, fitted, rest = (column.combine_chunks().flatten().to_numpy() for column in model.columns)
    weights = np.zeros(FEATURES, np.float32)
    weights[features] = fitted
    return Model(weights, *map(float, rest))


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``score`` (0 to 1, higher: class 1 likelier) and ``predicted`` class.

    Only the text goes to Python and only the score comes back.
    """

    def judge(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores([ngrams(value.as_py()) for value in texts]))

    # Not to be worked out again where a filter or a second column asks for it.
    judged = F.arrow_udf(judge, "double").asNondeterministic()(F.col(text))
    rows = without(docs, *ADDED).withColumn("score", judged)
    return rows.withColumn("predicted", F.when(F.col("score") >= THRESHOLD, 1).otherwise(0))


def classify(
    docs: DataFrame,
    labels: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    label: str = "quality",
    most: int = SAMPLE,
) -> DataFrame:
    """``docs`` with the ``score`` and ``predicted`` label of a model learnt from ``labels``."""
    return score(docs, fit(labelled(docs, labels, key, text, label), most), text)
