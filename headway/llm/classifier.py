"""A linear text classifier, fitted on a bounded sample of labelled rows."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from headway.llm.common import LETTER_BYTES, slices, text_buffers, word_hashes

# Labelled rows at most that a model is fitted on; the others are not looked
# at. They are those with the least hashes of their ids.
SAMPLE_ROWS = 4000
# Words are hashed to so many buckets, and the most telling are kept.
BUCKETS = 1 << 16
MAX_WORDS = 512
MIN_DOCUMENTS, MIN_SCORE = 4, 4.5
_SHIFT = np.uint64(48)

_CODES = np.arange(256)
_CLASSES = np.stack(
    [
        np.isin(_CODES, list(b"#*$%&<>")),
        _CODES == ord("|"),
        (_CODES >= 48) & (_CODES <= 57),
        (_CODES >= 65) & (_CODES <= 90),
    ]
)
# Shares of byte classes, mean word length, words that repeat the one before,
# distinct words, and the number of words.
MEASURES = len(_CLASSES) + 4


def _features(
    data: np.ndarray, offsets: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(measures, word counts, document of each word, bucket of each word)."""
    hashes, first = word_hashes(data, offsets, LETTER_BYTES)
    rows = len(offsets) - 1
    counts, sizes = np.diff(first), np.diff(offsets)
    measures = np.zeros((rows, MEASURES))
    for i, marks in enumerate(_CLASSES):
        sums = np.concatenate([[0], np.cumsum(marks[data])])
        measures[:, i] = (sums[offsets[1:]] - sums[offsets[:-1]]) / np.maximum(sizes, 1)
    letters = np.concatenate([[0], np.cumsum(LETTER_BYTES[data])])
    some = np.maximum(counts, 1)
    measures[:, -4] = (letters[offsets[1:]] - letters[offsets[:-1]]) / some / 10
    owner = np.repeat(np.arange(rows), counts)
    again = np.zeros(len(hashes), bool)
    again[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    measures[:, -3] = np.bincount(owner, again, rows) / some
    distinct = [len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:])]
    measures[:, -2] = np.array(distinct) / np.sqrt(some) / 10
    measures[:, -1] = np.log1p(counts) / 10
    return measures, counts, owner, (hashes >> _SHIFT).astype(np.int64)


@dataclass
class Model:
    """Weights of the measures and of the chosen words, for each class."""

    mean: np.ndarray
    spread: np.ndarray
    slots: np.ndarray
    weights: np.ndarray

    def inputs(self, measures, owner, buckets) -> np.ndarray:
        """Scaled measures, marks of the chosen words, and a constant."""
        rows, words = len(measures), int(self.slots.max(initial=-1)) + 1
        marks = np.zeros((rows, words))
        slot = self.slots[buckets]
        hit = slot >= 0
        marks[owner[hit], slot[hit]] = 1
        scaled = np.clip((measures - self.mean) / self.spread, -4, 4)
        return np.hstack([scaled, marks, np.ones((rows, 1))])

    def posteriors(self, measures, owner, buckets) -> np.ndarray:
        return _softmax(self.inputs(measures, owner, buckets) @ self.weights)


def _softmax(scores: np.ndarray) -> np.ndarray:
    scores = np.exp(scores - scores.max(axis=1, keepdims=True))
    return scores / scores.sum(axis=1, keepdims=True)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS
) -> DataFrame:
    """(target, text) of at most ``rows`` rows of ``labels(doc_id, target)``.

    The sample is bounded, so it is broadcast to the documents.
    """
    chosen = (
        labels.where("doc_id IS NOT NULL AND target IS NOT NULL")
        .groupBy("doc_id")
        .agg(F.max("target").alias("target"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
    )
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")


def fit(sample: DataFrame, classes: int, rows: int = SAMPLE_ROWS) -> Model:
    """A softmax model of ``sample(target, text)``, targets from 0.

    Executors turn texts into features; the driver gets at most ``rows`` lists
    of buckets. Words are chosen by how much their share of documents differs
    between a class and the rest. A class without rows gets no weight beyond
    its prior, one in ``rows``; without any rows all classes are even.
    """

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(*text_buffers(batch.column(1))):
                measures, counts, owner, buckets = _features(data, offsets)
                ends = np.concatenate([[0], np.cumsum(counts)])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        pa.array(list(measures), pa.list_(pa.float64())),
                        pa.array(
                            [
                                np.unique(buckets[a:b])
                                for a, b in zip(ends[:-1], ends[1:])
                            ],
                            pa.list_(pa.int32()),
                        ),
                    ],
                    ["target", "measures", "buckets"],
                )

    seen = (
        sample.select(F.col("target").cast("int"), F.col("text").cast("string"))
        .mapInArrow(describe, "target int, measures array<double>, buckets array<int>")
        .limit(rows)
        .toArrow()
    )
    # The order in which rows arrive differs between runs.
    held = sorted(
        zip(
            seen["target"].to_pylist(),
            seen["measures"].to_pylist(),
            seen["buckets"].to_pylist(),
        )
    )
    slots = np.full(BUCKETS, -1, np.int64)
    if not held:
        none = np.zeros(MEASURES)
        return Model(none, none + 1, slots, np.zeros((MEASURES + 1, classes)))
    targets = np.array([t for t, _, _ in held])
    measures = np.array([m for _, m, _ in held])
    lengths = [len(b) for _, _, b in held]
    owner = np.repeat(np.arange(len(held)), lengths)
    buckets = np.concatenate([np.array(b, np.int64) for _, _, b in held])
    slots = _telling(targets, owner, buckets, classes)
    model = Model(
        measures.mean(axis=0),
        measures.std(axis=0) + 1e-9,
        slots,
        np.zeros((0, classes)),
    )
    inputs = model.inputs(measures, owner, buckets)
    model.weights = _descend(inputs, np.eye(classes)[targets])
    return model


def _telling(targets, owner, buckets, classes) -> np.ndarray:
    """A slot for each bucket whose share of documents differs by class."""
    total = np.bincount(buckets, minlength=BUCKETS).astype(float)
    score = np.zeros(BUCKETS)
    for k in range(classes):
        inside = targets == k
        n, m = inside.sum(), (~inside).sum()
        if not n or not m:
            continue
        here = np.bincount(buckets[inside[owner]], minlength=BUCKETS)
        share, rest = here / n, (total - here) / m
        pooled = total / (n + m)
        error = np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m)) + 1e-12
        score = np.maximum(score, np.abs(share - rest) / error)
    score[total < MIN_DOCUMENTS] = 0
    best = np.argsort(-score, kind="stable")[:MAX_WORDS]
    best = best[score[best] >= MIN_SCORE]
    slots = np.full(BUCKETS, -1, np.int64)
    slots[best] = np.arange(len(best))
    return slots


def _descend(inputs: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Softmax weights by accelerated gradient descent with a ridge."""
    rows = len(inputs)
    ridge = np.full((inputs.shape[1], 1), 1e-3)
    ridge[-1] = 0
    # Largest curvature, by a few power iterations.
    v = np.ones(inputs.shape[1])
    for _ in range(20):
        v = inputs.T @ (inputs @ v) / rows
        top = np.linalg.norm(v)
        v /= top
    step = 1 / (0.5 * top + ridge.max())
    weights = np.zeros((inputs.shape[1], wanted.shape[1]))
    weights[-1] = np.log((wanted.sum(axis=0) + 1) / (rows + wanted.shape[1]))
    ahead, speed = weights, 1.0
    for _ in range(400):
        gap = inputs.T @ (_softmax(inputs @ ahead) - wanted) / rows
        new = ahead - step * (gap + ridge * ahead)
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        ahead = new + (speed - 1) / faster * (new - weights)
        weights, speed = new, faster
    return weights


def predict(docs: DataFrame, text: str, model: Model) -> DataFrame:
    """``docs`` with ``posteriors``, an array of doubles, and ``n_words``.

    All rows and columns stay; none may have these names. A null text counts
    as empty.
    """
    at = docs.columns.index(text)
    names = docs.columns

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, high, data, offsets in slices(*text_buffers(batch.column(at))):
                measures, counts, owner, buckets = _features(data, offsets)
                found = model.posteriors(measures, owner, buckets)
                yield pa.RecordBatch.from_arrays(
                    [
                        *[c.slice(low, high - low) for c in batch.columns],
                        pa.array(list(found), pa.list_(pa.float64())),
                        pa.array(counts, pa.int64()),
                    ],
                    [*names, "posteriors", "n_words"],
                )

    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("posteriors", T.ArrayType(T.DoubleType())),
            T.StructField("n_words", T.LongType()),
        ]
    )
    return docs.mapInArrow(score, schema)
