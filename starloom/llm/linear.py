"""Hashed n-gram logistic regression: fitted on a bounded sample, applied in Arrow batches.

A text's features are the hashed word n-grams and byte n-grams that occur in it, each with
the value 1 / sqrt(number of features), so a long text weighs no more than a short one.
Below LEAST_FEATURES the number counts as that many: a few words decide little.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from starloom.llm import textops as t

#: Feature numbers fit two bytes.
BITS = 16
WORD_GRAMS = 2
BYTE_GRAM = 3
LEAST_FEATURES = 400


def gram_hashes(own: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size`` neighbouring values."""
    n = len(own) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    rolled = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        rolled = t.mix(rolled * np.uint64(t.ODD) + own[k : k + n])
    return rolled


def text_features(
    column: pa.Array, word_grams: int = WORD_GRAMS, byte_gram: int = BYTE_GRAM, bits: int = BITS
) -> Iterator[np.ndarray]:
    """The distinct feature numbers of each text, sorted; words and bytes have a half each."""
    data, offsets = t.utf8(column)
    hashes, counts = t.word_hashes(data, offsets, t.LOWER)
    ends = np.cumsum(counts)
    half = np.uint64(1 << (bits - 1))
    shift = np.uint64(65 - bits)
    for k, (end, n) in enumerate(zip(ends.tolist(), counts.tolist())):
        present = np.zeros(1 << bits, dtype=bool)
        for size in range(1, word_grams + 1):
            present[gram_hashes(hashes[end - n : end], size) >> shift] = True
        if byte_gram:
            for at in range(int(offsets[k]), int(offsets[k + 1]), t.PIECE_BYTES):
                piece = data[at : min(at + t.PIECE_BYTES + byte_gram - 1, int(offsets[k + 1]))]
                grams = np.zeros(max(len(piece) - byte_gram + 1, 0), dtype=np.uint64)
                for step in range(byte_gram):
                    grams = grams << np.uint64(8) | piece[step : step + len(grams)]
                present[(t.mix(grams) >> shift) + half] = True
        yield np.flatnonzero(present)


@dataclass
class Linear:
    """Weights, bias, and the calibration (slope, shift) from scores to probabilities."""

    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def score(self, features: np.ndarray) -> float:
        return self.bias + float(self.weights[features].sum()) / max(len(features), LEAST_FEATURES) ** 0.5

    def probability(self, features: np.ndarray) -> float:
        return float(sigmoid(self.slope * self.score(features) + self.shift))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -60, 60)))


class _Parts:
    """Sparse rows in parts of a few hundred, so that temporary arrays stay small."""

    def __init__(self, rows: list[np.ndarray], part: int = 250):
        self.lengths = np.array([len(r) for r in rows], dtype=np.int64)
        self.values = 1 / np.sqrt(np.maximum(self.lengths, LEAST_FEATURES))
        self.parts = [
            (slice(at, at + part), np.concatenate(rows[at : at + part])) for at in range(0, len(rows), part)
        ]

    def scores(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.lengths))
        for rows, index in self.parts:
            sums = np.concatenate(([0.0], np.cumsum(weights[index], dtype=np.float64)))
            ends = np.cumsum(self.lengths[rows])
            out[rows] = (sums[ends] - sums[ends - self.lengths[rows]]) * self.values[rows]
        return out

    def gradient(self, error: np.ndarray, size: int) -> np.ndarray:
        out = np.zeros(size)
        for rows, index in self.parts:
            out += np.bincount(index, np.repeat((error * self.values)[rows], self.lengths[rows]), size)
        return out


def fit(
    rows: list[np.ndarray], labels: np.ndarray, importance: np.ndarray, size: int,
    held_out: np.ndarray, steps: int = 120, rate: float = 0.5, decay: float = 1e-4,
) -> Linear:
    """Weighted logistic regression on soft labels by AdaGrad over the whole sample.

    Rows marked ``held_out`` are left for calibration (all rows, if none is marked).
    ``importance`` is how many rows of the corpus a row stands for; fitting balances the
    two classes, calibration restores their true shares.  Without both classes the model
    gives the share of ones.
    """
    share = float(np.average(labels, weights=importance)) if len(labels) else 0.5
    model = Linear(np.zeros(size), float(np.log((share + 1e-3) / (1 - share + 1e-3))))
    if not len(labels) or labels.max() <= 0.5 or labels.min() > 0.5:
        return model
    train = ~held_out if held_out.any() and (~held_out).any() else np.ones(len(rows), bool)
    ones, zeros = (labels * train).sum(), ((1 - labels) * train).sum()
    balance = np.where(train, labels / max(ones, 1e-9) + (1 - labels) / max(zeros, 1e-9), 0.0) / 2
    model.bias = 0.0
    squares, bias_square = np.full(size, 1e-8), 1e-8
    parts = _Parts(rows)
    for _ in range(steps):
        error = balance * (sigmoid(parts.scores(model.weights) + model.bias) - labels)
        slope = parts.gradient(error, size) + decay * model.weights / size
        squares += slope**2
        bias_square += error.sum() ** 2
        model.weights -= rate * slope / np.sqrt(squares)
        model.bias -= rate * error.sum() / np.sqrt(bias_square)
    model.weights = model.weights.astype(np.float32)
    check = held_out if held_out.any() else train
    scores = parts.scores(model.weights) + model.bias
    model.slope, model.shift = calibrate(scores[check], labels[check], importance[check])
    return model


def calibrate(scores: np.ndarray, labels: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    """Platt's slope and shift: a one-variable logistic regression by Newton steps.

    Labels are drawn in a little from 0 and 1, as Platt has it, so that separable scores
    have a finite slope.
    """
    labels = labels * (1 - 2 / (len(labels) + 2)) + 1 / (len(labels) + 2)
    weight = importance / importance.sum()
    slope, shift = 1.0, 0.0
    for _ in range(50):
        p = sigmoid(slope * scores + shift)
        error, curve = weight * (p - labels), weight * np.maximum(p * (1 - p), 1e-9)
        gradient = np.array([(error * scores).sum(), error.sum()]) + 1e-6 * np.array([slope - 1, shift])
        hessian = np.array(
            [[(curve * scores**2).sum(), (curve * scores).sum()], [(curve * scores).sum(), curve.sum()]]
        ) + 1e-6 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        step *= min(1.0, 2.0 / max(np.abs(step).max(), 1e-12))
        slope, shift = slope - step[0], shift - step[1]
    return (float(slope), float(shift)) if slope > 0 else (1.0, 0.0)


def sample_features(sample: DataFrame) -> tuple[list[np.ndarray], list]:
    """Feature rows of a bounded sample (text, and columns that follow), on the driver."""
    names = sample.columns[1:]
    kinds = ", ".join(f"{c} {sample.schema[c].dataType.simpleString()}" for c in names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            marks = [f.astype("<u2").tobytes() for f in text_features(batch.column(0))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(marks, pa.binary()), *batch.columns[1:]], ["features", *names]
            )

    found = sample.mapInArrow(run, f"features binary, {kinds}").collect()
    found.sort(key=lambda r: (tuple(map(str, r[1:])), r[0]))
    return [np.frombuffer(r[0], "<u2") for r in found], [r[1:] for r in found]
