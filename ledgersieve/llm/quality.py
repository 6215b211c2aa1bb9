"""Quality by naive Bayes support vectors."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ledgersieve.llm.shared import labelled_sample, scored

SAMPLE_ROWS = 5_000
BYTE_GRAMS = 1 << 16
SHAPE_GRAMS = 1 << 14
SMOOTHING = 1.0
COST = 0.1
EPOCHS = 30
THRESHOLD = 0.3
MIX = np.uint64(0x9E3779B97F4A7C15)


def byte_kinds() -> np.ndarray:
    """0 white space, 1 lower-case letters and bytes of other scripts, 2 upper case, 3 digits, else the byte."""
    kinds = np.arange(256)
    for b in range(256):
        c = bytes([b])
        kinds[b] = 0 if c.isspace() else 1 if c.islower() or b > 127 else 2 if c.isupper() else 3 if c.isdigit() else b
    return kinds.astype(np.uint8)


KINDS = byte_kinds()


def shapes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A hash of each word's shape (its kinds, runs taken once) and whether the word equals the one before."""
    kinds = KINDS[raw]
    edge = np.diff((kinds > 0).astype(np.int8), prepend=0, append=0)
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    if not len(starts):
        return np.zeros(0, np.uint64), np.zeros(0, bool)
    fresh = np.concatenate([[True], kinds[1:] != kinds[:-1]]) & (kinds > 0)
    order = np.cumsum(fresh)
    first = order[starts]
    word = np.repeat(np.arange(len(starts)), ends - starts)
    inside = np.flatnonzero(kinds > 0)
    new = fresh[inside]
    position = (order[inside] - first[word])[new].astype(np.uint64)
    value = (kinds[inside][new].astype(np.uint64) + np.uint64(1)) * (MIX + position * np.uint64(0xD6E8FEB86659FD93))
    value ^= value >> np.uint64(31)
    sums = np.concatenate([[np.uint64(0)], np.cumsum(value, dtype=np.uint64)])
    bounds = np.concatenate([np.searchsorted(np.flatnonzero(new), starts_in(starts, ends)), [len(position)]])
    shape = sums[bounds[1:]] - sums[bounds[:-1]]
    letters = np.concatenate([[np.uint64(0)], np.cumsum(raw.astype(np.uint64) * MIX, dtype=np.uint64)])
    whole = letters[ends] - letters[starts] + (ends - starts).astype(np.uint64)
    return shape, np.concatenate([[False], whole[1:] == whole[:-1]])


def starts_in(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Where each word starts among the bytes of words."""
    return np.concatenate([[0], np.cumsum(ends - starts)[:-1]])


def indicators(text: str | None) -> np.ndarray:
    """Sorted numbers of the n-grams that a whole text has.

    Byte 3-grams, and 1- and 2-grams of word shapes, each with the power of two of its share among the words: a text
    with one odd word and a text of odd words differ. Null, empty and blank texts have no n-grams.
    """
    raw = np.frombuffer((text or "").encode("utf-8", "replace"), np.uint8)
    found = []
    if len(raw) >= 3:
        wide = raw.astype(np.uint32)
        gram = (wide[:-2] << np.uint32(16) | wide[1:-1] << np.uint32(8) | wide[2:]) * np.uint32(0x9E3779B1)
        found.append(np.flatnonzero(np.bincount(gram >> np.uint32(16), minlength=BYTE_GRAMS)))
    shape, again = shapes(raw)
    if len(shape):
        unit = shape * np.uint64(2) + again.astype(np.uint64)
        for k, units in enumerate((unit, unit[:-1] * MIX + unit[1:])):
            kind, count = np.unique(units, return_counts=True)
            level = np.floor(-np.log2(np.maximum(count, 1) / max(1, len(units)))).clip(0, 12).astype(np.uint64)
            number = (kind * MIX + level * np.uint64(0xD6E8FEB86659FD93) + np.uint64(k)) * MIX
            found.append(np.unique((number >> np.uint64(50)).astype(np.int64)) + BYTE_GRAMS)
    return np.unique(np.concatenate(found)) if found else np.zeros(0, np.int64)


@dataclass
class Model:
    """Weights of the scaled indicators, and the line that turns margins into probabilities."""

    weights: np.ndarray
    bias: float
    slope: float
    shift: float


def dual_coordinate_descent(rows: list[np.ndarray], y: np.ndarray, scale: np.ndarray, seed: int = 5) -> tuple[np.ndarray, float]:
    """Hinge-loss support vectors: one dual variable a text, taken in random order; the bias is a constant feature."""
    w, bias = np.zeros(len(scale)), 0.0
    alpha = np.zeros(len(rows))
    values = [scale[r] for r in rows]
    square = np.array([v @ v + 1.0 for v in values])
    rng = np.random.default_rng(seed)
    upper = COST * np.where(y > 0, len(y) / (2 * max(1, (y > 0).sum())), len(y) / (2 * max(1, (y < 0).sum())))
    for _ in range(EPOCHS):
        moved = 0.0
        for i in rng.permutation(len(rows)):
            gradient = y[i] * (w[rows[i]] @ values[i] + bias) - 1
            new = min(max(alpha[i] - gradient / square[i], 0.0), upper[i])
            if new != alpha[i]:
                step = (new - alpha[i]) * y[i]
                w[rows[i]] += step * values[i]
                bias += step
                moved = max(moved, abs(new - alpha[i]))
                alpha[i] = new
        if moved < 1e-4:
            break
    return w, bias


def fit(sample: list[tuple[str, int]]) -> Model:
    """Support vectors on three quarters of a sample, probabilities from the rest.

    Without both labels every score is the label's rate.
    """
    rows = [indicators(text) for text, _ in sample]
    y = np.array([1.0 if label else -1.0 for _, label in sample])
    size = BYTE_GRAMS + SHAPE_GRAMS
    rate = ((y > 0).sum() + 0.5) / (len(y) + 1.0)
    cut = int(0.75 * len(rows))
    head, tail = y[:cut], y[cut:]
    if min((head > 0).sum(), (head < 0).sum(), (tail > 0).sum(), (tail < 0).sum()) == 0:
        return Model(np.zeros(size), 0.0, 0.0, float(np.log(rate / (1 - rate))))
    counts = np.full((2, size), SMOOTHING)
    for row, sign in zip(rows[:cut], head, strict=True):
        counts[int(sign > 0), row] += 1
    ratio = np.log(counts[1] / counts[1].sum()) - np.log(counts[0] / counts[0].sum())
    w, bias = dual_coordinate_descent(rows[:cut], head, ratio)
    weights = w * ratio
    margin = np.array([weights[r].sum() + bias for r in rows[cut:]])
    slope, shift = calibrated(margin, tail > 0)
    return Model(weights, bias, slope, shift)


def calibrated(margin: np.ndarray, good: np.ndarray, steps: int = 100) -> tuple[float, float]:
    """Slope and shift of a logistic curve through held-out margins, by damped Newton steps."""
    x = np.c_[margin, np.ones(len(margin))]
    target = np.where(good, (good.sum() + 1) / (good.sum() + 2), 1 / ((~good).sum() + 2))
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + 1e-6 * np.eye(2), x.T @ (p - target))
        w -= np.clip(step, -2, 2)
    return float(w[0]), float(w[1])


def scorer(model: Model) -> Callable[[], Callable[[list[str | None]], list[pa.Array]]]:
    def score(texts: list[str | None]) -> list[pa.Array]:
        margin = np.array([model.weights[indicators(t)].sum() for t in texts]) + model.bias
        return [pa.array(1 / (1 + np.exp(-np.clip(model.slope * margin + model.shift, -30, 30))))]

    return lambda: score


def fit_quality(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents, chosen by a hash of their ids."""
    return fit(labelled_sample(docs, labels, "quality", rows))


def quality(docs: DataFrame, model: Model, keep_text: bool = True) -> DataFrame:
    """Add ``score`` (0 to 1, higher: label 1 likelier) to every document, from its whole text.

    Null, empty and blank texts have no n-grams and get the score of the bias alone.
    """
    return scored(docs, scorer(model), "score double", keep_text)
