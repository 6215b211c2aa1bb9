"""Language identification with error-correcting output codes."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.shared import scored, training_text, written

BUCKETS = 8192
ORDERS = (1, 2, 3)
SAMPLE_PER_LANGUAGE = 500
SAMPLE_ROWS = 4_000
MAX_TRAINING_BYTES = 32_768
SNIPPETS = (40, 120)
#: Rows of the training matrix that are dense at a time.
DENSE_ROWS = 512
AMBIGUOUS_MARGIN = 1.0
UNDETERMINED = "und"
LANGUAGE_COLUMNS = (("lang_pred", "string"), ("score", "double"), ("ambiguous", "boolean"))


@dataclass
class Model:
    """Languages, their codewords (-1 and 1, a row each) and one linear classifier for each bit."""

    languages: list[str]
    code: np.ndarray
    weights: np.ndarray
    bias: np.ndarray


def codewords(classes: int, seed: int = 7) -> np.ndarray:
    """A row of -1 and 1 for each class.

    Up to six classes get the exhaustive code: every way to split the classes in two. More get the code with the
    largest least distance between rows among many random ones of 12 log2(classes) bits.
    """
    if classes < 2:
        return np.ones((classes, 1))
    if classes <= 6:
        splits = np.arange(1, 2 ** (classes - 1))
        return np.array([[1 if (s >> c) & 1 else -1 for s in splits] for c in range(classes)], float)
    bits = int(np.ceil(12 * np.log2(classes)))
    rng = np.random.default_rng(seed)
    best, far = None, -1.0
    for _ in range(200):
        code = rng.choice([-1.0, 1.0], (classes, bits))
        apart = (bits - code @ code.T) / 2 + np.eye(classes) * bits
        if apart.min() > far and (np.abs(code.sum(axis=0)) < classes).all():
            best, far = code, apart.min()
    return best


def letter_table() -> np.ndarray:
    """Whether each code point is a letter."""
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


LETTERS = letter_table()


def grams(text: str | None) -> np.ndarray | None:
    """Counts of hashed letter n-grams of a whole text, None if it has no letter.

    The text is lower-cased, and each run of other characters counts as one space.
    """
    if not text:
        return None
    points = np.frombuffer(f" {text.lower()} ".encode("utf-32-le", "replace"), np.uint32)
    letter = LETTERS[points]
    if not letter.any():
        return None
    keep = letter | np.concatenate([[True], letter[:-1]])
    points = np.where(letter, points, 32)[keep].astype(np.uint32)
    out = np.zeros(BUCKETS)
    value = np.zeros(len(points), np.uint32)
    for order in ORDERS:
        n = len(points) - order + 1
        if n < 1:
            break
        value = value[:n] * np.uint32(0x9E3779B1) + points[order - 1 :][:n] * np.uint32(order * 2 + 1)
        out += np.bincount((value * np.uint32(0x85EBCA6B)) >> np.uint32(19), minlength=BUCKETS)
    return out


def unit(counts: np.ndarray) -> np.ndarray:
    """Damped counts as a vector of unit length."""
    x = np.log1p(counts)
    return (x / max(np.linalg.norm(x), 1e-9)).astype(np.float32)


def filled(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Places and values of what is not zero in the vectors of some texts, one text after the other."""
    places, values = [], []
    for i, text in enumerate(texts):
        x = unit(grams(text))
        at = np.flatnonzero(x)
        places.append((i * BUCKETS + at).astype(np.int32))
        values.append(x[at])
    return np.concatenate(places), np.concatenate(values)


def fit(sample: list[tuple[str, str]], steps: int = 200, ridge: float = 1e-4, seed: int = 3) -> Model:
    """Logistic classifiers for the code's bits, by accelerated gradient steps on whole texts and short snippets.

    The vectors are kept without their zeros; a step fills one dense block of rows after the other.
    """
    languages = sorted({lang for _, lang in sample})
    code = codewords(len(languages))
    place = {lang: i for i, lang in enumerate(languages)}
    rng = np.random.default_rng(seed)
    cuts, labels = [], []
    for text, lang in sample:
        parts = [text]
        for size in SNIPPETS:
            if len(text) > 2 * size:
                at = int(rng.integers(0, len(text) - size))
                parts.append(text[at : at + size])
        for part in parts:
            if any(map(str.isalpha, part)):
                cuts.append(part)
                labels.append(place[lang])
    bits = code.shape[1]
    weights, bias = np.zeros((BUCKETS, bits), np.float32), np.zeros(bits, np.float32)
    if len(languages) < 2 or not cuts:
        return Model(languages, code, weights, bias)
    blocks = [(i, *filled(cuts[i : i + DENSE_ROWS])) for i in range(0, len(cuts), DENSE_ROWS)]
    dense = np.zeros((min(DENSE_ROWS, len(cuts)), BUCKETS), np.float32)
    y = code[labels].astype(np.float32)
    each = np.bincount(labels, minlength=len(languages))
    share = (1 / each[labels] / (each > 0).sum()).astype(np.float32)[:, None]
    last, last_bias, rate = weights, bias, 8.0
    for step in range(steps):
        pull = step / (step + 3)
        w, b = weights + pull * (weights - last), bias + pull * (bias - last_bias)
        slope, g = np.zeros_like(weights), np.empty_like(y)
        for begin, places, values in blocks:
            rows = slice(begin, begin + DENSE_ROWS)
            x = dense[: len(y[rows])]
            x.reshape(-1)[places] = values
            g[rows] = -y[rows] / (1 + np.exp(np.clip(y[rows] * (x @ w + b), -30, 30))) * share[rows]
            slope += x.T @ g[rows]
            x.reshape(-1)[places] = 0
        last, last_bias = weights, bias
        weights, bias = w - rate * (slope + ridge * w), b - rate * g.sum(axis=0)
    return Model(languages, code, weights.astype(np.float32), bias.astype(np.float32))


def decode(model: Model, margins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest codeword by logistic loss: its row, its probability and its lead over the next."""
    loss = np.logaddexp(0, -margins[:, None, :] * model.code[None]).sum(axis=2)
    best = loss.argmin(axis=1)
    odds = np.exp(-(loss - loss.min(axis=1, keepdims=True)))
    lead = np.full(len(loss), np.inf)
    if loss.shape[1] > 1:
        two = np.partition(loss, 1, axis=1)
        lead = two[:, 1] - two[:, 0]
    return best, odds[np.arange(len(best)), best] / odds.sum(axis=1), lead


def scorer(model: Model) -> Callable[[], Callable[[list[str | None]], list[pa.Array]]]:
    def predict(texts: list[str | None]) -> list[pa.Array]:
        names = [UNDETERMINED] * len(texts)
        score, unsure = np.zeros(len(texts)), np.ones(len(texts), bool)
        at, margins = [], []
        for i, text in enumerate(texts):
            got = grams(text) if model.languages else None
            if got is not None:
                at.append(i)
                margins.append(unit(got) @ model.weights + model.bias)
        if at:
            best, odds, lead = decode(model, np.array(margins, float))
            for i, b in zip(at, best, strict=True):
                names[i] = model.languages[b]
            score[at], unsure[at] = odds, lead < AMBIGUOUS_MARGIN
        return [pa.array(names), pa.array(score), pa.array(unsure)]

    return lambda: predict


def fair_level(sizes: list[int], most: float, rows: int) -> float:
    """The largest number up to ``most`` such that languages cut to it have ``rows`` documents at most."""
    left = float(rows)
    for i, size in enumerate(sorted(sizes)):
        level = left / (len(sizes) - i)
        if size >= min(level, most):
            return min(level, most)
        left -= size
    return float(most)


def fit_language(docs: DataFrame, per_language: int = SAMPLE_PER_LANGUAGE, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on about ``per_language`` documents of each language, ``rows`` at most, chosen by a hash of id and text.

    Many languages share ``rows`` evenly, and those with fewer documents than that are taken whole; the first document
    of each comes before the second ones, so the bound removes no language (of more than ``rows`` the commonest stay).
    Equal rows count once in the sample.
    Documents without lang or text are not in the sample; of texts over 32 KB four windows are (training only).
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"),
        training_text(F.col("text").cast("string"), MAX_TRAINING_BYTES).alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    usable = usable.withColumn("place", F.xxhash64("doc_id", "text", F.lit(11)) / 2.0**64)
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("least"))
    counts = written(counts.orderBy(F.desc("n"), "lang").limit(rows), "language-counts")
    level = fair_level([row.n for row in counts.collect()], per_language, rows)
    chosen = (
        usable.join(F.broadcast(counts.withColumnRenamed("lang", "of")), F.col("lang") == F.col("of"))
        .withColumn("nth", (F.col("place") - F.col("least")) * F.col("n"))
        .where((F.col("nth") < level) | (F.col("n") <= level))
        .select("nth", "text", "lang", "doc_id")
        .distinct()
        .orderBy("nth", "lang", "doc_id", "text")
        .limit(rows)
    )
    return fit([(row.text, row.lang) for row in chosen.collect()])


def identify(docs: DataFrame, model: Model, keep_text: bool = True, prefix: str = "") -> DataFrame:
    """Add lang_pred, score (0 to 1) and ambiguous to every document, from its whole text.

    ``prefix`` goes before the three names; columns of the input with such names are replaced.

    Texts that are null or have no letter are ``und`` with score 0, as is everything if no language was learned.
    ``ambiguous``: the nearest codeword leads the next by less than one unit of loss.
    """
    added = ", ".join(f"`{prefix}{name}` {kind}" for name, kind in LANGUAGE_COLUMNS)
    return scored(docs, scorer(model), added, keep_text)
