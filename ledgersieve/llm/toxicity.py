"""Toxicity by compression distance: what a toxic dictionary compresses better than an ordinary one."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Callable, Iterable
from dataclasses import dataclass
from math import log

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from ledgersieve.llm.shared import labelled_sample, scored

SAMPLE_ROWS = 8_000
WINDOW_WORDS = 8
STRIDE_WORDS = 7
ORDINARY_BYTES = 48_000
FAMILY_SEGMENTS = 1_500
LEVEL = 3
#: A segment goes into the toxic dictionary if its log-likelihood ratio is above this (one in a million by chance
#: is about 24) and it is this many times as common in toxic texts.
LEAST_EVIDENCE = 30.0
LEAST_RATIO = 8.0
THRESHOLD = 0.3
SPACES = bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))
PUNCTUATION = ".,;:!?*#$%&|()\"'"


@dataclass
class Model:
    """Two dictionaries of the same size and the weights that turn window differences into a probability."""

    ordinary: bytes
    toxic: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    rate: float


def plain(text: str | None) -> bytes:
    return text.lower().encode("utf-8", "replace").translate(SPACES) if text else b""


def segments(words: Iterable[bytes]) -> set[str]:
    """Words and beginnings of words, with the space before them."""
    out = set()
    for word in words:
        bare = word.decode().strip(PUNCTUATION)[:40]
        if len(bare) >= 3:
            out.add(" " + bare)
            out.update(" " + bare[:n] for n in (4, 5, 6, 7, 8, 10) if len(bare) > n)
    return out


def one_of_each_family(sample: list[tuple[str, int]]) -> list[tuple[set[bytes], int]]:
    """Word sets of the texts; of texts that share their least three-word hash (copies) only the first.

    Equal words are one object in all sets, so memory follows the different words and not the texts.
    """
    seen, out = set(), []
    known: dict[bytes, bytes] = {}
    for text, label in sample:
        words = plain(text).split()
        least = min((zlib.crc32(b" ".join(words[i : i + 3])) for i in range(max(1, len(words) - 2))), default=0)
        if (least, label) not in seen:
            seen.add((least, label))
            out.append(({known.setdefault(word, word) for word in words}, label))
    return out


def toxic_segments(texts: list[tuple[set[bytes], int]]) -> list[str]:
    """Segments that mark toxic texts, the weakest first: one for each family, and then common members of them."""
    in_toxic: Counter[str] = Counter()
    for words, label in texts:
        if label:
            in_toxic.update(segments(words))
    in_toxic = Counter({s: n for s, n in in_toxic.items() if n >= 4})
    in_ordinary: Counter[str] = Counter()
    for words, label in texts:
        if not label:
            in_ordinary.update(s for s in segments(words) if s in in_toxic)
    n1 = sum(label for _, label in texts)
    n0 = len(texts) - n1

    def part(x: float, expected: float) -> float:
        return x * log(x / expected) if x > 0 else 0.0

    found = []
    for segment, a in in_toxic.items():
        b = in_ordinary[segment]
        if a * n0 < LEAST_RATIO * (b + 0.5) * n1:
            continue
        both, total = a + b, n0 + n1
        evidence = 2 * (
            part(a, both * n1 / total)
            + part(b, both * n0 / total)
            + part(n1 - a, (total - both) * n1 / total)
            + part(n0 - b, (total - both) * n0 / total)
        )
        if evidence > LEAST_EVIDENCE:
            found.append((evidence, segment))
    found.sort(reverse=True)
    longest = sorted((s for _, s in found), key=lambda s: (-len(s), s))
    heads: list[str] = []
    for _, segment in found:
        if any(segment.startswith(h) or h.startswith(segment) for h in heads):
            continue
        heads.append(
            next((s for s in longest if s.startswith(segment) and in_toxic[s] >= 0.9 * in_toxic[segment]), segment)
        )
    members = [s for _, s in found if s not in heads and any(s.startswith(h) for h in heads)][:FAMILY_SEGMENTS]
    return members[::-1] + heads[::-1]


def dictionaries(texts: list[tuple[set[bytes], int]]) -> tuple[bytes, bytes]:
    """Content dictionaries trained on ordinary and on toxic text.

    Both begin with the commonest ordinary words, so that ordinary windows come out alike with either. The rest is
    more ordinary words in one and the segments that mark toxic text in the other. The strongest come last, where
    matches cost least.
    """
    chosen = toxic_segments(texts)
    toxic = "".join(chosen).encode() + b" "
    marks = tuple(s.encode() for s in chosen)
    common: Counter[bytes] = Counter()
    for words, label in texts:
        if not label:
            common.update(words)
    ordinary, size = [], 0
    for word, _ in sorted(common.items(), key=lambda p: (-p[1], p[0])):
        if size >= ORDINARY_BYTES + len(toxic):
            break
        if not (marks and (b" " + word).startswith(marks)):
            ordinary.append(b" " + word)
            size += len(word) + 1
    content = b"".join(ordinary[::-1])
    rest, shared = content[: len(toxic)], content[len(toxic) :]
    return shared + rest, shared + toxic


def compressor(content: bytes) -> zstandard.ZstdCompressor:
    data = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(level=LEVEL, dict_data=data, write_content_size=False, write_dict_id=False)


def windows(text: bytes) -> np.ndarray:
    """Start and size of windows of some words, each with the space before it."""
    raw = np.frombuffer(text, np.uint8)
    spaces = np.concatenate([[-1], np.flatnonzero(raw == 32), [len(raw)]])
    filled = np.diff(spaces) > 1
    starts, ends = np.maximum(spaces[:-1][filled], 0), spaces[1:][filled]
    n = len(starts)
    first = np.arange(0, max(1, n - WINDOW_WORDS + STRIDE_WORDS), STRIDE_WORDS)
    first = first[first < n]
    last = np.minimum(first + WINDOW_WORDS - 1, n - 1)
    return np.stack([starts[first], ends[last] - starts[first]], axis=1).astype(np.uint64)


def features(
    texts: list[str | None], ordinary: zstandard.ZstdCompressor, toxic: zstandard.ZstdCompressor
) -> np.ndarray:
    """By how many bytes the toxic dictionary compresses the windows of each whole text better."""
    out = np.zeros((len(texts), 6))
    for i, text in enumerate(texts):
        content = plain(text)
        cut = windows(content)
        if not len(cut):
            continue
        given = zstandard.BufferWithSegments(content, cut.tobytes())
        sizes = [
            np.fromiter(map(len, c.multi_compress_to_buffer(given, threads=1)), np.int64, len(cut))
            for c in (ordinary, toxic)
        ]
        gain = np.sort(sizes[0] - sizes[1])[::-1]
        excess = np.maximum(gain - 1, 0)
        out[i] = (
            gain[0],
            gain[:3].mean(),
            np.log1p(excess.sum()),
            excess.mean(),
            (gain >= 2).mean(),
            np.log1p(len(gain)),
        )
    return out


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Weights (the last is the constant) by Newton steps."""
    x = np.c_[x, np.ones(len(x))]
    w = np.zeros(x.shape[1])
    penalty = np.r_[np.full(len(w) - 1, ridge), 1e-3]
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(sample: list[tuple[str, int]]) -> Model:
    """Dictionaries from 70 % of a sample, weights from the rest. Without both labels the score is the label's rate."""
    cut = int(0.7 * len(sample))
    texts = one_of_each_family(sample[:cut])
    rest = sample[cut:]
    labels = np.array([label for _, label in rest], float)
    rate = (sum(label for _, label in sample) + 0.5) / (len(sample) + 5.0)
    ordinary, toxic = dictionaries(texts)
    none = np.zeros(6)
    if min(len(ordinary), len(toxic)) < 16 or not 0 < labels.sum() < len(labels):
        return Model(b"", b"", none, none + 1, np.zeros(7), rate)
    x = features([text for text, _ in rest], compressor(ordinary), compressor(toxic))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    return Model(ordinary, toxic, mean, scale, logistic((x - mean) / scale, labels), rate)


def scorer(model: Model) -> Callable[[], Callable[[list[str | None]], list[pa.Array]]]:
    """What a task does: make its compressors once, then score runs of texts."""

    def make() -> Callable[[list[str | None]], list[pa.Array]]:
        if not model.ordinary:
            return lambda texts: [pa.array(np.full(len(texts), model.rate))]
        pair = compressor(model.ordinary), compressor(model.toxic)

        def score(texts: list[str | None]) -> list[pa.Array]:
            x = (features(texts, *pair) - model.mean) / model.scale
            z = np.c_[x, np.ones(len(x))] @ model.weights
            return [pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))))]

        return score

    return make


def fit_toxicity(docs: DataFrame, labels: DataFrame, rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``rows`` labelled documents, chosen by a hash of their ids."""
    return fit(labelled_sample(docs, labels, "toxic", rows))


def toxicity(docs: DataFrame, model: Model, keep_text: bool = True, column: str = "score") -> DataFrame:
    """Score every whole text: the input's columns and a score from 0 to 1 (an own column of that name is replaced).

    Null and empty texts, and texts without words, have no window; their score is that of no evidence.
    """
    return scored(docs, scorer(model), f"`{column}` double", keep_text)
