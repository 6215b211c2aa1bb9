"""Benchmark passages in documents, found with the q-gram lemma."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.shared import text_chunks

Q = 10
EDIT_SHARE = 0.05
MIN_PATTERN = 2 * Q
MAX_PATTERN = 400
BLOCK_BYTES = 4_000_000
TABLE_BITS = 22
BASE = np.uint64(0x9E3779B97F4A7C15)
HIT_SCHEMA = "doc_id long, item_id long, start int, stop int, edits int"


def normal(text: str | None) -> str:
    """Lower case, with each run of white space as one space."""
    return " ".join(text.lower().split()) if text else ""


def budget(length: int) -> int:
    """Edits that a match of a pattern may have."""
    return int(EDIT_SHARE * length)


def least_shared(length: int) -> int:
    """The q-gram lemma: a match within the budget shares at least so many of the pattern's q-grams."""
    return length + 1 - Q * (budget(length) + 1)


def patterns(text: str | None) -> list[str]:
    """A normalised item; a long one as overlapping parts. Items under ``MIN_PATTERN`` characters have none.

    From there on a match within the budget shares at least one q-gram. Shorter items are looked for as they are.
    """
    text = normal(text)
    if len(text) < MIN_PATTERN:
        return []
    if len(text) <= MAX_PATTERN:
        return [text]
    step = MAX_PATTERN // 2
    starts = [*range(0, len(text) - MAX_PATTERN, step), len(text) - MAX_PATTERN]
    return [text[s : s + MAX_PATTERN] for s in starts]


def points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)


def gram_hashes(codes: np.ndarray) -> np.ndarray:
    """A hash of each run of q characters."""
    n = len(codes) - Q + 1
    if n < 1:
        return np.zeros(0, np.uint64)
    value = np.zeros(n, np.uint64)
    for k in range(Q):
        value *= BASE
        value += codes[k : k + n]
    return value ^ (value >> np.uint64(29))


def slot(hashes: np.ndarray) -> np.ndarray:
    return ((hashes * BASE) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


@dataclass
class Index:
    """A block of patterns: their q-grams sorted by hash, with pattern and place, and a bit table to look at first.

    ``short`` has the items under ``MIN_PATTERN`` characters by length: text and ids.
    """

    items: np.ndarray
    texts: list[str]
    hashes: np.ndarray
    pattern: np.ndarray
    place: np.ndarray
    seen: np.ndarray
    short: dict[int, dict[str, list[int]]] = field(default_factory=dict)


def index(items: list[tuple[int, str]]) -> Index:
    ids, texts, hashes, pattern, place = [], [], [], [], []
    known = set()
    short: dict[int, dict[str, list[int]]] = {}
    for item_id, text in items:
        whole = normal(text)
        if 0 < len(whole) < MIN_PATTERN:
            short.setdefault(len(whole), {}).setdefault(whole, []).append(item_id)
        for p in patterns(text):
            if (item_id, p) in known:
                continue
            known.add((item_id, p))
            h = gram_hashes(points(p))
            hashes.append(h)
            pattern.append(np.full(len(h), len(texts), np.int32))
            place.append(np.arange(len(h), dtype=np.int32))
            ids.append(item_id)
            texts.append(p)
    if not texts:
        empty = np.zeros(0, np.int32)
        return Index(np.zeros(0, np.int64), [], np.zeros(0, np.uint64), empty, empty, np.zeros(1 << TABLE_BITS, bool), short)
    h, p, a = np.concatenate(hashes), np.concatenate(pattern), np.concatenate(place)
    order = np.argsort(h, kind="stable")
    seen = np.zeros(1 << TABLE_BITS, bool)
    seen[slot(h)] = True
    return Index(np.array(ids, np.int64), texts, h[order], p[order], a[order], seen, short)


def banded(pattern: np.ndarray, text: np.ndarray, most: int, low: int, high: int) -> tuple[int, int, int] | None:
    """Edits, start and stop of the best match of a pattern whose path stays on the diagonals low to high, if within budget.

    A diagonal is place in the text less place in the pattern. Dynamic programming down the pattern; a row is a vector
    over the diagonals only, so a pattern of n characters costs n times the band's width whatever the text's length is.
    A dropped character comes from the next diagonal of the row above, insertions within a row are a running minimum.
    """
    n, width = len(text), high - low + 1
    at = np.arange(width)
    far = len(pattern) + n + 1
    padded = np.full(n + width + len(pattern) + 2, -1, np.int64)
    shift = max(0, 1 - low)  # where the text begins in the padded copy, so that no place is negative
    padded = np.concatenate([np.full(shift, -1, np.int64), text.astype(np.int64), padded])
    place = at + low
    cost, origin = np.where((place >= 0) & (place <= n), 0, far), place.copy()
    for i, c in enumerate(pattern.tolist(), 1):
        place = at + (low + i)
        swap = cost + (padded[place - 1 + shift] != c)
        swap[place < 1] = far
        drop = np.append(cost[1:] + 1, far)
        better = drop < swap
        best = np.where(better, drop, swap)
        source = np.where(better, np.append(origin[1:], 0), origin)
        best[(place < 0) | (place > n)] = far
        key = (best - at) * (width + 1) + at
        lead = np.minimum.accumulate(key)
        came = lead % (width + 1)
        cost = (lead - came) // (width + 1) + at
        cost[(place < 0) | (place > n)] = far
        origin = source[came]
        if cost.min() > most:
            return None
    stop = int(cost.argmin())
    return (int(cost[stop]), int(origin[stop]), stop + low + len(pattern)) if cost[stop] <= most else None


def regions(found: Index, hashes: np.ndarray) -> list[tuple[int, int, int]]:
    """Pattern and diagonals (first, last) of the bands of a text that share enough q-grams with a pattern.

    Bands are 2k + 1 diagonals wide for a budget of k edits and overlap by half, so every match lies in one of them
    whole. A q-gram of the pattern counts once a band.
    """
    maybe = np.flatnonzero(found.seen[slot(hashes)])
    if not len(maybe):
        return []
    low = np.searchsorted(found.hashes, hashes[maybe], "left")
    many = np.searchsorted(found.hashes, hashes[maybe], "right") - low
    at = np.repeat(maybe, many)
    if not len(at):
        return []
    entry = np.arange(len(at)) + np.repeat(low - (np.cumsum(many) - many), many)
    which, place = found.pattern[entry].astype(np.int64), found.place[entry].astype(np.int64)
    diagonal = at - place
    sizes = np.array([len(found.texts[p]) for p in np.unique(which)])
    size = sizes[np.searchsorted(np.unique(which), which)]
    least = size + 1 - Q * ((EDIT_SHARE * size).astype(np.int64) + 1)
    enough = np.bincount(np.searchsorted(np.unique(which), which))
    keep = enough[np.searchsorted(np.unique(which), which)] >= least
    which, place, diagonal, size, least = which[keep], place[keep], diagonal[keep], size[keep], least[keep]
    if not len(which):
        return []
    half = (EDIT_SHARE * size).astype(np.int64) + 1
    out = []
    cell = np.floor_divide(diagonal, half)
    band = np.concatenate([cell, cell - 1])
    w, p, need, h = (np.concatenate([x, x]) for x in (which, place, least, half))
    order = np.lexsort((p, band, w))
    w, p, band, need, h = w[order], p[order], band[order], need[order], h[order]
    new_band = np.concatenate([[True], (w[1:] != w[:-1]) | (band[1:] != band[:-1])])
    new_gram = new_band | np.concatenate([[True], p[1:] != p[:-1]])
    group = np.cumsum(new_band) - 1
    shared = np.bincount(group[new_gram], minlength=group[-1] + 1)
    head = np.flatnonzero(new_band)
    for g in np.flatnonzero(shared >= need[head]):
        k = head[g]
        out.append((int(w[k]), int(band[k] * h[k]), int((band[k] + 2) * h[k])))
    return out


def short_hits(found: Index, plain: str, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """item_id, start and stop of the first place where a short item stands as whole words in a normalised text."""
    value = np.zeros(len(codes), np.uint64)
    for size in range(1, min(max(found.short, default=0), len(codes)) + 1):
        n = len(codes) - size + 1
        value = value[:n] * BASE + codes[size - 1 :][:n]
        if size not in found.short:
            continue
        left = dict(found.short[size])
        grid = np.stack([points(item) for item in left])
        wanted = np.zeros(len(grid), np.uint64)
        for k in range(size):
            wanted = wanted * BASE + grid[:, k]
        for start in np.flatnonzero(np.isin(value, wanted)).tolist():
            stop = start + size
            item = plain[start:stop]
            if (
                item in left
                and not (start and plain[start - 1].isalnum() and item[0].isalnum())
                and not (stop < len(plain) and plain[stop].isalnum() and item[-1].isalnum())
            ):
                yield from ((item_id, start, stop) for item_id in left.pop(item))
                if not left:
                    break


def hits(found: Index, text: str | None) -> list[tuple[int, int, int, int]]:
    """item_id, start, stop (places in the normalised text) and edits of the matches in a whole text, the best of each item."""
    plain = normal(text)
    codes = points(plain)
    best: dict[int, tuple[int, int, int]] = {}
    for which, first, last in regions(found, gram_hashes(codes)):
        pattern = points(found.texts[which])
        spare = budget(len(pattern))
        begin = max(0, first - spare)
        end = min(len(codes), last + len(pattern) + spare)
        same = plain.find(found.texts[which], begin, end)
        if same >= 0:
            got = (0, same - begin, same - begin + len(pattern))
        else:
            got = banded(pattern, codes[begin:end], spare, first - spare - begin, last + spare - begin)
        if got is not None:
            item = int(found.items[which])
            new = (got[0], begin + got[1], begin + got[2])
            best[item] = min(best.get(item, new), new)
    for item, start, stop in short_hits(found, plain, codes):
        best[item] = min(best.get(item, (0, start, stop)), (0, start, stop))
    return [(item, start, stop, edits) for item, (edits, start, stop) in sorted(best.items())]


def blocks(
    benchmark: DataFrame, block_bytes: int = BLOCK_BYTES, without_id: bool = False
) -> Iterator[list[tuple[int, str]]]:
    """The benchmark's items in blocks of about ``block_bytes``, by a hash of the id. Null texts are left out.

    Items with a null id are left out too, or get the id 0 with ``without_id``.
    """
    items = benchmark.select(
        F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")
    ).where("text is not null")
    items = items.fillna(0, ["item_id"]) if without_id else items.where("item_id is not null")
    size = items.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts = max(1, -(-size // block_bytes))
    block = F.pmod(F.xxhash64("item_id", "text"), F.lit(parts))
    for k in range(parts):
        yield [(r.item_id, r.text) for r in items.where(block == k).orderBy("item_id", "text").collect()]


_INDEXES: dict[str, Index] = {}


def kept_index(name: str, items: list[tuple[int, str]]) -> Index:
    """The index of a block, made once in each Python worker; one is kept at a time."""
    if name not in _INDEXES:
        _INDEXES.clear()
        _INDEXES[name] = index(items)
    return _INDEXES[name]


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """A row for each document and benchmark item with a match: doc_id, item_id, start, stop and edits.

    A match is a passage of the document's normalised text within an edit distance of 5 % of the item's normalised
    text (of a 400-character part of longer items), or an exact copy as whole words of an item under 20 characters.
    Items without an id can't be reported; ``clean`` looks for them too. Start and stop are places in the normalised
    text, of the match with the fewest edits. Every block of the benchmark is held against all documents; documents
    are not shuffled. Null and empty texts match nothing, an empty benchmark gives no rows, repeated rows are reported
    as often as they occur.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in blocks(benchmark, block_bytes):
        shared, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterable[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            found = kept_index(name, shared.value)
            for batch, texts in text_chunks(batches):
                rows = [
                    (doc_id, *hit)
                    for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts, strict=True)
                    for hit in hits(found, text)
                ]
                columns = list(zip(*rows, strict=True)) or [[]] * 5
                types = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                    names=["doc_id", "item_id", "start", "stop", "edits"],
                )

        part = rows.mapInArrow(run, HIT_SCHEMA)
        out = part if out is None else out.unionByName(part)
    return out


def clean(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """The documents without a match, of items without an id too; all columns stay."""
    out = docs
    for items in blocks(benchmark, block_bytes, without_id=True):
        shared, name = docs.sparkSession.sparkContext.broadcast(items), uuid.uuid4().hex

        def run(batches: Iterable[pa.RecordBatch], shared=shared, name=name) -> Iterator[pa.RecordBatch]:
            found = kept_index(name, shared.value)
            for batch, texts in text_chunks(batches):
                yield batch.filter(pa.array([not hits(found, text) for text in texts], pa.bool_()))

        out = out.withColumn("text", F.col("text").cast("string")).mapInArrow(run, out.schema)
    return out
