"""Repeated passages by prefix-partitioned suffix trees over words.

A suffix is known here by its path from the root of the suffix tree of all texts, as far as the window reaches: a
64-bit fingerprint of its first ``window`` words. Suffixes are dealt to groups by a prefix of a few words; a group
that holds more than a task should is split by the longest prefix that is needed, the whole window. Within a group the
paths are sorted; a run of equal paths is an internal node at the window's depth, its suffixes occur more than once,
and suffixes that follow each other in a text chain up to its maximal repeats.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.minhash import MULTIPLIER, mixed, word_hashes
from ledgersieve.llm.shared import text_chunks, written

WINDOW = 35
PREFIX = 4
#: Suffixes a group should hold; about 12 bytes each.
GROUP = 2_000_000
#: Bytes of text that stand for one suffix where the number of groups is chosen.
BYTES_PER_SUFFIX = 6
RUN = 4_000_000
SALTS = 16
ENTRY_SCHEMA = "grp long, run binary, sent int, paths binary, places binary, known binary, texts binary, starts binary"
REPLY_SCHEMA = "run binary, sent int, places binary, texts binary, starts binary"


def packed(values: np.ndarray) -> bytes:
    """Ascending integers as differences, bytes of equal weight together, which the shuffle's codec shortens."""
    steps = np.diff(values, prepend=values.dtype.type(0))
    return steps.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def unpacked(raw: bytes | None, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    return np.frombuffer(raw or b"", np.uint8).reshape(width, len(raw or b"") // width).T.copy().view(kind).ravel().cumsum(dtype=kind)


def shuffled_places(values: np.ndarray) -> bytes:
    """Integers in any order, bytes of equal weight together."""
    return values.view(np.uint8).reshape(len(values), values.itemsize).T.tobytes()


def places_of(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.uint8).reshape(4, len(raw) // 4).T.copy().view(np.uint32).ravel()


class Suffixes:
    """The suffixes of some texts that have a whole window: place (word number in the run) and fingerprints."""

    def __init__(self, texts: list[str | None], window: int):
        encoded = [(t or "").encode("utf-8", "replace") for t in texts]
        raw = np.frombuffer(b"\n".join(encoded), np.uint8)
        begins = np.cumsum([0] + [len(e) + 1 for e in encoded])
        self.words, at = word_hashes(raw)
        #: Number of the first word of each text, and of the end.
        self.starts = np.searchsorted(at, begins)
        self.window = window
        counts = np.diff(self.starts) - window + 1
        kept = np.flatnonzero(counts > 0)
        ends = np.cumsum(counts[kept])
        total = int(ends[-1]) if len(ends) else 0
        self.places = np.arange(total) + np.repeat(self.starts[kept] - (ends - counts[kept]), counts[kept])

    def paths(self, length: int, seed: int) -> np.ndarray:
        """Fingerprints of the first ``length`` words of each suffix; ``seed`` makes them independent."""
        salts = mixed(np.arange(seed * 1000 + 1, seed * 1000 + length + 1, dtype=np.uint64) * MULTIPLIER) | np.uint64(1)
        n = len(self.words) - length + 1
        sums = np.zeros(max(0, n), np.uint64)
        for k in range(length if n > 0 else 0):
            sums += self.words[k : k + n] * salts[k]
        return mixed(sums[self.places])


def group_counts(texts: DataFrame, groups: int, window: int, prefix: int) -> np.ndarray:
    """How many suffixes of all texts each prefix group holds; a row a task comes to the driver's sum."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(groups, np.int64)
        for batch in batches:
            for _, some in text_chunks([batch], RUN):
                suffixes = Suffixes(some, window)
                total += np.bincount((suffixes.paths(prefix, 1) % np.uint64(groups)).astype(np.int64), minlength=groups)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["grp", "n"])

    counts = np.zeros(groups, np.int64)
    for row in texts.select("text").mapInArrow(run, "grp long, n long").groupBy("grp").agg(F.sum("n").alias("n")).collect():
        counts[row.grp] = row.n
    return counts


def entries(texts: DataFrame, splits: np.ndarray, window: int, prefix: int) -> DataFrame:
    """Suffixes dealt to groups: a row for each run of texts and group, and a row that describes the run.

    Suffixes with one path in the same run are repeated whatever other runs hold: their places stay in the run's row,
    and one path goes on as ``known``, so a passage that very many texts share is one entry a run. ``splits`` says
    into how many parts each prefix group is cut, and by how much the numbers of its parts are moved.
    """
    groups = len(splits)
    first_part = np.concatenate([[0], np.cumsum(splits)])

    def rows_of(number: int, part: int, digests: list[bytes], texts: list[str]) -> Iterator[dict]:
        suffixes = Suffixes(texts, window)
        name = hashlib.blake2b(b"".join(digests) + f"{part}/{number}".encode(), digest_size=16).digest()
        path = suffixes.paths(window, 0)
        bucket = (suffixes.paths(prefix, 1) % np.uint64(groups)).astype(np.int64)
        group = first_part[bucket] + ((path >> np.uint64(7)) % splits[bucket].astype(np.uint64)).astype(np.int64)
        order = np.argsort(path)
        order = order[np.argsort(group[order], kind="stable")]
        path, group, place = path[order], group[order], suffixes.places[order].astype(np.uint32)
        fresh = np.ones(len(path) + 1, bool)
        fresh[1:-1] = (path[1:] != path[:-1]) | (group[1:] != group[:-1])
        alone = fresh[:-1] & fresh[1:]
        known = fresh[:-1] & ~alone
        cuts = np.flatnonzero(np.diff(group)) + 1
        bounds = list(zip([0, *cuts.tolist()], [*cuts.tolist(), len(path)], strict=True)) if len(path) else []
        yield {
            "grp": -1 - int.from_bytes(name[:4], "little") % max(1, groups),
            "run": name,
            "sent": len(bounds),
            "places": packed(np.sort(place[~alone])),
            "texts": b"".join(digests),
            "starts": packed(suffixes.starts.astype(np.uint32)),
        }
        for a, b in bounds:
            single = alone[a:b]
            yield {
                "grp": int(group[a]),
                "run": name,
                "paths": packed(path[a:b][single]),
                "places": shuffled_places(place[a:b][single]),
                "known": packed(path[a:b][known[a:b]]),
            }

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        schema = pa.schema(
            [("grp", pa.int64()), ("run", pa.binary()), ("sent", pa.int32())]
            + [(n, pa.binary()) for n in ("paths", "places", "known", "texts", "starts")]
        )
        for batch, some in text_chunks(batches, RUN):
            for row in rows_of(number, part, batch.column("digest").to_pylist(), some):
                yield pa.RecordBatch.from_pylist([row], schema=schema)
            number += 1

    return texts.select("digest", "text").mapInArrow(run, ENTRY_SCHEMA)


def subtree(table: pa.Table) -> pa.Table:
    """Places of the suffixes of one group that hang on a node with other suffixes; rows of runs pass through."""
    rows = table.select(["run", "sent", "paths", "places", "known", "texts", "starts"]).to_pylist()
    described = [r for r in rows if r["sent"] is not None]
    sent = [r for r in rows if r["sent"] is None]
    paths = [unpacked(r["paths"], np.uint64) for r in sent]
    known = [unpacked(r["known"], np.uint64) for r in sent]
    singles = np.array([len(p) for p in paths], np.int64)
    path = np.concatenate([*paths, *known]) if sent else np.zeros(0, np.uint64)
    leaves = np.ones(len(path), np.int64)
    leaves[int(singles.sum()) :] = 2
    order = np.argsort(path, kind="stable")
    path = path[order]
    node = np.cumsum(np.concatenate([[False], path[1:] != path[:-1]])) if len(path) else np.zeros(0, np.int64)
    deep = np.bincount(node, weights=leaves[order]) > 1 if len(path) else np.zeros(0, bool)
    repeated = np.zeros(len(path), bool)
    repeated[order] = deep[node]
    found, begin = [], 0
    for r, n in zip(sent, singles.tolist(), strict=True):
        found.append(packed(np.sort(places_of(r["places"])[repeated[begin : begin + n]])))
        begin += n
    every = sent + described
    return pa.table(
        {
            "run": pa.array([r["run"] for r in every], pa.binary()),
            "sent": pa.array([r["sent"] for r in every], pa.int32()),
            "places": pa.array(found + [r["places"] for r in described], pa.binary()),
            "texts": pa.array([r["texts"] for r in every], pa.binary()),
            "starts": pa.array([r["starts"] for r in every], pa.binary()),
        }
    )


def spans_of_run(window: int, table: pa.Table) -> pa.Table:
    """digest and repeated spans (pairs of word numbers, the second exclusive) of the texts of one run that have any."""
    rows = table.to_pylist()
    head = [r for r in rows if r["sent"] is not None]
    if len(head) != 1 or len(rows) != head[0]["sent"] + 1:
        raise ValueError("a run of texts was dealt anew in between; store the documents before looking for repeats")
    starts = unpacked(head[0]["starts"], np.uint32).astype(np.int64)
    place = np.sort(np.concatenate([unpacked(r["places"], np.uint32) for r in rows])).astype(np.int64)
    text = np.searchsorted(starts, place, side="right") - 1
    if len(place):
        gap = (place[1:] > place[:-1] + window) | (text[1:] != text[:-1])
        low = place[np.concatenate([[True], gap])]
        high = place[np.concatenate([gap, [True]])] + window
        text = text[np.concatenate([[True], gap])]
    else:
        low = high = place
    spans = np.stack([low - starts[text], high - starts[text]], axis=1).astype("<u4")
    which, first = np.unique(text, return_index=True)
    digests = head[0]["texts"]
    return pa.table(
        {
            "digest": pa.array([digests[16 * t : 16 * t + 16] for t in which.tolist()], pa.binary()),
            "spans": pa.array([s.tobytes() for s in np.split(spans, first[1:])] if len(which) else [], pa.binary()),
        }
    )


def _with_digest(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select("*", F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("digest"))


def repeats(docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP) -> DataFrame:
    """digest (16 bytes of the text's sha256) and spans of each distinct text that has repeated passages.

    Words are what ASCII white space parts, unchanged. A span is a maximal run of words covered by windows whose words
    also start anywhere else, in the same text or row included: pairs of little-endian 32-bit word numbers. Null and
    short texts have none. Rows that repeat a text of at least a window's words are repeats of each other.

    Equal fingerprints in one group count as equal words; with n suffixes in g groups about n * n / (g * 2**65) windows
    are taken for repeats wrongly (0.0001 at 116 million suffixes).
    """
    texts = _with_digest(docs.select(F.col("text").cast("string").alias("text"))).where("text is not null")
    size = texts.agg(F.sum(F.octet_length("text")).alias("bytes")).first()["bytes"] or 0
    groups = max(1, -(-size // (BYTES_PER_SUFFIX * group)))
    counts = group_counts(texts, groups, window, prefix)
    splits = np.maximum(1, -(-counts // group))
    replies = written(
        entries(texts, splits, window, prefix).groupBy("grp").applyInArrow(subtree, REPLY_SCHEMA), "repeat-replies"
    )
    spans = replies.groupBy("run").applyInArrow(lambda t: spans_of_run(window, t), "digest binary, spans binary")
    return written(spans.groupBy("digest").agg(F.first("spans").alias("spans")), "repeat-spans")


def kept_words(text: str | None, spans: bytes | None) -> tuple[int, int, bytes]:
    """Number of words, how many of them lie in spans, and the others joined by one space."""
    words = (text or "").encode("utf-8", "replace").split()
    n, removed = len(words), 0
    for low, high in np.frombuffer(spans or b"", "<u4").reshape(-1, 2)[::-1].tolist():
        del words[low:high]
        removed += high - low
    return n, removed, b" ".join(words)


def without_repeats(
    docs: DataFrame, window: int = WINDOW, prefix: int = PREFIX, group: int = GROUP, keep_text: bool = True
) -> DataFrame:
    """Remove repeated passages: adds ``n_words``, ``n_removed``, ``kept_sha256`` and, if asked for, ``kept_text``.

    All columns stay but for those named like the added ones. Null and empty texts have no words; their kept text is
    empty. Repeated ids are rows of their own. Every distinct text is cut once, however many rows have it. An empty
    table gives no rows.
    """
    found = repeats(docs, window, prefix, group)
    added = ["n_words", "n_removed", "kept_sha256"] + ["kept_text"] * keep_text

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            got = [kept_words(t, s) for t, s in zip(texts, batch.column("spans").to_pylist(), strict=True)]
            columns = [
                batch.column("digest"),
                pa.array([g[0] for g in got], pa.int64()),
                pa.array([g[1] for g in got], pa.int64()),
                pa.array([hashlib.sha256(g[2]).hexdigest() for g in got], pa.string()),
            ]
            if keep_text:
                columns.append(pa.array([g[2].decode() for g in got], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names=["digest", *added])

    rows = docs.drop("digest", "salt", *added)
    texts = _with_digest(rows.select(F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")))
    schema = "digest binary, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * keep_text
    once = texts.dropDuplicates(["digest"]).join(found, "digest", "left").mapInArrow(run, schema)
    cut = written(once, "repeat-cut").withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    named = _with_digest(rows).withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int"))
    return named.join(cut, ["digest", "salt"]).drop("digest", "salt")
