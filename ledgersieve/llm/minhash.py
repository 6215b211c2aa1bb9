"""Near-duplicates by HyperMinHash: compressed registers, banding, and links confirmed on whole sets."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersieve.llm.components import components
from ledgersieve.llm.shared import possibly_in, text_chunks, written
from ledgersieve.llm.tokens import forget

REGISTERS = 128
BAND = 4
MANTISSA = 10
BUCKET_SHIFT = np.uint64(57)
REST = np.uint64((1 << 57) - 1)
BOUNDS = np.arange(REGISTERS, dtype=np.uint64) << BUCKET_SHIFT
#: Sets at least this large have registers that are near independent, so that an estimate can rule a pair out.
SURE_SIZE = 256
DEVIATIONS = 5.0
SMALL_GROUP = 256
BLOCK = 1024
#: Elements of sets that one slice of a comparison takes; blocks are put together up to twice that, and split at ten times.
BLOCK_SHINGLES = 400_000
SALTS = 16
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)
SKETCH_SCHEMA = "doc_id long, n_shingles long, digest binary, registers binary"


def mixed(x: np.ndarray) -> np.ndarray:
    """Fixed values and steps of the splitmix64 finaliser: spreads every bit over all of them."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTES = mixed((np.arange(256, dtype=np.uint64) + np.uint64(1)) * MULTIPLIER)
PROBES = np.stack([np.random.default_rng(1000 + j).permutation(REGISTERS) for j in range(REGISTERS)])
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    if not _POWERS or len(_POWERS[0]) < n:
        base = int(MULTIPLIER)
        size = max(n, 1 << 20)
        made = []
        for b in (base, pow(base, -1, 1 << 64)):
            factors = np.full(size, b, np.uint64)
            factors[0] = 1
            made.append(np.cumprod(factors, dtype=np.uint64))
        _POWERS[:] = made
    return _POWERS[0][:n], _POWERS[1][:n]


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and start of each word of some bytes; words are parted by ASCII white space."""
    edge = np.diff(np.concatenate([[False], ~SPACE[raw], [False]]).astype(np.int8))
    starts, ends = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    power, inverse = _powers(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(BYTES[raw] * power[: len(raw)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64)), starts


def shingle_sets(texts: list[str | None], words: int) -> list[np.ndarray]:
    """The sorted distinct shingles (64-bit hashes) of each whole text; a shorter text is one shingle of all its words."""
    encoded = [(t or "").encode("utf-8", "replace").lower() for t in texts]
    raw = np.frombuffer(b"\n".join(encoded), np.uint8)
    begins = np.cumsum([0] + [len(e) + 1 for e in encoded])
    hashes, starts = word_hashes(raw)
    first = np.searchsorted(starts, begins)
    salts = mixed(np.arange(1, words + 1, dtype=np.uint64) * MULTIPLIER) | np.uint64(1)
    n = len(hashes) - words + 1
    rolled = np.zeros(max(0, n), np.uint64)
    for k in range(words if n > 0 else 0):
        rolled += hashes[k : k + n] * salts[k]
    rolled = mixed(rolled)
    out = []
    for i in range(len(texts)):
        a, b = int(first[i]), int(first[i + 1])
        if b - a >= words:
            out.append(np.unique(rolled[a : b - words + 1]))
        elif b > a:
            one = (hashes[a:b] * salts[: b - a]).sum(dtype=np.uint64) + np.uint64(b - a)
            out.append(mixed(np.array([one], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def registers(shingles: np.ndarray) -> np.ndarray:
    """A 16-bit register for each bucket: leading zeros of the least hash there, and the ten bits that follow.

    A bucket without a shingle copies the first filled one of its own fixed order, so that small sets can be banded
    too; two sets agree there as often as elsewhere.
    """
    start = np.searchsorted(shingles, BOUNDS)
    filled = np.diff(np.append(start, len(shingles))) > 0
    least = shingles[np.minimum(start, len(shingles) - 1)] & REST
    fraction, exponent = np.frexp(least.astype(np.float64))
    kept = ((57 - exponent) << MANTISSA) + np.maximum((fraction * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    if not filled.all():
        empty = np.flatnonzero(~filled)
        order = PROBES[empty]
        kept[empty] = kept[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return kept.astype("<u2")


def accidental(n: np.ndarray) -> np.ndarray:
    """How often registers of two disjoint sets of n shingles agree by chance.

    The sum over all register values of the squared probability that a bucket's least of n / 128 hashes has it.
    """
    rate = np.maximum(np.asarray(n, float), 1.0)[:, None] / REGISTERS
    edges = np.concatenate([[0.0], 2.0 ** np.arange(-40, 1)])
    tail = np.exp(-rate * edges)
    octave = tail[:, :-1] - tail[:, 1:]
    return np.clip((octave**2).sum(axis=1) / (1 << MANTISSA), 0, 0.5)


def estimated(a: np.ndarray, b: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Jaccard similarity from two rows of registers each, less the agreement to be expected by chance."""
    chance = accidental(n)
    return np.clip(((a == b).mean(axis=1) - chance) / (1 - chance), 0, 1)


def least_estimate(similarity: float) -> float:
    return similarity - DEVIATIONS * float(np.sqrt(similarity * (1 - similarity) / REGISTERS))


def _rows_of(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Runs of texts, in a worker that keeps nothing of an earlier stage's tokenizer."""
    forget()
    return text_chunks(batches, 1_000_000)


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, n_shingles, digest (equal for equal sets) and registers of each document; no shingles: null digest."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _rows_of(batches):
            sets = shingle_sets(texts, words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(
                        [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets],
                        pa.binary(),
                    ),
                    pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n_shingles", "digest", "registers"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, SKETCH_SCHEMA)


def whole_sets(docs: DataFrame, nodes: DataFrame, words: int) -> DataFrame:
    """node, size, registers and whole shingle set (sorted 64-bit hashes) of some documents that have shingles.

    ``nodes`` is read several times. Texts that a bitmap of the nodes rules out don't travel.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in _rows_of(batches):
            sets = shingle_sets(texts, words)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([registers(s).tobytes() if len(s) else None for s in sets], pa.binary()),
                    pa.array([s.tobytes() for s in sets], pa.binary()),
                ],
                names=["node", "n", "registers", "shingles"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    ids = nodes.select(F.col("node").alias("doc_id"))
    wanted = possibly_in(rows, "doc_id", ids).join(ids, "doc_id", "left_semi")
    return wanted.mapInArrow(run, "node long, n long, registers binary, shingles binary").where("n > 0")


def band_rows(nodes: DataFrame) -> DataFrame:
    """A row for each node and band: a hash of the band's number and its four registers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bands = REGISTERS // BAND
        salt = mixed((np.arange(bands, dtype=np.uint64) + np.uint64(1)) * MULTIPLIER)
        for batch in batches:
            raw = b"".join(batch.column("registers").to_pylist())
            keys = mixed(np.frombuffer(raw, "<u8").reshape(-1, bands) ^ salt).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys.ravel()),
                    pa.array(np.tile(np.arange(bands, dtype=np.int32), batch.num_rows)),
                    *(batch.column(c).take(pa.array(np.repeat(np.arange(batch.num_rows), bands))) for c in ("node", "n")),
                ],
                names=["band", "number", "node", "n"],
            )

    return nodes.select("node", "n", "registers").mapInArrow(run, "band long, number int, node long, n long")


def likely(pairs: DataFrame, nodes: DataFrame, similarity: float) -> DataFrame:
    """Pairs (u, v) that sizes and registers don't rule out, with the estimate."""
    least = least_estimate(similarity)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            a, b = (
                np.frombuffer(b"".join(batch.column(c).to_pylist()), "<u2").reshape(-1, REGISTERS)
                for c in ("u_registers", "v_registers")
            )
            n, m = (batch.column(c).to_numpy() for c in ("u_n", "v_n"))
            estimate = estimated(a, b, (n + m) / 2)
            keep = (np.minimum(n, m) >= similarity * np.maximum(n, m) - 1e-9) & (
                (estimate >= least) | (np.minimum(n, m) < SURE_SIZE)
            )
            picked = pa.RecordBatch.from_arrays(
                [batch.column("u"), batch.column("v"), pa.array(estimate)], names=["u", "v", "estimate"]
            )
            yield picked.filter(pa.array(keep))

    def side(name: str) -> DataFrame:
        return nodes.select(
            F.col("node").alias(name), F.col("n").alias(f"{name}_n"), F.col("registers").alias(f"{name}_registers")
        )

    return pairs.join(side("v"), "v").join(side("u"), "u").mapInArrow(run, "u long, v long, estimate double")


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose whole sets have 100 * intersection >= percent * union."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("u_set"), batch.column("v_set"), strict=True):
                a, b = (np.frombuffer(s.as_buffer(), "<u8") for s in (x, y))
                if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
                    keep.append(False)
                    continue
                both = len(a) + len(b) - len(np.unique(np.concatenate([a, b])))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["u", "v"]).filter(pa.array(keep, pa.bool_()))

    def side(name: str) -> DataFrame:
        return sets.select(F.col("node").alias(name), F.col("shingles").alias(f"{name}_set"))

    return pairs.select("u", "v").join(side("v"), "v").join(side("u"), "u").mapInArrow(run, "u long, v long")


def _salt(by: str, column: str) -> Column:
    return F.pmod(F.xxhash64(by, F.lit(column)), F.lit(SALTS)).cast("int")


def _spread(rows: DataFrame, by: str, column: str) -> DataFrame:
    return rows.withColumn("salt", _salt(by, column))


def _salted(rows: DataFrame) -> DataFrame:
    return rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def shared_counts(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections of two lists of sets, by matrix products over the elements that several sets have."""
    sizes = [len(x) for x in a + b]
    row = np.repeat(np.arange(len(sizes)), sizes)
    _, column, times = np.unique(np.concatenate(a + b), return_inverse=True, return_counts=True)
    kept = times[column] > 1
    row, column = row[kept], (np.cumsum(times > 1) - 1)[column[kept]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    out = np.zeros((len(a), len(b)), np.float32)
    wide = 4096
    for begin in range(0, int(column[-1]) + 1 if len(column) else 0, wide):
        lo, hi = np.searchsorted(column, [begin, begin + wide])
        has = np.zeros((len(sizes), wide), np.float32)
        has[row[lo:hi], column[lo:hi] - begin] = 1
        out += has[: len(a)] @ has[len(a) :].T
    return out


def shared_in_slices(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """``shared_counts``, a slice of the hash range at a time, so that memory does not follow the size of the sets."""
    elements = sum(map(len, a)) + sum(map(len, b))
    slices = max(1, -(-elements // BLOCK_SHINGLES))
    if slices == 1:
        return shared_counts(a, b)
    bounds = (np.arange(1, slices, dtype=np.float64) * (2.0**64 / slices)).astype(np.uint64)
    cuts = [[np.concatenate([[0], np.searchsorted(x, bounds), [len(x)]]) for x in side] for side in (a, b)]
    out = np.zeros((len(a), len(b)), np.float32)
    for k in range(slices):
        parts = [[x[c[k] : c[k + 1]] for x, c in zip(side, at, strict=True)] for side, at in zip((a, b), cuts, strict=True)]
        out += shared_counts(*parts)
    return out


def spanning(links: np.ndarray, a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Enough of some links (a matrix) to connect what all of them connect; a and b name the components."""
    names, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    root = np.arange(len(names))
    left, right = at[: len(a)], at[len(a) :]
    out = []
    for i in np.flatnonzero(links.any(axis=1)):
        to = np.flatnonzero(links[i])
        roots, first = np.unique(root[right[to]], return_index=True)
        own = root[left[i]]
        for r, j in zip(roots, to[first], strict=True):
            if r != own:
                out.append((int(i), int(j)))
                root[root == r] = own
    return out


def possible(a: pd.DataFrame, b: pd.DataFrame, percent: int) -> np.ndarray:
    """Which rows of two frames of one bucket may be linked: of different components, by sizes and registers.

    Pairs that share an earlier band are left to it.
    """
    least = least_estimate(percent / 100)
    band = int(a["number"].iloc[0])
    x, y = (np.frombuffer(b"".join(f["registers"]), "<u2").reshape(-1, REGISTERS) for f in (a, b))
    n, m = a["n"].to_numpy(), b["n"].to_numpy()
    of, other = a["component"].to_numpy(), b["component"].to_numpy()
    maybe = np.zeros((len(a), len(b)), bool)
    for i in range(len(a)):
        near = np.flatnonzero((other != of[i]) & (100 * np.minimum(n[i], m) >= percent * np.maximum(n[i], m)))
        same = x[i] == y[near]
        chance = accidental((m[near] + n[i]) / 2)
        estimate = (same.mean(axis=1) - chance) / (1 - chance)
        earliest = same.reshape(-1, REGISTERS // BAND, BAND).all(axis=2).argmax(axis=1)
        sure = np.minimum(n[i], m[near]) >= SURE_SIZE
        maybe[i, near] = (earliest == band) & ((estimate >= least) | ~sure)
    return maybe


def _sets_of(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """The sets of some nodes (which may repeat) and of a few more."""
    return possibly_in(sets, "node", written(nodes.distinct(), "near-wanted"))


def crossing(bands: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) that connect all linked nodes that share a band and are not connected yet.

    In each bucket that holds several components, every node outside the commonest one is held against all nodes
    of the bucket that sizes and registers don't rule out. Buckets with few such pairs are joined; larger ones are
    dealt in blocks of about 1,024 by 1,024 nodes, and of fewer where their sets are large, so no task holds a bucket. A
    block first compares registers; only nodes that are left a partner travel on with their sets, which confirm the pairs
    that share no earlier band. No more links are sent than connect a block's nodes.
    """
    similarity = percent / 100
    rows = bands.join(labels.withColumnRenamed("component", "known"), "node", "left").select(
        "band", "number", "node", "n", F.coalesce("known", "node").alias("component")
    )
    sizes = rows.groupBy("band", "component").agg(F.sum("n").alias("shingles"), F.count(F.lit(1)).alias("n"))
    open_buckets = (
        sizes.groupBy("band")
        .agg(
            F.max(F.struct("n", "component", "shingles")).alias("most"),
            F.sum("n").alias("total"),
            F.sum("shingles").alias("total_shingles"),
            F.count(F.lit(1)).alias("several"),
        )
        .where("several > 1")
        .select(
            "band",
            F.col("most.component").alias("main"),
            "total",
            "total_shingles",
            (F.col("total") - F.col("most.n")).alias("minor"),
            (F.col("total_shingles") - F.col("most.shingles")).alias("minor_shingles"),
        )
    )
    open_rows = written(
        _spread(rows.drop("n"), "node", "open").join(_salted(open_buckets), ["band", "salt"]).drop("salt"), "near-open"
    )
    few = F.col("total") * F.col("minor") <= SMALL_GROUP
    minor = F.col("component") != F.col("main")
    left = open_rows.where(few & minor).select("band", F.col("node").alias("a"), F.col("component").alias("a_of"))
    right = open_rows.where(few).select("band", F.col("node").alias("b"), F.col("component").alias("b_of"))
    joined = (
        left.join(right, "band")
        .where("a_of != b_of")
        .select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v"))
        .distinct()
    )
    # Only registers of nodes with an open bucket travel, and whole sets only of nodes with a partner they don't rule out.
    in_open = written(open_rows.select("node").distinct(), "near-open-nodes")
    slim = possibly_in(sets.select("node", "n", "registers"), "node", in_open).join(in_open, "node", "left_semi")
    pairs = written(likely(joined, slim, similarity).select("u", "v"), "near-pairs")
    small = confirmed(pairs, _sets_of(pairs.select(F.explode(F.array("u", "v")).alias("node")), sets), percent)

    chunks, minors = (
        F.greatest(F.ceil(F.col(name) / BLOCK), F.ceil(F.col(f"{name}_shingles") / (10 * BLOCK_SHINGLES))).cast("int")
        for name in ("total", "minor")
    )
    large = open_rows.where(~few).join(slim, "node")
    mine = F.pmod(F.xxhash64("node"), chunks).cast("int")
    theirs = F.pmod(F.xxhash64("node", F.lit(1)), minors).cast("int")
    columns = ["band", "chunk", "part", "number", "node", "component", "n", "registers"]
    keys = ["band", "chunk", "part"]
    every = large.withColumn("chunk", mine).withColumn("part", F.explode(F.sequence(F.lit(0), minors - 1)))
    outside = (
        large.where(minor).withColumn("part", theirs).withColumn("chunk", F.explode(F.sequence(F.lit(0), chunks - 1)))
    )

    def narrow(_: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        """Nodes of a block that registers pair with any node of the other side: only their sets travel."""
        kept = ["band", "chunk", "part", "number", "node", "component", "n"]
        if not len(a) or not len(b):
            return a[kept].iloc[:0].assign(outer=False)
        maybe = possible(a, b, percent)
        return pd.concat([a[kept][maybe.any(axis=1)].assign(outer=True), b[kept][maybe.any(axis=0)].assign(outer=False)])

    sided = [side.select([F.col(c).alias(c) for c in columns]).groupBy(*keys) for side in (outside, every)]
    left_over = written(
        sided[0].cogroup(sided[1]).applyInPandas(
            narrow, "band long, chunk int, part int, number int, node long, component long, n long, outer boolean"
        ),
        "near-maybe",
    )
    # Survivors of one band and part meet again in fewer blocks: chunks that kept few nodes are put together.
    held = left_over.groupBy("band", "part", "chunk").agg(F.sum("n").alias("shingles"))
    lower = Window.partitionBy("band", "part").orderBy("chunk").rowsBetween(Window.unboundedPreceding, 0)
    block = F.floor(F.sum("shingles").over(lower) / (2 * BLOCK_SHINGLES)).cast("int")
    dealt = left_over.join(held.select("band", "part", "chunk", block.alias("block")), ["band", "part", "chunk"])

    def compare(_: tuple, a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"u": [], "v": []}).astype("int64")
        if not len(a) or not len(b):
            return none
        n, m = a["n"].to_numpy(), b["n"].to_numpy()
        of, other = a["component"].to_numpy(), b["component"].to_numpy()
        maybe = possible(a, b, percent)
        rows, columns = np.flatnonzero(maybe.any(axis=1)), np.flatnonzero(maybe.any(axis=0))
        if not len(rows):
            return none
        maybe = maybe[np.ix_(rows, columns)]
        p, q = ([np.frombuffer(f["shingles"].iloc[i], "<u8") for i in at] for f, at in ((a, rows), (b, columns)))
        both = shared_in_slices(p, q)
        whole = n[rows][:, None] + m[columns][None, :] - both
        found = spanning(maybe & (100 * both >= percent * whole), of[rows], other[columns])
        u, v = a["node"].to_numpy()[rows], b["node"].to_numpy()[columns]
        return pd.DataFrame([(u[i], v[j]) for i, j in found], columns=["u", "v"]).astype("int64")

    # A node of the outer side may be in several chunks of one block; it is sent once.
    once = dealt.select("band", "part", "block", "number", "node", "component", "outer").distinct()
    placed = once.join(_sets_of(left_over.select("node"), sets), "node")
    sides = [
        placed.where(side).select([F.col(c).alias(c) for c in ("band", "part", "block", *columns[3:], "shingles")]).groupBy(
            "band", "part", "block"
        )
        for side in (F.col("outer"), ~F.col("outer"))
    ]
    blocks = sides[0].cogroup(sides[1]).applyInPandas(compare, "u long, v long")
    return small.unionByName(blocks)


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for each document.

    Words are what ASCII white space parts, in lower case (A-Z); the set of a text is its distinct shingles of some
    words, or the whole sequence if it is shorter. Documents are linked if 100 * intersection >= percent * union,
    and a component is what links connect; its least doc_id is kept.

    Equal sets are one node, so copies cost a row each. Each node is first held against two nodes of each of its
    buckets, and its likeliest partner is confirmed: that alone connects most groups, at a cost in proportion to
    the rows. What is not connected then is compared in full within the buckets, so a link between documents that
    share a band is not lost; 32 bands of four registers miss a pair at the threshold once in 20 million, and the
    estimate, which rules out pairs of sets of 256 and more at five deviations, once in 3 million.

    Null and empty texts have no shingles, are linked with nothing and kept. Rows without an id are linked with
    nothing, kept, and have no component. Rows that share an id are one document: a row is kept if its id is.
    """
    similarity = percent / 100
    rows = written(sketches(docs, words), "near-sketches")
    found = rows.where("doc_id is not null and digest is not null")
    classes = written(
        found.groupBy("digest").agg(
            F.min("doc_id").alias("node"),
            F.count(F.lit(1)).alias("copies"),
            F.first("n_shingles").alias("n"),
            F.first("registers").alias("registers"),
        ),
        "near-classes",
    )
    nodes = classes.select("node", "n", "registers")
    buckets = written(
        band_rows(nodes)
        .groupBy("band")
        .agg(
            F.min("node").alias("one"),
            F.max("node").alias("two"),
            F.count(F.lit(1)).alias("n"),
        )
        .where("n > 1")
        .select("band", "one", "two"),
        "near-buckets",
    )
    shared = possibly_in(band_rows(nodes), "band", buckets.select("band"))
    bands = written(_spread(shared, "node", "band").join(_salted(buckets), ["band", "salt"]).drop("salt"), "near-bands")
    paired = written(bands.select("node").distinct(), "near-paired")
    sets = written(whole_sets(docs, paired, words), "near-sets")
    pairs = (
        bands.select(F.col("node").alias("u"), F.explode(F.array_distinct(F.array("one", "two"))).alias("v"))
        .where("u != v")
        .distinct()
    )
    best = (
        likely(pairs, sets, similarity)
        .groupBy("u")
        .agg(F.max(F.struct("estimate", F.col("v"))).alias("best"))
        .select("u", F.col("best.v").alias("v"))
    )
    first = written(confirmed(best, sets, percent), "near-links")
    labels = written(components(first), "near-labels")
    links = written(crossing(bands.select("band", "number", "node", "n"), sets, labels, percent), "near-rest")
    stars = labels.where("node != component").select(F.col("node").alias("u"), F.col("component").alias("v"))
    same_id = found.select("doc_id", "digest").join(
        found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1"), "doc_id"
    )
    tied = same_id.join(classes.select("digest", "node"), "digest").select(
        F.col("doc_id").alias("u"), F.col("node").alias("v")
    )
    final = written(components(stars.unionByName(links).unionByName(tied)), "near-components")

    # The component of each set first, then one join: sets of several documents meet their rows in salted parts.
    of_set = classes.join(final, "node", "left").select(
        "digest", "node", "copies", F.coalesce("component", "node").alias("component")
    )
    parts = F.when(F.col("copies") > 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(_salt("node", "row")))
    placed = of_set.select("digest", "component", F.explode(parts).alias("salt"))
    named = _spread(rows.where("doc_id is not null").drop("registers"), "doc_id", "row")
    with_set = named.where("digest is not null").join(placed, ["digest", "salt"]).select("doc_id", "n_shingles", "component")
    # A document's rows without words belong to it: they take the component of its other rows.
    blank = rows.where("doc_id is not null and digest is null").select("doc_id", "n_shingles")
    other = with_set.join(blank.select("doc_id").distinct(), "doc_id", "left_semi").groupBy("doc_id").agg(F.min("component").alias("component"))
    without = blank.join(other, "doc_id", "left").select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component"))
    nameless = rows.where("doc_id is null").select("doc_id", "n_shingles", F.lit(None).cast("long").alias("component"))
    return (
        with_set.unionByName(without)
        .unionByName(nameless)
        .select(
            "doc_id",
            "n_shingles",
            F.col("component").alias("component_id"),
            F.coalesce(F.col("doc_id") == F.col("component"), F.lit(True)).alias("kept"),
        )
    )
