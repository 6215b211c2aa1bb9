"""Approximate nearest neighbours by a forest of random-projection trees."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgersieve.llm.shared import written

TREES = 16
SAMPLE_ROWS = 20_000
FEWEST_LEAVES = 128
LEAF_ROWS = 20_000
LEAF_SHARE = 0.05
WHOLE_ROWS = 20
TRIES = 4
SALTS = 16
BLOCK = ["leaf", "part", "chunk"]


@dataclass
class Forest:
    """Trees of the same depth: a direction and a threshold for each inner node, the root at 1."""

    depth: int
    directions: np.ndarray
    thresholds: np.ndarray

    @property
    def leaves(self) -> int:
        return 1 << self.depth


def fit(sample: np.ndarray, trees: int, depth: int, seed: int = 17) -> Forest:
    """Split by the median of a projection on the direction between two random rows; of some tries the widest."""
    rng = np.random.default_rng(seed)
    dim = sample.shape[1] if sample.size else 1
    directions = np.zeros((trees, 1 << depth, dim), np.float32)
    thresholds = np.zeros((trees, 1 << depth), np.float32)
    for t in range(trees):
        inside = {1: np.arange(len(sample))}
        for node in range(1, 1 << depth):
            rows = inside.pop(node)
            best, wide = rng.normal(size=dim), -1.0
            if len(rows) > 1:
                for _ in range(TRIES):
                    a, b = sample[rng.choice(rows, 2, replace=False)]
                    way = a - b + 1e-6 * rng.normal(size=dim)
                    way /= max(np.linalg.norm(way), 1e-12)
                    spread = (sample[rows] @ way).var()
                    if spread > wide:
                        best, wide = way, spread
            along = sample[rows] @ best if len(rows) else np.zeros(0)
            middle = float(np.median(along)) if len(rows) else 0.0
            directions[t, node], thresholds[t, node] = best, middle
            inside[2 * node], inside[2 * node + 1] = rows[along <= middle], rows[along > middle]
    return Forest(depth, directions, thresholds)


def depth_for(rows: int, k: int) -> int:
    """Tables of up to ``WHOLE_ROWS`` * k rows have one leaf, others 128, or more where those would be over ``LEAF_ROWS``."""
    depth = 0 if rows <= WHOLE_ROWS * k else max(0, min(int(np.log2(FEWEST_LEAVES)), int(np.log2(rows / 3))))
    while rows / (1 << depth) > LEAF_ROWS and (1 << depth) * 16 < SAMPLE_ROWS:
        depth += 1
    return depth


def leaves_of(forest: Forest, vectors: np.ndarray) -> np.ndarray:
    """The leaf of each vector in each tree, numbered over the whole forest."""
    out = np.empty((len(vectors), len(forest.directions)), np.int32)
    for t in range(out.shape[1]):
        node = np.ones(len(vectors), np.int64)
        for _ in range(forest.depth):
            along = np.einsum("ij,ij->i", vectors, forest.directions[t, node])
            node = 2 * node + (along > forest.thresholds[t, node])
        out[:, t] = t * forest.leaves + node - forest.leaves
    return out


def leaf_costs(forest: Forest, vector: np.ndarray) -> np.ndarray:
    """For each tree and node the least cost of a leaf below it.

    A leaf's cost is the sum of the signed margins on its way from the root: negative where the leaf lies on the vector's
    side. Rows of a leaf lie on its sides of all these splits, so the lower the cost, the larger their products tend to be.
    """
    margins = forest.directions @ vector - forest.thresholds
    costs = np.zeros((len(margins), 2 * forest.leaves), np.float32)
    for level in range(forest.depth):
        nodes = np.arange(1 << level, 2 << level)
        costs[:, 2 * nodes] = costs[:, nodes] + margins[:, nodes]
        costs[:, 2 * nodes + 1] = costs[:, nodes] - margins[:, nodes]
    for node in range(forest.leaves - 1, 0, -1):
        costs[:, node] = np.minimum(costs[:, 2 * node], costs[:, 2 * node + 1])
    return costs


def search_leaves(forest: Forest, vector: np.ndarray, visit: int) -> list[int]:
    """The first ``visit`` leaves in the order of one priority queue over all trees.

    A node's priority is the least cost of a leaf below it, so leaves leave the queue in the order of their costs.
    """
    costs = leaf_costs(forest, vector).tolist()
    queue = [(tree[1], t, 1) for t, tree in enumerate(costs)]
    heapq.heapify(queue)
    out: list[int] = []
    while queue and len(out) < visit:
        _, t, node = heapq.heappop(queue)
        if node >= forest.leaves:
            out.append(t * forest.leaves + node - forest.leaves)
            continue
        for child in (2 * node, 2 * node + 1):
            heapq.heappush(queue, (costs[t][child], t, child))
    return out


def _matrix(column: Iterable[bytes]) -> np.ndarray:
    rows = [np.frombuffer(v, "<f8") for v in column]
    return np.stack(rows) if rows else np.zeros((0, 1))


def usable(vectors: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding") -> DataFrame:
    """id, vector (doubles as bytes) and key (its SHA-1) of the rows that take part.

    Left out: null ids, vectors that are null, empty, all zero, or hold null or non-finite components, and vectors
    whose length is not the most frequent one (ties: the smaller), as they have no inner product with the others.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, raw, dims = [], [], []
            for i, v in zip(batch.column("id").to_pylist(), batch.column("v").to_pylist(), strict=True):
                if i is None or not v or None in v:
                    continue
                a = np.array(v, "<f8")
                if np.isfinite(a).all() and a.any():
                    ids.append(i)
                    raw.append((a + 0.0).tobytes())
                    dims.append(len(a))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(raw, pa.binary()), pa.array(dims, pa.int32())],
                names=["id", "vector", "dims"],
            )

    rows = vectors.select(
        F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v")
    ).mapInArrow(run, "id long, vector binary, dims int")
    rows = written(rows.withColumn("key", F.unhex(F.sha1("vector"))), "ann-vectors")
    most = rows.groupBy("dims").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "dims").first()
    return rows.where(F.col("dims") == (most.dims if most else 0)).drop("dims")


def _with_leaves(batch: pa.RecordBatch, leaves: list) -> pa.RecordBatch:
    """The rows of a batch with the leaves of each as a list."""
    ends = np.cumsum([0, *(len(each) for each in leaves)])
    flat = np.concatenate(leaves) if leaves else np.zeros(0)
    lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int32()))
    return pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "leaves"])


def _in_blocks(stored: DataFrame, asking: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows and queries of each leaf, dealt to blocks of about ``LEAF_ROWS`` of either, in which all meet all.

    A leaf that holds much of the data, or that many queries visit, becomes many blocks. The counts have one row a leaf,
    which are at most ``TREES`` times some thousands, and are sent to every task.
    """
    rows = stored.select(F.explode("leaves").alias("leaf"), "ids", "vector")
    queries = asking.select(F.explode("leaves").alias("leaf"), "key", "vector")

    def blocks(of: DataFrame, name: str) -> DataFrame:
        return of.groupBy("leaf").agg(F.ceil(F.count(F.lit(1)) / LEAF_ROWS).cast("int").alias(name))

    split = F.broadcast(written(blocks(rows, "parts").join(blocks(queries, "chunks"), "leaf"), "ann-split"))
    rows = rows.join(split, "leaf").withColumn("part", F.pmod(F.xxhash64("vector"), F.col("parts")).cast("int"))
    rows = rows.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    queries = queries.join(split, "leaf").withColumn("chunk", F.pmod(F.xxhash64("key"), F.col("chunks")).cast("int"))
    queries = queries.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return rows.select(*BLOCK, "ids", "vector"), queries.select(*BLOCK, "key", "vector")


def nearest(
    vectors: DataFrame,
    is_query: Column,
    k: int = 20,
    trees: int = TREES,
    leaf_share: float = LEAF_SHARE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """For each query row its ``k`` nearest other rows by inner product: query_id, rank, vec_id, score.

    ``is_query`` is a condition on the column ``id``. Neighbours are different ids, none of them the query's own. An id
    may occur in several rows: with one vector it counts once, with several its best product counts. Every query row
    is answered, so equal query rows get equal answers. Equal vectors are searched and found once, with their k + 1
    smallest different ids, so copies can't fill a leaf. The forest is fitted on at most ``SAMPLE_ROWS`` different vectors and
    holds every one of them in a leaf of each tree; a query visits the same share of all leaves at every size, and
    the candidates there are ranked by their exact product in double precision. Trees have 128 leaves, or more where
    those would have over 20,000 rows; tables of up to 20 * k different vectors have one leaf and are searched whole.
    Leaves of more than 20,000 rows or queries, as skewed data has them at any size, are compared in blocks.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_column, vector_column)
    # Different ids of a vector are limited in salted parts first, so a vector of many ids is no hot spot.
    ids = rows.select("key", "id").distinct().withColumn("salt", F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int"))
    for keys in (["key", "salt"], ["key"]):
        by_id = Window.partitionBy(*keys).orderBy("id")
        ids = ids.withColumn("nth", F.row_number().over(by_id)).where(F.col("nth") <= k + 1)
    ids = ids.groupBy("key").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    classes = written(rows.groupBy("key").agg(F.first("vector").alias("vector")).join(ids, "key"), "ann-classes")
    n = classes.count()
    sample = _matrix(r.vector for r in classes.select("vector", "key").orderBy("key").limit(SAMPLE_ROWS).collect())
    forest = fit(sample.astype(np.float32), trees, depth_for(n, k))
    depth = forest.depth
    visit = trees if depth == 0 else int(np.ceil(leaf_share * trees * forest.leaves))
    sent = spark.sparkContext.broadcast(forest)

    def place(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in range(0, batch.num_rows, 2000):
                cut = batch.slice(part, 2000)
                at = leaves_of(sent.value, _matrix(cut.column("vector").to_pylist()).astype(np.float32))
                yield _with_leaves(cut, list(at))

    def ask(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = (np.frombuffer(v, "<f8").astype(np.float32) for v in batch.column("vector").to_pylist())
            yield _with_leaves(batch, [search_leaves(sent.value, v, visit) for v in vectors])

    query_keys = rows.where(is_query).select(F.col("key").alias("wanted")).distinct()
    asks = classes.join(query_keys, F.col("key") == F.col("wanted"), "left_semi").select("key", "vector")
    stored = written(classes.select("ids", "vector").mapInArrow(place, "ids array<long>, vector binary, leaves array<int>"), "ann-stored")
    asks = written(asks.mapInArrow(ask, "key binary, vector binary, leaves array<int>"), "ann-asked")
    placed, asked = _in_blocks(stored, asks)

    def rerank(_: tuple, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """The best k + 1 different ids in a block for each query there (its own may be one)."""
        out = []
        if len(left) and len(right):
            stored, lists = _matrix(right["vector"]), right["ids"].to_list()
            ids, of = np.concatenate(lists), np.repeat(np.arange(len(lists)), [len(x) for x in lists])
            order = np.argsort(ids, kind="stable")
            ids, of = ids[order], of[order]
            head = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]]))
            times = np.diff(np.append(head, len(ids)))
            for begin in range(0, len(left), 500):
                scores = _matrix(left["vector"].iloc[begin : begin + 500]) @ stored.T
                for i, own in enumerate(left["key"].iloc[begin : begin + 500]):
                    line = scores[i][of]
                    top = np.maximum.reduceat(line, head)
                    floor = top - 1e-9 * np.maximum(1.0, np.abs(top))
                    if len(top) > k + 1:
                        least = np.partition(top, len(top) - k - 1)[len(top) - k - 1]
                        floor = np.maximum(floor, least - 1e-9 * max(1.0, abs(least)))
                    best = np.flatnonzero(line >= np.repeat(floor, times))
                    query = np.frombuffer(left["vector"].iloc[begin + i], "<f8")
                    exact = (query * stored[of[best]]).sum(axis=1)
                    at = np.lexsort((ids[best], -exact))
                    at = at[np.sort(np.unique(ids[best][at], return_index=True)[1])[: k + 1]]
                    out.append(pd.DataFrame({"query": [own] * len(at), "vec_id": ids[best][at], "score": exact[at]}))
        return pd.concat(out) if out else pd.DataFrame({"query": [], "vec_id": [], "score": []})

    found = (
        asked.groupBy(*BLOCK)
        .cogroup(placed.groupBy(*BLOCK))
        .applyInPandas(rerank, "query binary, vec_id long, score double")
        .groupBy("query", "vec_id")
        .agg(F.max("score").alias("score"))
    )
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    best = (
        found.withColumn("nth", F.row_number().over(order))
        .where(F.col("nth") <= k + 1)
        .groupBy("query")
        .agg(F.array_sort(F.collect_list(F.struct("nth", "vec_id", "score"))).alias("near"))
        .withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    asking = rows.where(is_query).select(
        F.col("id").alias("query_id"), F.col("key").alias("query"), F.pmod(F.xxhash64("id"), F.lit(SALTS)).cast("int").alias("salt")
    )
    others = F.slice(F.filter("near", lambda x: x.vec_id != F.col("query_id")), 1, k)
    return (
        asking.join(best, ["query", "salt"])
        .select("query_id", F.posexplode(others).alias("at", "one"))
        .select(
            "query_id",
            (F.col("at") + 1).alias("rank"),
            F.col("one.vec_id").alias("vec_id"),
            F.col("one.score").alias("score"),
        )
    )
