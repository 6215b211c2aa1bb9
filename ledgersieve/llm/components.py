"""Connected components as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.shared import written


def _marks(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]


def components(edges: DataFrame) -> DataFrame:
    """node and component (the least node it is connected to) of every node of some edges (u, v).

    Alternates two steps until nothing changes: each node's larger neighbours point to the least neighbour, then all
    smaller ones do. Each round is written to the shared folder. A node with very many edges is aggregated in parts
    before the shuffle; where it is joined to its least neighbour, AQE splits its partition and repeats that one row. No edges give no rows.
    """
    pairs = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct()
    pairs = written(pairs, "components")
    marks = _marks(pairs)
    while marks[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (
            both.where("v > u")
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        lowest = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(lowest, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .where("u != v")
            .distinct()
        )
        pairs = written(small, "components")
        new = _marks(pairs)
        if new == marks:
            break
        marks = new
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component"))
    return pairs.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots).distinct()
