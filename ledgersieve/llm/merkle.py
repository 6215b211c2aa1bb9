"""Merkle manifest of a dataset: levels as hex strings in aligned blocks, hashed and cut by fixed-width substrings."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgersieve.llm.shared import written

FAN = 16
DIGEST = 64
LEVELS = 3
#: Nodes of an aligned block: three levels make one node of them.
BLOCK = FAN**LEVELS
#: Rows that are equal in every column are dealt to so many ranges.
EQUAL_PARTS = 64
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _field(value: Column) -> Column:
    shown = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(shown).cast("string"), F.lit(":"), shown), F.lit("-"))


def leaf_hash(*values: Column) -> Column:
    """sha256 (lower-case hex) of the values in order: ``-`` if null, else byte count, a colon and the value."""
    return F.sha2(F.concat(*[_field(value) for value in values]), 256)


def group_key(source: Column) -> Column:
    """Text that orders bytewise as sources do, null first, and joins like any other value."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def numbered(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Add ``pos``, the row's place in its group from 0, and ``total``, the rows of the group.

    Rows are range-partitioned and sorted, so a group is spread over as many tasks as its rows need, also if all its
    rows are equal. Spark's running id numbers the rows of a task; only a count for each task and group is added up.
    """
    place = F.monotonically_increasing_id()
    dealt = rows.withColumn("equal", F.pmod(F.monotonically_increasing_id(), F.lit(EQUAL_PARTS)))
    keys = [group, *order, "equal"]
    sorted_rows = dealt.repartitionByRange(*keys).sortWithinPartitions(*keys).drop("equal")
    stored = written(sorted_rows.withColumn("id", place).withColumn("task", F.shiftright("id", 33)), "merkle-order")
    counts = stored.groupBy(group, "task").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    lower = Window.partitionBy(group).orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        group,
        "task",
        (F.coalesce(F.sum("n").over(lower), F.lit(0)) - F.col("least")).alias("shift"),
        F.sum("n").over(Window.partitionBy(group)).alias("total"),
    )
    return stored.join(starts, [group, "task"]).withColumn("pos", F.col("id") + F.col("shift")).drop("id", "task", "shift")


def _cut(level: Column, begin: Column, nodes: Column | int) -> Column:
    """Digests of a level from a node on. A level is held as the bytes of its hex text, so it isn't scanned for this."""
    count = nodes if isinstance(nodes, Column) else F.lit(nodes)
    return F.substring(level, (begin * DIGEST + 1).cast("int"), (count * DIGEST).cast("int"))


def _parents(level: Column) -> Column:
    """The next level as one string: the hash of every run of fixed width."""
    runs = F.ceil(F.octet_length(level) / (FAN * DIGEST)).cast("int")
    hashes = F.transform(F.sequence(F.lit(0), runs - 1), lambda i: F.sha2(_cut(level, i * FAN, FAN), 256))
    return F.array_join(hashes, "").cast("binary")


def blocks(nodes: DataFrame, carried: list[str]) -> DataFrame:
    """Aligned blocks of 4,096 nodes: grp, block, total, depth, n, levels, top and ``entries`` (the carried columns).

    ``nodes`` has grp, pos, total and hash. ``levels`` are the strings of a block from its nodes up to below ``top``. A
    block of a larger group goes up three levels, a lone one until a single node remains.
    """
    total = F.col("total")
    depth = F.when(total <= 1, 0).when(total <= FAN, 1).when(total <= FAN**2, 2).otherwise(LEVELS)
    made = (
        nodes.withColumn("block", F.floor(F.col("pos") / BLOCK).cast("long"))
        .groupBy("grp", "block", "total")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "hash", *carried))).alias("found"))
        .withColumn("depth", depth)
        .withColumn("l0", F.array_join(F.transform("found", lambda e: e.hash), "").cast("binary"))
    )
    for k in range(LEVELS):
        made = made.withColumn(f"l{k + 1}", F.when(F.col("depth") > k, _parents(F.col(f"l{k}"))))
    return made.select(
        "grp",
        "block",
        "total",
        "depth",
        F.size("found").alias("n"),
        F.coalesce(*[F.col(f"l{k}") for k in range(LEVELS, -1, -1)]).cast("string").alias("top"),
        *[F.when(F.col("depth") > k, F.col(f"l{k}")).alias(f"l{k}") for k in range(LEVELS)],
        F.transform("found", lambda e: F.struct(*[e[c].alias(c) for c in ["hash", *carried]])).alias("entries")
        if carried
        else F.lit(None).alias("entries"),
    )


def siblings(place: Column) -> Column:
    """Segments left and right of a block's node in its runs, level by level up to below the top of the block."""
    steps = []
    for k in range(LEVELS):
        own = F.shiftright(place, 4 * k)
        begin = F.shiftright(own, 4) * FAN
        level = F.col(f"l{k}")
        step = F.struct(
            _cut(level, begin, own - begin).cast("string").alias("left"),
            _cut(level, own + 1, begin + FAN - own - 1).cast("string").alias("right"),
        )
        steps.append(F.when(F.col("depth") > k, F.array(step)).otherwise(F.array().cast("array<struct<left:string,right:string>>")))
    return F.concat(*steps)


def folded(node: Column, path: Column) -> Column:
    """What a node and the segments beside its way up give at the end of that way."""
    return F.aggregate(path, node, lambda above, s: F.sha2(F.concat(s.left, above, s.right), 256))


def proof_text(path: Column) -> Column:
    return F.array_join(F.transform(path, lambda s: F.concat(s.left, s.right)), "")


@dataclass(frozen=True)
class Tree:
    """Stored blocks of some trees, one for each group; blocks of a stage are the nodes of the next one."""

    stages: list[DataFrame]

    def tops(self) -> DataFrame:
        """grp and top: what remains of each group."""
        last = [stage.where(F.col("total") <= BLOCK).select("grp", "top") for stage in self.stages]
        return reduce(DataFrame.unionByName, last)

    def paths(self) -> DataFrame | None:
        """grp, block and path from a block of the first stage to its group's top; lone blocks have no row."""
        above = None
        for stage in reversed(self.stages[1:]):
            rows = stage if above is None else stage.join(above, ["grp", "block"], "left")
            rest = F.array().cast("array<struct<left:string,right:string>>")
            if above is not None:
                rest = F.coalesce("path", rest)
            places = F.sequence(F.lit(0), F.col("n") - 1)
            each = F.transform(
                places,
                lambda p: F.struct((F.col("block") * BLOCK + p).alias("block"), F.concat(siblings(p), rest).alias("path")),  # noqa: B023
            )
            above = rows.select("grp", F.inline(each))
        return above


def grown(nodes: DataFrame, carried: list[str]) -> Tree:
    """The tree of each group of nodes (grp, pos, total, hash); every stage is written and 4,096 times smaller."""
    stages = []
    while True:
        stages.append(written(blocks(nodes, carried), "merkle-blocks"))
        larger = stages[-1].where(F.col("total") > BLOCK)
        if larger.isEmpty():
            return Tree(stages)
        nodes = larger.select(
            "grp", F.col("block").alias("pos"), F.ceil(F.col("total") / BLOCK).cast("long").alias("total"), F.col("top").alias("hash")
        )
        carried = []


@dataclass(frozen=True)
class Manifest:
    """Trees of the sources, and the tree over their tops; its top is the root of the dataset."""

    by_source: Tree
    over_sources: Tree

    def root(self) -> DataFrame:
        return self.over_sources.tops().select(F.col("top").alias("root"))

    def sources(self) -> DataFrame:
        """grp, subroot, root and the path from the subroot to the root."""
        tree = self.over_sources
        above = tree.paths()
        bottom = tree.stages[0].join(tree.tops().select("grp", F.col("top").alias("root")), "grp")
        rest = F.array().cast("array<struct<left:string,right:string>>")
        if above is not None:
            bottom, rest = bottom.join(above, ["grp", "block"], "left"), F.coalesce("path", rest)
        each = F.transform(
            "entries",
            lambda e, i: F.struct(e.source.alias("grp"), e.hash.alias("subroot"), F.concat(siblings(i), rest).alias("source_path")),
        )
        return bottom.select("root", F.inline(each))


def manifest(docs: DataFrame, carried: dict[str, Column] | None = None) -> Manifest:
    """Build the manifest of some documents. ``carried`` columns travel with each leaf.

    A leaf is the hash of a row's five fields. The leaves of a source ascend by doc_id (null first), ties by the hash;
    rows that are equal in all fields are leaves of their own. Every 16 neighbours make a node until one remains. Null
    is a source of its own and comes first. Columns besides the five fields don't count. An empty table has no root.
    """
    carried = {"doc_id": F.col("doc_id").cast("long"), **(carried or {})}
    leaves = docs.select(
        group_key(F.col("source")).alias("grp"),
        leaf_hash(*[F.col(name) for name in FIELDS]).alias("hash"),
        *[value.alias(name) for name, value in carried.items()],
    )
    by_source = grown(numbered(leaves, "grp", ["doc_id", "hash"]), list(carried))
    tops = by_source.tops().select(F.lit("").alias("grp"), F.col("grp").alias("source"), F.col("top").alias("hash"))
    return Manifest(by_source, grown(numbered(tops, "grp", ["source"]), ["source"]))


def proofs(made: Manifest, claimed: str) -> DataFrame:
    """doc_id, leaf, subroot, root, the hash of all siblings, and the root that the ``claimed`` leaf folds to.

    The siblings of a leaf are cut out where its block lies; only the path from the block's top upwards, which all its
    leaves share, is joined. A null claim stands for the leaf itself.
    """
    bottom = made.by_source.stages[0].join(made.sources(), "grp")
    above = made.by_source.paths()
    rest = F.col("source_path")
    if above is not None:
        bottom, rest = bottom.join(above, ["grp", "block"], "left"), F.when(F.col("path").isNull(), rest).otherwise(F.concat("path", rest))
    bottom = bottom.withColumn("rest", rest)

    def row(entry: Column, place: Column) -> Column:
        path = F.concat(siblings(place), F.col("rest"))
        return F.struct(
            entry.doc_id.alias("doc_id"),
            entry.hash.alias("leaf"),
            F.sha2(proof_text(path), 256).alias("proof_sha256"),
            folded(F.coalesce(entry[claimed], entry.hash), path).alias("folded_root"),
        )

    rows = bottom.select("subroot", "root", F.inline(F.transform("entries", row)))
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root").withColumn(
        "verified", F.col("folded_root") == F.col("root")
    )


def lower_ascii(text: Column) -> Column:
    return F.translate(text.cast("string"), ascii_uppercase, ascii_lowercase)


def tamper_proofs(docs: DataFrame, every: int = 5) -> DataFrame:
    """Proofs of all leaves, where the text of every fifth row (by the crc32 of its id) was lower-cased after the build.

    A null id counts as the empty text, whose crc32 is 0. Only a change of bytes is found out: a text without A-Z, or
    null, verifies.
    """
    changed = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % every == 0
    fields = [lower_ascii(F.col(name)) if name == "text" else F.col(name) for name in FIELDS]
    made = manifest(docs, {"claimed": F.when(changed, leaf_hash(*fields))})
    return proofs(made, "claimed")
