"""Best-fit packing planned on the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgersieve.llm.shared import text_chunks, written
from ledgersieve.llm.tokens import binary, encoder

#: Parts in which the pieces of one length are ranked, at least, and pieces that a part should hold.
#: Characters that a task encodes at a time; what it holds besides its tokenizer follows them.
RUN = 2_000_000
RANK_PARTS = 64
RANK_PIECES = 200_000
PIECES = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("piece", pa.int32()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids_crc32", pa.int64()),
    ]
)
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"
SLOT_SCHEMA = "length long, first_rank long, last_rank long, first_sequence long, per_sequence long, place long"


def cutter(
    capacity: int, end_id: int, vocabulary: str | None, with_ids: bool
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Arrow batches of documents to batches of pieces of at most ``capacity`` ids."""

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches, RUN):
            ids, ends = encoder(vocabulary).encode(texts, end_id)
            ids = ids.astype("<u4", copy=False)
            begins = np.concatenate([[0], ends[:-1]])
            pieces = -(-(ends - begins) // capacity)
            row = np.repeat(np.arange(len(texts)), pieces)
            number = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = number * capacity
            first = begins[row] + start
            last = np.minimum(first + capacity, ends[row])
            raw = memoryview(ids).cast("B")
            crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
            columns = [
                batch.column("doc_id").take(pa.array(row)),
                pa.array(number.astype(np.int32)),
                pa.array(start),
                pa.array(last - first),
                pa.array(crc, pa.int64()),
            ]
            schema = PIECES
            if with_ids:
                columns.append(binary(ids, last))
                schema = schema.append(pa.field("ids", pa.binary()))
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return cut


def pieces_of(
    docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str | None = None, with_ids: bool = False
) -> DataFrame:
    """Token pieces of whole texts; only documents of more than ``capacity`` ids are cut, the last piece is shorter.

    Null and empty texts are one piece that holds the end id. ``with_ids`` adds the ids as little-endian 32-bit
    integers.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = PIECE_SCHEMA + (", ids binary" if with_ids else "")
    return rows.mapInArrow(cutter(capacity, end_id, vocabulary, with_ids), schema)


def plan(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit decreasing over counts: slots for the pieces of each length.

    Sequences that are filled alike are one entry (room, first number, how many), so the work depends on the number
    of lengths and not on the number of pieces. Each slot row says: pieces of this length with a rank from first_rank
    to last_rank (exclusive) go into the sequences from first_sequence on, ``per_sequence`` each, from ``place`` on.
    Lengths over the capacity don't occur.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}
    slots = []
    used = 0
    for length in sorted((n for n, c in counts.items() if c), reverse=True):
        rank, left = 0, counts[length]
        for room in sorted(r for r in rooms if r >= length):
            if not left:
                break
            each = room // length
            waiting = rooms.pop(room)
            while waiting and left:
                first, many = waiting.pop()
                full = min(many, left // each)
                if full:
                    slots.append((length, rank, rank + full * each, first, each, capacity - room))
                    rooms.setdefault(room - each * length, []).append((first, full))
                    rank, left = rank + full * each, left - full * each
                if full < many:
                    rest = (first + full, many - full)
                    if left and left < each:
                        slots.append((length, rank, rank + left, rest[0], left, capacity - room))
                        rooms.setdefault(room - left * length, []).append((rest[0], 1))
                        rank, left = rank + left, 0
                        rest = (rest[0] + 1, rest[1] - 1)
                    if rest[1]:
                        waiting.append(rest)
            if waiting:
                rooms.setdefault(room, []).extend(waiting)
        if left:
            each = capacity // length
            full = left // each
            if full:
                slots.append((length, rank, rank + full * each, used, each, 0))
                rooms.setdefault(capacity - each * length, []).append((used, full))
                rank, left, used = rank + full * each, left - full * each, used + full
            if left:
                slots.append((length, rank, rank + left, used, left, 0))
                rooms.setdefault(capacity - left * length, []).append((used, 1))
                used += 1
    return slots


def ranked(pieces: DataFrame, parts: int = RANK_PARTS) -> DataFrame:
    """Add ``rank``: a number from 0 without gaps among the pieces of the same length.

    A length that very many pieces have (copies, full pieces) is ranked in parts dealt by their place in the table, so
    equal pieces are spread too; each part starts after the lower parts, and there are at most capacity * parts of them.
    """
    spread = F.pmod(F.xxhash64("doc_id", "piece", F.monotonically_increasing_id()), F.lit(parts)).cast("int")
    rows = written(pieces.withColumn("part", spread), "pack-parts")
    counts = rows.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    lower = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "part", F.coalesce(F.sum("n").over(lower), F.lit(0)).alias("first"))
    within = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "ids_crc32")
    return (
        rows.withColumn("own", F.row_number().over(within) - 1)
        .join(first, ["length", "part"])
        .withColumn("rank", F.col("first") + F.col("own"))
        .drop("part", "own", "first")
    )


def packed(spark: SparkSession, pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Give each piece a sequence and an offset there.

    The histogram has at most ``capacity`` rows; the plan made from it depends on the lengths alone and goes to
    every task: it has a few rows for each pair of lengths at most, so its bound is the square of the capacity. Pieces
    find their slot by length and rank. No pieces give no rows; repeated rows are pieces of their own.
    """
    pieces = pieces.select("doc_id", "piece", "start", "length", "ids_crc32")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    slots = spark.createDataFrame(plan(histogram, capacity), SLOT_SCHEMA)
    parts = max(RANK_PARTS, -(-max(histogram.values(), default=0) // RANK_PIECES))
    rows = ranked(pieces, parts)
    slot = slots.withColumnRenamed("length", "slot_length")
    inside = F.col("rank") - F.col("first_rank")
    return (
        rows.join(
            F.broadcast(slot),
            (F.col("length") == F.col("slot_length"))
            & (F.col("rank") >= F.col("first_rank"))
            & (F.col("rank") < F.col("last_rank")),
        )
        .withColumn("sequence_id", F.col("first_sequence") + F.floor(inside / F.col("per_sequence")).cast("long"))
        .withColumn("offset", F.col("place") + F.pmod(inside, F.col("per_sequence")) * F.col("length"))
        .select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    )


def pack_documents(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """Pack all documents into few sequences of at most ``capacity`` ids.

    Null and empty texts are a piece that holds the end id; repeated rows and ids are pieces of their own; an empty
    table gives no rows.
    """
    pieces = written(pieces_of(docs, capacity, end_id, vocabulary), "pack-pieces")
    return packed(docs.sparkSession, pieces, capacity)


def sequences(docs: DataFrame, capacity: int = 2048, end_id: int = 0, vocabulary: str | None = None) -> DataFrame:
    """The packed sequences themselves: sequence_id, length and ids (little-endian 32-bit integers) of each."""
    pieces = written(pieces_of(docs, capacity, end_id, vocabulary, with_ids=True), "pack-ids")
    places = packed(docs.sparkSession, pieces, capacity).select("doc_id", "piece", "ids_crc32", "sequence_id", "offset")
    number = Window.partitionBy("doc_id", "piece", "ids_crc32").orderBy(F.lit(1))
    left = pieces.withColumn("copy", F.row_number().over(number))
    right = places.withColumn("copy", F.row_number().over(number))
    return (
        left.join(right, ["doc_id", "piece", "ids_crc32", "copy"])
        .groupBy("sequence_id")
        .agg(F.sum("length").alias("length"), F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("parts"))
        .select("sequence_id", "length", F.expr("aggregate(parts, X'', (all, p) -> concat(all, p.ids))").alias("ids"))
    )
