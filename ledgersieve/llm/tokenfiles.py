"""Files of token ids: frequency-ranked, byte-aligned, with the control bytes apart from the data bytes."""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgersieve.llm.shared import new_folder, open_fs, text_chunks, written
from ledgersieve.llm.tokens import binary, encoder

MAGIC = b"FRVB0001"
BLOCK_IDS = 2_000_000
#: Rows with one id are dealt to so many ranges.
EQUAL_PARTS = 64
#: Bytes of the four values whose two-bit lengths a control byte holds.
LENGTHS = (((np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3) + 1).astype(np.uint8)
FILE_SCHEMA = "part int, file string, documents long, ids long"
ROW_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long"


def encode_values(values: np.ndarray) -> tuple[bytes, bytes]:
    """Control bytes (four values each, lowest bits first) and data bytes (1 to 4 a value, little-endian)."""
    values = values.astype("<u4", copy=False)
    codes = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    most = int(values.max()) if len(values) else 0
    widest = 1 + sum(most > limit for limit in (0xFF, 0xFFFF, 0xFFFFFF))
    for limit in (0xFF, 0xFFFF, 0xFFFFFF)[: widest - 1]:
        codes[: len(values)] += values > limit
    four = codes.reshape(-1, 4)
    control = four[:, 0] | four[:, 1] << 2 | four[:, 2] << 4 | four[:, 3] << 6
    used = np.arange(widest, dtype=np.uint8) <= codes[: len(values), None]
    data = values.view(np.uint8).reshape(-1, 4)[:, :widest][used]
    return control.tobytes(), data.tobytes()


def decode_values(control: bytes, data: bytes, n: int) -> np.ndarray:
    """Inverse of ``encode_values``: lengths come from a table of the 256 control bytes."""
    size = LENGTHS[np.frombuffer(control, np.uint8)].ravel()[:n]
    start = np.cumsum(size, dtype=np.int64) - size
    raw = np.frombuffer(data, np.uint8)
    out = raw[start].astype(np.uint32) if n else np.zeros(0, np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(size > k)
        if not len(longer):
            break
        out[longer] |= raw[start[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return out


def tokenised(docs: DataFrame, end_id: int, vocabulary: str | None = None) -> DataFrame:
    """doc_id, n_tokens and ids (little-endian, 16 bits if all ids of the run fit, else 32) of each document.

    Each task adds a row without ids, whose ``seen`` holds the ids it has met and how often.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1, np.int64)
        for batch, texts in text_chunks(batches):
            ids, ends = encoder(vocabulary).encode(texts, end_id)
            wide = bool(len(ids)) and int(ids.max()) > 0xFFFF
            met = np.bincount(ids)
            if len(met) > len(total):
                total = np.pad(total, (0, len(met) - len(total)))
            total[: len(met)] += met
            counts = np.diff(ends, prepend=0)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    pa.array(counts),
                    pa.array(np.full(len(texts), 4 if wide else 2, np.int32)),
                    binary(ids.astype("<u4" if wide else "<u2"), ends),
                    pa.nulls(len(texts), pa.binary()),
                ],
                names=["doc_id", "n_tokens", "width", "ids", "seen"],
            )
        met = np.flatnonzero(total)
        seen = np.concatenate([met, total[met]]).astype("<i8").tobytes()
        nothing = [pa.nulls(1, kind) for kind in (pa.int64(), pa.int64(), pa.int32(), pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [*nothing, pa.array([seen], pa.binary())], names=["doc_id", "n_tokens", "width", "ids", "seen"]
        )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, n_tokens long, width int, ids binary, seen binary")


def _ids(raw: bytes, width: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if width == 2 else "<u4").astype(np.uint32)


def id_counts(tokens: DataFrame) -> DataFrame:
    """How often each id occurs in the whole corpus, from the rows in which each task told what it has met."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for raw in batch.column("seen").to_pylist():
                ids, times = np.frombuffer(raw, "<i8").reshape(2, -1)
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(times)], names=["id", "n"])

    told = tokens.select("seen").where("seen is not null")
    return told.mapInArrow(run, "id long, n long").groupBy("id").agg(F.sum("n").alias("n"))


def writer(folder: str, ranks: np.ndarray, block_ids: int) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the documents of a task, in their order, to one file; say its name and what it holds.

    A file is: magic, then blocks of (documents, ids, bytes of control, bytes of data; 64 bits each), doc_ids, the
    flags of null doc_ids, ids per document, control bytes, data bytes and the block's crc32, then a zero word. A
    block ends with the document that fills it. File names are new on each attempt, and only names in the table that
    Spark commits count.
    """

    def block(doc_ids: list, runs: list[np.ndarray]) -> bytes:
        ids = np.concatenate(runs)
        control, data = encode_values(ranks[ids])
        body = (
            struct.pack("<4Q", len(runs), len(ids), len(control), len(data))
            + np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes()
            + np.array([d is None for d in doc_ids], np.uint8).tobytes()
            + np.array([len(r) for r in runs], "<u8").tobytes()
            + control
            + data
        )
        return body + struct.pack("<I", zlib.crc32(body))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        filesystem, inner = open_fs(folder)
        name = f"{uuid.uuid4().hex}.frvb"
        documents = total = held = 0
        doc_ids: list = []
        runs: list[np.ndarray] = []
        with filesystem.open_output_stream(f"{inner}/{name}", compression=None) as out:
            out.write(MAGIC)
            for batch in batches:
                columns = (batch.column(c).to_pylist() for c in ("doc_id", "ids", "width"))
                for doc_id, raw, width in zip(*columns, strict=True):
                    ids = _ids(raw, width)
                    doc_ids.append(doc_id)
                    runs.append(ids)
                    held += len(ids)
                    if held >= block_ids:
                        out.write(block(doc_ids, runs))
                        documents, total = documents + len(runs), total + held
                        doc_ids, runs, held = [], [], 0
            if runs:
                out.write(block(doc_ids, runs))
                documents, total = documents + len(runs), total + held
            out.write(struct.pack("<Q", 0))
        if documents:
            context = TaskContext.get()
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([context.partitionId()], pa.int32()),
                    pa.array([name]),
                    pa.array([documents]),
                    pa.array([total]),
                ],
                names=["part", "file", "documents", "ids"],
            )
        else:
            filesystem.delete_file(f"{inner}/{name}")

    return run


def read_blocks(folder: str, file: str, by_rank: np.ndarray) -> Iterator[tuple[list, np.ndarray, np.ndarray]]:
    """doc_ids, ids per document and all ids of each block of a file."""
    filesystem, inner = open_fs(folder)
    with filesystem.open_input_stream(f"{inner}/{file}", compression=None) as source:
        if source.read(len(MAGIC)) != MAGIC:
            raise ValueError(f"{file} is not a token file")
        while True:
            head = source.read(8)
            documents = struct.unpack("<Q", head)[0]
            if not documents:
                return
            head += source.read(24)
            _, n, controls, bytes_ = struct.unpack("<4Q", head)
            body = source.read(documents * 17 + controls + bytes_)
            if struct.unpack("<I", source.read(4))[0] != zlib.crc32(head + body):
                raise ValueError(f"a block of {file} is damaged")
            doc_ids = np.frombuffer(body, "<i8", documents)
            null = np.frombuffer(body, np.uint8, documents, 8 * documents)
            counts = np.frombuffer(body, "<u8", documents, 9 * documents).astype(np.int64)
            at = 17 * documents
            ids = by_rank[decode_values(body[at : at + controls], body[at + controls :], n)]
            yield [None if z else int(d) for d, z in zip(doc_ids, null, strict=True)], counts, ids


def write_token_files(
    docs: DataFrame,
    folder: str | None = None,
    end_id: int = 1,
    vocabulary: str | None = None,
    block_ids: int = BLOCK_IDS,
) -> tuple[str, DataFrame, np.ndarray]:
    """Encode all documents and write their ids in ascending doc_id order (null first; ties by their ids in a file).

    Rows that share an id, or have none, are dealt to as many files as their size needs.

    Returns the folder, the table of its files in order (part, file, documents, ids, first: ids before the file) and
    the ids by rank. Ranks follow the frequency in the whole corpus, ties the smaller id; there are no more of them
    than the vocabulary has ids, which bounds what the driver and the tasks hold. ``ranks.u4`` in the folder keeps
    them. An empty table gives no files.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "token-files")
    tokens = written(tokenised(docs, end_id, vocabulary), "token-ids")
    counts = [(row.id, row.n) for row in id_counts(tokens).collect()]
    by_rank = np.array([i for i, _ in sorted(counts, key=lambda p: (-p[1], p[0]))], np.uint32)
    ranks = np.zeros(int(by_rank.max()) + 1 if len(by_rank) else 1, np.uint32)
    ranks[by_rank] = np.arange(len(by_rank), dtype=np.uint32)
    filesystem, inner = open_fs(folder)
    with filesystem.open_output_stream(f"{inner}/ranks.u4", compression=None) as out:
        out.write(by_rank.astype("<u4").tobytes())
    documents = tokens.where("ids is not null").drop("seen")
    spread = documents.withColumn("deal", F.pmod(F.monotonically_increasing_id(), F.lit(EQUAL_PARTS)))
    ordered = spread.repartitionByRange("doc_id", "deal").drop("deal").sortWithinPartitions("doc_id", "ids")
    files = written(ordered.mapInArrow(writer(folder, ranks, block_ids), FILE_SCHEMA), "token-manifest")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return folder, files.withColumn("first", F.coalesce(F.sum("ids").over(before), F.lit(0))), by_rank


def read_token_files(folder: str, files: DataFrame, by_rank: np.ndarray) -> DataFrame:
    """Decode the files: doc_id, start, n_tokens and the crc32 of the ids as little-endian 32-bit integers."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, first in zip(batch.column("file").to_pylist(), batch.column("first").to_pylist(), strict=True):
                for doc_ids, counts, ids in read_blocks(folder, file, by_rank):
                    ends = np.cumsum(counts)
                    raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                    begins = ends - counts
                    crc = [
                        zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)
                    ]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(doc_ids, pa.int64()),
                            pa.array(first + begins),
                            pa.array(counts),
                            pa.array(crc, pa.int64()),
                        ],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )
                    first += int(ends[-1])

    spread = files.select("file", "first").repartition(max(1, files.sparkSession.sparkContext.defaultParallelism), "file")
    return spread.mapInArrow(run, ROW_SCHEMA)
