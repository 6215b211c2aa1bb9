"""WARC archives as seekable zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.llm.shared import new_folder, open_fs, written

#: Fixed values of the seekable zstandard format.
SKIPPABLE_MAGIC = 0x184D2A5E
SEEKABLE_MAGIC = 0x8F92EAB1
FRAME_BYTES = 1 << 20
BUNDLE_BYTES = 256 << 20
REVISIT_FROM = 1000
SALTS = 16
#: Frames that one read takes.
FRAMES_A_READ = 16
WARC_DATE = "2024-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
INDEX = pa.schema(
    [
        ("page_id", pa.int64()),
        ("bundle", pa.string()),
        ("frame", pa.int32()),
        ("frame_start", pa.int64()),
        ("offset", pa.int64()),
        ("length", pa.int64()),
    ]
)
INDEX_SCHEMA = "page_id long, bundle string, frame int, frame_start long, offset long, length long"
READ = pa.schema(
    [
        ("page_id", pa.int64()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)
READ_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def with_types(pages: DataFrame, revisit_from: int = REVISIT_FROM, salts: int = SALTS) -> DataFrame:
    """page_id, url, payload, payload_digest, record_type and refers_to of each page.

    Of equal payloads of at least ``revisit_from`` bytes the one with the largest page_id is the response and the
    others revisit it. Repeated rows of that page_id are all responses. Where all ids of a group are null there is
    nothing to refer to, so all are responses. A null payload is empty, and smaller payloads are all responses.

    Only groups of two and more are joined to the pages, on digest and a salt that all rows have, so one payload that a
    third of all pages have is spread over many tasks, whatever its size is and also if whole rows are equal.
    """
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        payload.alias("payload"),
    ).withColumn("payload_digest", F.sha1("payload"))
    large = F.octet_length("payload") >= revisit_from
    groups = (
        rows.where(large)
        .groupBy("payload_digest")
        .agg(F.max("page_id").alias("newest"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and newest is not null")
        .select(
            "payload_digest", "newest", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt")
        )
    )
    salted = rows.withColumn("salt", F.pmod(F.monotonically_increasing_id(), F.lit(salts)).cast("int"))
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return salted.join(groups, ["payload_digest", "salt"], "left").select(
        "page_id",
        "url",
        "payload",
        "payload_digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("newest")).alias("refers_to"),
    )


def record(
    page_id: int | None, url: str | None, payload: bytes, digest: str, kind: str, refers_to: int | None
) -> bytes:
    """One WARC/1.1 record. A revisit holds the HTTP header only; the payload's size is kept in its own field."""
    name = "null" if page_id is None else page_id
    target = "".join(url.split()) if url else ""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http + payload if kind == "response" else http
    fields = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{name}>",
        f"WARC-Date: {WARC_DATE}",
        f"WARC-Target-URI: {target or f'urn:page:{name}'}",
        f"WARC-Payload-Digest: sha1:{base64.b32encode(bytes.fromhex(digest)).decode()}",
        f"WARC-Payload-Length: {len(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if kind == "revisit":
        fields += [f"WARC-Profile: {REVISIT_PROFILE}", f"WARC-Refers-To: <urn:page:{refers_to}>"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


class Bundle:
    """A file of independent zstandard frames that ends with a seek table."""

    def __init__(self, stream: pa.NativeFile, level: int):
        self.stream, self.compressor = stream, zstandard.ZstdCompressor(level=level)
        self.sizes: list[tuple[int, int]] = []
        self.size = 0

    def add(self, content: bytes) -> None:
        frame = self.compressor.compress(content)
        self.stream.write(frame)
        self.sizes.append((len(frame), len(content)))
        self.size += len(frame)

    def close(self) -> None:
        """Write the seek table, a skippable frame: sizes of each frame, their number, a descriptor and a magic."""
        table = b"".join(struct.pack("<II", *s) for s in self.sizes)
        table += struct.pack("<IBI", len(self.sizes), 0, SEEKABLE_MAGIC)
        self.stream.write(struct.pack("<II", SKIPPABLE_MAGIC, len(table)) + table)
        self.stream.close()


def seek_table(source: pa.NativeFile) -> list[tuple[int, int, int]]:
    """Start, compressed and plain size of each frame, from the end of a file."""
    size = source.size()
    source.seek(size - 9)
    frames, _, magic = struct.unpack("<IBI", source.read(9))
    if magic != SEEKABLE_MAGIC:
        raise ValueError("the file has no seek table")
    source.seek(size - 9 - 8 * frames)
    flat = struct.unpack(f"<{2 * frames}I", source.read(8 * frames))
    out, at = [], 0
    for packed, plain in zip(flat[::2], flat[1::2], strict=True):
        out.append((at, packed, plain))
        at += packed
    return out


def writer(
    folder: str, frame_bytes: int, bundle_bytes: int, level: int
) -> Callable[[Iterable[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Write the pages of a task to bundles; one index row a record.

    A frame is closed when it has ``frame_bytes`` (a longer record is a frame of its own with what came before), so
    a task holds about one frame. Names are new on each attempt: only bundles in the index that Spark commits count.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = open_fs(folder)
        bundle, name = None, ""
        parts: list[bytes] = []
        held = 0
        waiting: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal parts, held, waiting
            rows = [(p, name, len(bundle.sizes), bundle.size, at, n) for p, at, n in waiting]
            bundle.add(b"".join(parts))
            parts, held, waiting = [], 0, []
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), INDEX, strict=True)], schema=INDEX
            )

        for batch in batches:
            columns = [
                batch.column(c).to_pylist()
                for c in ("page_id", "url", "payload", "payload_digest", "record_type", "refers_to")
            ]
            for row in zip(*columns, strict=True):
                if bundle is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    bundle = Bundle(filesystem.open_output_stream(f"{inner}/{name}", compression=None), level)
                content = record(*row)
                waiting.append((row[0], held, len(content)))
                parts.append(content)
                held += len(content)
                if held >= frame_bytes:
                    yield flush()
                    if bundle.size >= bundle_bytes:
                        bundle.close()
                        bundle = None
        if bundle is not None:
            if parts:
                yield flush()
            bundle.close()

    return run


def write_archive(
    pages: DataFrame,
    folder: str | None = None,
    frame_bytes: int = FRAME_BYTES,
    bundle_bytes: int = BUNDLE_BYTES,
    level: int = 3,
) -> tuple[str, DataFrame]:
    """Write a record for each page; returns the folder and the index.

    The index maps page_id to bundle, frame, the frame's place in the bundle, and offset and length within the plain
    frame. It is a table in the shared folder. An empty table gives no bundles and an empty index.
    """
    folder = folder or new_folder(pages.sparkSession, "warc")
    run = writer(folder, frame_bytes, bundle_bytes, level)
    return folder, written(with_types(pages).mapInArrow(run, INDEX_SCHEMA), "warc-index")


def parse(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Header fields and block of each record of a plain frame."""
    at = 0
    while at < len(content):
        end = content.index(b"\r\n\r\n", at)
        lines = content[at:end].decode().split("\r\n")
        if lines[0] != "WARC/1.1":
            raise ValueError("not a WARC record")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        start = end + 4
        stop = start + int(fields["Content-Length"])
        yield fields, content[start:stop]
        at = stop + 4


def _id(urn: str) -> int | None:
    text = urn.removeprefix("<urn:page:").removesuffix(">")
    return None if text == "null" else int(text)


def described(fields: dict[str, str], block: bytes) -> tuple:
    """A row of the query; a response's payload is held against its digest and size."""
    digest = base64.b32decode(fields["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    size = int(fields["WARC-Payload-Length"])
    if fields["WARC-Type"] == "response":
        payload = block[block.index(b"\r\n\r\n") + 4 :]
        if len(payload) != size or hashlib.sha1(payload).hexdigest() != digest:
            raise ValueError(f"the payload of {fields['WARC-Record-ID']} is damaged")
    refers = fields.get("WARC-Refers-To")
    return _id(fields["WARC-Record-ID"]), size, digest, fields["WARC-Type"], refers and _id(refers)


def read_archive(folder: str, index: DataFrame, frames: int = FRAMES_A_READ) -> DataFrame:
    """Read all bundles of an index back, frame by frame by their seek tables; runs of frames go to tasks of their own."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = open_fs(folder)
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            for name, part in zip(batch.column("bundle").to_pylist(), batch.column("part").to_pylist(), strict=True):
                with filesystem.open_input_file(f"{inner}/{name}") as source:
                    for start, packed, _ in seek_table(source)[part * frames : (part + 1) * frames]:
                        source.seek(start)
                        rows = [described(*r) for r in parse(plain.decompress(source.read(packed)))]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(c, t.type) for c, t in zip(zip(*rows, strict=True), READ, strict=True)],
                            schema=READ,
                        )

    runs = index.select("bundle", F.floor(F.col("frame") / frames).cast("int").alias("part")).distinct()
    runs = written(runs, "warc-reads")
    return runs.repartition(max(1, runs.count()), "bundle", "part").mapInArrow(run, READ_SCHEMA)


def fetch(folder: str, index: DataFrame, ids: DataFrame) -> DataFrame:
    """Records of some pages: page_id and the record's bytes. Reads only the frames that hold them."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, inner = open_fs(folder)
        plain = zstandard.ZstdDecompressor()
        for batch in batches:
            for row in batch.to_pylist():
                with filesystem.open_input_file(f"{inner}/{row['bundle']}") as source:
                    _, packed, _ = seek_table(source)[row["frame"]]
                    source.seek(row["frame_start"])
                    content = plain.decompress(source.read(packed))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["page_id"]], pa.int64()),
                        pa.array([content[row["offset"] : row["offset"] + row["length"]]], pa.binary()),
                    ],
                    names=["page_id", "record"],
                )

    wanted = index.join(ids.select("page_id").distinct(), "page_id", "left_semi")
    return wanted.mapInArrow(run, "page_id long, record binary")
