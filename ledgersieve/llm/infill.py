"""Fill-in-the-middle by block rotation inside one byte buffer, and its inverse."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersieve.llm.shared import text_chunks

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
SENTINELS = (PREFIX, SUFFIX, MIDDLE)
PLAIN_FROM = 90
SUFFIX_FIRST_BELOW = 20
DRAWS = ("__draw1", "__draw2", "__draw3", "__draw4")
ADDED = "form string, prefix_chars long, middle_chars long, output string"


def draws(seed: int, key: str = "doc_id") -> list[Column]:
    """Four unsigned 32-bit draws of a row: the first groups of the sha256 of the seed, a colon and the id in decimal.

    A null id counts as the empty text.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(DRAWS[k]) for k in range(4)]


def rotate(buffer: bytearray, begin: int, cut: int, end: int) -> None:
    """Exchange buffer[begin:cut] and buffer[cut:end] in place: reverse each, then both together."""
    for low, high in ((begin, cut), (cut, end), (begin, end)):
        block = np.frombuffer(buffer, np.uint8)[low:high]
        half = len(block) // 2
        mirror = block[len(block) - half :][::-1].copy()
        block[len(block) - half :] = block[:half][::-1]
        block[:half] = mirror


def rearranged(text: bytes, first: int, second: int, suffix_first: bool) -> bytes:
    """The text with sentinels before its three parts; the middle last, and the suffix before the prefix if asked for.

    ``first`` and ``second`` are the byte offsets of the cuts.
    """
    buffer = bytearray(text)
    for at, sentinel in ((second, SUFFIX), (first, MIDDLE), (0, PREFIX)):
        buffer[at:at] = sentinel
    # Now prefix, middle, suffix, each after its sentinel: the suffix goes before the middle, or before both.
    rotate(buffer, 0 if suffix_first else first + 3, second + 6, len(buffer))
    return bytes(buffer)


def restored(output: bytes, form: str) -> bytes:
    """The text that ``rearranged`` was given, from its output and form alone.

    The text holds no sentinel and sentinels don't overlap, so each occurs once: they say where the segments begin.
    """
    if form == "plain":
        return output
    buffer = bytearray(output)
    if form == "spm":
        rotate(buffer, 0, output.index(PREFIX), len(buffer))
    else:
        start, cut = output.index(SUFFIX), output.index(MIDDLE)
        rotate(buffer, start, cut, len(buffer))
    for sentinel in (SUFFIX, MIDDLE, PREFIX):  # last first, so that the earlier places stay
        at = buffer.rindex(sentinel)
        del buffer[at : at + 3]
    return bytes(buffer)


def code_point_starts(text: bytes) -> np.ndarray:
    """Byte offset of each code point of UTF-8 text."""
    return np.flatnonzero((np.frombuffer(text, np.uint8) & 0xC0) != 0x80)


def transform(docs: DataFrame, seed: int = 1, key: str = "doc_id") -> DataFrame:
    """Each row's ``form``, ``prefix_chars``, ``middle_chars`` and ``output`` (the text to train on).

    A text of n code points is cut at two places drawn from 0 to n; a part may be empty. It stays as it is (plain, no
    counts) if it is empty or null, holds a sentinel, or the third draw says so; the fourth decides between psm and
    spm. The draws depend on the seed and the id alone, so repeated rows with one id give the same output; a null id
    counts as the empty text. Other columns are kept; columns named like the added ones are replaced, and such as have
    the names of ``DRAWS`` are left out. Rows are worked on one by one in runs of a bounded number of characters, nothing is shuffled. An empty table gives no rows.
    """
    fields = T.StructType.fromDDL(ADDED).fields
    names = {f.name for f in fields}
    base = docs.drop(*names, *DRAWS).withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit("")))
    rows = base.select("*", *draws(seed, key))
    kept = base.schema.fields

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in text_chunks(batches):
            h = [batch.column(name).to_pylist() for name in DRAWS]
            form, prefix, middle, output = [], [], [], []
            for text, h1, h2, h3, h4 in zip(texts, *h, strict=True):
                raw = text.encode()
                if not raw or h3 % 100 >= PLAIN_FROM or any(s in raw for s in SENTINELS):
                    for column, value in ((form, "plain"), (prefix, None), (middle, None), (output, text)):
                        column.append(value)
                    continue
                starts = code_point_starts(raw)
                n = len(starts)
                low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
                first, second = (len(raw) if c == n else int(starts[c]) for c in (low, high))
                suffix_first = h4 % 100 < SUFFIX_FIRST_BELOW
                form.append("spm" if suffix_first else "psm")
                prefix.append(low)
                middle.append(high - low)
                output.append(rearranged(raw, first, second, suffix_first).decode())
            made = [pa.array(form, pa.string()), pa.array(prefix, pa.int64()), pa.array(middle, pa.int64()), pa.array(output, pa.string())]
            columns = [batch.column(f.name) for f in kept] + made
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept] + [f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(kept + fields))


def restore(made: DataFrame) -> DataFrame:
    """Add ``restored``: the text before the transformation, from ``output`` and ``form`` alone."""
    rows = made.drop("restored")
    fields = [*rows.schema.fields, T.StructField("restored", T.StringType())]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, outputs in text_chunks(batches, column="output"):
            texts = [
                restored((output or "").encode(), form).decode()
                for output, form in zip(outputs, batch.column("form").to_pylist(), strict=True)
            ]
            columns = [batch.column(f.name) for f in fields[:-1]] + [pa.array(texts, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in fields])

    return rows.mapInArrow(run, T.StructType(fields))


def digest_rows(docs: DataFrame, seed: int = 1) -> DataFrame:
    """doc_id, n, form, prefix_chars, middle_chars and the sha256 of each output and of the text restored from it."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    back = restore(transform(rows, seed).drop("text"))
    return back.select(
        "doc_id",
        F.char_length("restored").cast("long").alias("n"),
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("restored", 256).alias("restored_sha256"),
    )
