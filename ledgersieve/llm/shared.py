"""What the operators share: the shared folder, tables written there, bounded labelled samples."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersieve.session import scratch_dir


def written(df: DataFrame, label: str) -> DataFrame:
    """Write a table to the shared folder and read it back: cuts lineage, and a lost executor costs nothing."""
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, label: str) -> str:
    """Make a folder for files that tasks write themselves."""
    path = scratch_dir(spark, label)
    filesystem, inner = open_fs(path)
    filesystem.create_dir(inner, recursive=True)
    return path


def open_fs(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and inner path of a URI or of an absolute path."""
    return fs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", uri))


def held_out_is(column: str, parts: int, rest: int) -> Column:
    """Whether crc32 of the id as text leaves this remainder. A null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit(""))) % parts == rest


def training_text(text: Column, max_bytes: int) -> Column:
    """A text as training takes it: whole, or, if it has more bytes, four windows spread evenly over it.

    Only training uses this; scoring reads whole texts.
    """
    wide = max_bytes // 16  # a character has four bytes at most
    length = F.char_length(text)
    windows = [F.substring(text, (F.floor((length - wide) * k / 3) + 1).cast("int"), F.lit(wide)) for k in range(4)]
    return F.when(F.octet_length(text) <= max_bytes, text).otherwise(F.concat_ws(" ", *windows))


#: Bits of a stored bitmap, as Spark's bitmap functions have them; bits for each key and in all of ``marked``.
BITMAP_BITS = 32_768
KEY_BITS = 16
MOST_BITS = 1 << 26


def marked(rows: DataFrame, column: str, keys: DataFrame, mark: str) -> DataFrame:
    """Add whether a row's value may be among some keys (a table of one column of that name).

    A bitmap of the keys' hashes, 8 MB at most, goes to all tasks, and no row is shuffled. It is true for each row with a
    key and, up to four million keys, for about one in 16 of the others (for more of them if there are more keys).
    """
    own = "__"
    while any(c.lower().startswith(own) for c in [*rows.columns, mark]):
        own = f"_{own}"
    place, bucket, bitmap = (f"{own}{name}" for name in ("place", "bucket", "bitmap"))
    bits = max(BITMAP_BITS, min(MOST_BITS, KEY_BITS * keys.count()))
    hashed = F.pmod(F.xxhash64(F.col(column).cast("long")), F.lit(bits))
    places = keys.select(hashed.alias(place)).select(
        F.bitmap_bucket_number(place).alias(bucket), F.bitmap_bit_position(place).alias(place)
    )
    # Places are shuffled, not a bitmap of each task.
    maps = places.repartition(bucket).groupBy(bucket).agg(F.bitmap_construct_agg(place).alias(bitmap))
    asked = rows.withColumn(place, F.bitmap_bit_position(hashed)).withColumn(bucket, F.bitmap_bucket_number(hashed))
    byte = F.conv(F.hex(F.substring(bitmap, (F.floor(F.col(place) / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = byte.bitwiseAND(F.pow(F.lit(2), F.col(place) % 8).cast("int")) != 0
    found = asked.join(F.broadcast(maps), bucket, "left")
    return found.select(*(F.col(f"`{c}`") for c in rows.columns), F.coalesce(hit, F.lit(False)).alias(mark))


def possibly_in(rows: DataFrame, column: str, keys: DataFrame) -> DataFrame:
    """Rows that ``marked`` doesn't rule out, so that others needn't be shuffled; an exact join has to follow."""
    mark = "may_be"
    while mark in rows.columns:
        mark = f"_{mark}"
    return marked(rows, column, keys, mark).where(F.col(mark)).drop(mark)


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, rows: int, max_bytes: int = 65_536
) -> list[tuple[str, int]]:
    """At most ``rows`` (text, label) pairs on the driver, chosen by a hash of the id from all labelled documents.

    Labels of documents that are not there, or are held out, don't count towards the bound: ids meet before it. What
    is sent to every task is the bounded choice. Ids with different labels in two rows take the larger one; of rows that
    repeat an id the least texts come first. Null texts don't take part; of texts over ``max_bytes`` windows do (see
    ``training_text``), so the driver holds at most rows * max_bytes and usually much less.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.where("doc_id is not null and text is not null")
    labelled = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    there = texts.select("doc_id").distinct()
    chosen = labelled.join(there, "doc_id", "left_semi").orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    cut = texts.withColumn("text", training_text(F.col("text"), max_bytes))
    found = cut.join(F.broadcast(chosen), "doc_id").orderBy(F.xxhash64("doc_id"), "doc_id", "text").limit(rows)
    return [(row.text, row.label) for row in found.collect()]


def text_chunks(
    batches: Iterable[pa.RecordBatch], size: int = 4_000_000, column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Cut Arrow batches into runs of rows with about ``size`` characters, so that memory follows the longest text."""
    for batch in batches:
        texts = batch.column(column).to_pylist()
        start = total = 0
        for i, text in enumerate(texts):
            total += len(text) if text else 0
            if total >= size:
                yield batch.slice(start, i + 1 - start), texts[start : i + 1]
                start, total = i + 1, 0
        if start < len(texts):
            yield batch.slice(start), texts[start:]
        del texts
        pa.default_memory_pool().release_unused()


def scored(
    docs: DataFrame,
    make: Callable[[], Callable[[list[str | None]], list[pa.Array]]],
    added: str,
    keep_text: bool = True,
) -> DataFrame:
    """Add columns that a function makes from runs of whole texts. ``make`` is called once a task.

    ``added`` names them with their types; columns of the input with such names are replaced.
    """
    fields = T.StructType.fromDDL(added).fields
    rows = docs.drop(*(f.name for f in fields)).withColumn("text", F.col("text").cast("string"))
    kept = [f for f in rows.schema.fields if keep_text or f.name != "text"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        score = make()
        for batch, texts in text_chunks(batches):
            columns = [batch.column(f.name) for f in kept] + score(texts)
            yield pa.RecordBatch.from_arrays(columns, names=[f.name for f in kept + fields])

    return rows.mapInArrow(run, T.StructType(kept + fields))
