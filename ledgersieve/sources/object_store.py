"""Feeds and landing listings in an object store, read in place through the Hadoop file systems."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve import files as store
from ledgersieve.sources.csv_feeds import FeedSource

LISTING = "path string, length long, modificationTime timestamp"
PAGE = 10_000


def object_uri(bucket: str, prefix: str, filename: str, scheme: str = "s3a") -> str:
    key = f"{prefix.rstrip('/')}/{filename}" if prefix else filename
    return f"{scheme}://{bucket}/{key}"


def object_store_sources(
    spark: SparkSession,
    bucket: str,
    prefix: str,
    filenames: dict[str, str],
    dry_run: bool = False,
    scheme: str = "s3a",
) -> list[FeedSource]:
    """Resolve each source's object. A dry run only names the objects; otherwise a missing one is an error."""
    if not bucket:
        raise ValueError("a bucket name is required")
    sources = [
        FeedSource(name, (object_uri(bucket, prefix, filename, scheme),))
        for name, filename in filenames.items()
    ]
    if not dry_run:
        for source in sources:
            for path in source.paths:
                _require(spark, path)
    return sources


def _require(spark: SparkSession, path: str) -> None:
    try:
        spark.read.text(path)  # only resolves the path; reads nothing
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"feed object not found: {path}") from error
        raise


def landing_manifest(spark: SparkSession, root: str) -> DataFrame:
    """Objects under a landing folder with their sizes. File contents are not read.

    Spark's file listing leaves out names that start with ``_`` or ``.`` (files and folders), and so does this.
    """
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .load(root)
        .select("path", "length", "modificationTime")
    )


def whole_listing(spark: SparkSession, root: str, target: str) -> DataFrame:
    """All objects under a landing folder, also those whose names start with ``_`` or ``.``, stored under ``target``.

    The listing is asked of the file system itself, as Spark's own leaves such names out. It comes in pages that are
    written one by one, so the driver holds a page however many objects there are. Columns as ``landing_manifest``.
    """
    page: list[tuple[str, int, float]] = []

    def write() -> None:
        rows = spark.createDataFrame(page, "path string, length long, seconds double")
        rows.select("path", "length", F.timestamp_seconds("seconds").alias("modificationTime")).coalesce(1).write.mode(
            "append"
        ).parquet(target)
        page.clear()

    for path, length, modified in store.walked(spark, root):
        page.append((path, length, modified / 1000))
        if len(page) == PAGE:
            write()
    write()
    return spark.read.schema(LISTING).parquet(target)


def listing_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """What differs between two listings of a folder: path, change (new, changed or gone) and both lengths.

    An object has changed if its length or its modification time has. Unchanged ones have no row.
    """
    old, new = (
        rows.select("path", F.col("length").alias(f"{name}_length"), F.col("modificationTime").alias(f"{name}_time"))
        for name, rows in (("old", before), ("new", after))
    )
    same = F.col("old_length").eqNullSafe(F.col("new_length")) & F.col("old_time").eqNullSafe(F.col("new_time"))
    change = F.when(F.col("old_length").isNull(), "new").when(F.col("new_length").isNull(), "gone").otherwise("changed")
    return old.join(new, "path", "full").where(~same).select("path", change.alias("change"), "old_length", "new_length")
