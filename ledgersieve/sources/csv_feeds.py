"""CSV feed scans: text columns found by header name, one scan per header, sources unioned."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgersieve.schemas import FEED_FIELDS
from ledgersieve.sources.quoted_csv import scan_quoted


@dataclass(frozen=True)
class FeedSource:
    """A named feed. Files under one path must share a header; give files that differ as separate paths.

    ``multiline`` allows line breaks inside quotes. Spark then reads each file in one task; with ``strict_quotes``
    many tasks read a file, for which every quote must enclose a field or be doubled inside one (see ``quoted_csv``).
    """

    name: str
    paths: tuple[str, ...]
    multiline: bool = False
    strict_quotes: bool = False

    def __post_init__(self) -> None:
        if not self.name:
            raise ValueError("a feed source needs a name")
        if isinstance(self.paths, str):
            object.__setattr__(self, "paths", (self.paths,))


def feed_sources(registry: dict[str, str]) -> list[FeedSource]:
    """Turn a ``{source name: path}`` registry into sources."""
    return [FeedSource(name, (path,)) for name, path in registry.items()]


DAMAGED = "__damaged_record"


def by_header_name(raw: DataFrame, source_name: str) -> DataFrame:
    """Pick the feed fields by exact name. A blank in a column that is there is the text ''; a column that
    is not there gives null. Other columns are left out.

    A record with too few or too many fields (cut off, a quote left open, a line break inside quotes without
    ``multiline``) keeps its raw text in ``posted_at``, marked so that it can't be read as a time: the record goes
    to quarantine as a parsing error, whatever its other fields look like.
    """
    present = set(raw.columns)
    if DAMAGED in present:
        whole = F.col("`posted_at`") if "posted_at" in present else F.lit(None)
        broken = F.concat(F.lit("damaged record: "), F.col(DAMAGED))
        raw = raw.withColumn("posted_at", F.when(F.col(DAMAGED).isNotNull(), broken).otherwise(whole))
    fields = [
        F.coalesce(F.col(f"`{name}`").cast("string"), F.lit("")).alias(name)
        if name in present
        else F.col(name)
        if name in raw.columns
        else F.lit(None).cast("string").alias(name)
        for name in FEED_FIELDS
    ]
    return raw.select(F.lit(source_name).alias("source_name"), *fields)


def scan_feed(spark: SparkSession, source: FeedSource) -> DataFrame:
    """Scan one source. A missing path fails here, before anything is written.

    The schema is the header that Spark reads first, plus a column for the text of damaged records. With
    ``enforceSchema`` off, a file whose header differs from the first one under the same path fails the job instead
    of shifting columns.
    """
    options = {"header": True, "escape": '"', "enforceSchema": False, "multiLine": source.multiline, "encoding": "UTF-8"}

    def scan(path: str) -> DataFrame:
        header = spark.read.options(**options).csv(path).schema
        if not header:
            return spark.read.options(**options).csv(path)
        if source.multiline and source.strict_quotes:
            return scan_quoted(spark, path, header, DAMAGED)
        schema = T.StructType(header.fields + [T.StructField(DAMAGED, T.StringType())])
        return spark.read.options(columnNameOfCorruptRecord=DAMAGED, **options).schema(schema).csv(path)

    return reduce(DataFrame.unionByName, [by_header_name(scan(path), source.name) for path in source.paths])


def union_feeds(spark: SparkSession, sources: Iterable[FeedSource]) -> DataFrame:
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=True),
        [scan_feed(spark, source) for source in sources],
    )
