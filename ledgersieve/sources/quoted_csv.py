"""CSV with line breaks inside quotes, read by many tasks.

Whether a line break ends a record depends on all quotes before it: it does after an even number of them. So the file is
read in byte ranges like any text, each range counts its quotes, a running sum over the ranges (one row each) says
whether a range begins inside quotes, and then every range finds its own record starts. Lines of a record that spans
lines are put together afterwards; all other records never leave their range.

This holds for files in which a quote either encloses a field or is doubled inside one, as CSV writers make them. A lone
quote inside an unquoted field, which some parsers take as text, would be counted.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

RANGE = ["file", "begin"]


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """Each line with its file, the first byte of the range it was read in, its place, and whether its quotes are odd."""
    odd = F.pmod(F.octet_length("line") - F.octet_length(F.replace("line", F.lit('"'), F.lit(""))), F.lit(2))
    return (
        spark.read.option("lineSep", "\n")
        .text(path)
        .select(
            F.col("value").alias("line"),
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("begin"),
        )
        .withColumn("place", F.monotonically_increasing_id())
        .withColumn("odd", odd.cast("int"))
    )


def records(spark: SparkSession, path: str) -> DataFrame:
    """file, first (whether it is the file's first record) and record: the text of each record, blank lines left out."""
    lines = _lines(spark, path)
    before = Window.partitionBy(*RANGE).orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    # One row for each range: its parity, and the place of its last line that a record starts on, for both ways in.
    inside = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2
    counted = lines.withColumn("inner", inside)
    ranges = counted.groupBy(*RANGE).agg(
        (F.sum("odd") % 2).alias("parity"),
        F.max(F.when(F.col("inner") == 0, F.col("place"))).alias("last_even"),
        F.max(F.when(F.col("inner") == 1, F.col("place"))).alias("last_odd"),
    )
    earlier = Window.partitionBy("file").orderBy("begin").rowsBetween(Window.unboundedPreceding, -1)
    entered = ranges.withColumn("entry", F.coalesce(F.sum("parity").over(earlier), F.lit(0)) % 2).withColumn(
        "last_start", F.when(F.col("entry") == 0, F.col("last_even")).otherwise(F.col("last_odd"))
    )
    following = Window.partitionBy("file").orderBy("begin")
    known = entered.select(
        *RANGE,
        "entry",
        F.last("last_start", ignorenulls=True).over(earlier).alias("open_record"),
        F.lead("entry").over(following).alias("next_entry"),
        (F.row_number().over(following) == 1).alias("first_range"),
    )
    starts = (F.col("inner") + F.col("entry")) % 2 == 0
    upto = Window.partitionBy(*RANGE).orderBy("place")
    placed = (
        counted.join(known, RANGE)
        .withColumn("starts", starts)
        .withColumn("record", F.coalesce(F.last(F.when(starts, F.col("place")), ignorenulls=True).over(upto), F.col("open_record")))
        # The last line of a range is followed by a start if the next range is entered outside quotes.
        .withColumn("closed", F.coalesce(F.lead(starts).over(upto), F.col("next_entry") == 0, F.lit(True)))
        .withColumn("first", F.col("first_range") & (F.col("record") == F.min("place").over(Window.partitionBy(*RANGE))))
    )
    whole = placed.where("starts and closed").select("file", "first", F.col("line").alias("record"))
    pieces = placed.where("not (starts and closed)").groupBy("file", "record")
    joined = pieces.agg(F.max("first").alias("first"), F.array_sort(F.collect_list(F.struct("place", "line"))).alias("parts")).select(
        "file", "first", F.array_join(F.transform("parts", lambda p: p.line), "\n").alias("record")
    )
    every = whole.unionByName(joined)
    return every.withColumn("record", F.regexp_replace("record", r"\r\z", "")).where(F.trim("record") != "")



def scan_quoted(spark: SparkSession, path: str, header: T.StructType, damaged: str) -> DataFrame:
    """Rows of the files under one path, all columns text, plus a column for the text of damaged records.

    The first record of every file must be the header; another one fails the job instead of shifting columns.
    """
    fields = ", ".join(f"`{name.replace('`', '``')}` string" for name in [*header.fieldNames(), damaged])
    options = {"escape": '"', "multiLine": "true", "columnNameOfCorruptRecord": damaged, "mode": "PERMISSIVE"}
    titles = ", ".join(f"c{i} string" for i in range(len(header)))
    found = records(spark, path)
    named = F.from_csv("record", titles, {"escape": '"', "multiLine": "true"})
    same = F.struct(*[named[f"c{i}"].alias(f"c{i}") for i in range(len(header))]) == F.struct(
        *[F.lit(name).alias(f"c{i}") for i, name in enumerate(header.fieldNames())]
    )
    wrong = F.raise_error(F.concat(F.lit("header differs from that of other files: "), F.col("file")))
    kept = found.where(F.when(~F.col("first"), True).when(F.coalesce(same, F.lit(False)), False).otherwise(wrong.cast("boolean")))
    return kept.select(F.from_csv("record", fields, options).alias("row")).select("row.*")
