"""File exports and the promotion of tables to an external warehouse."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from ledgersieve.functions import text

# Which layer tables are promoted, and their names in the external warehouse.
PROMOTED_TABLES = {
    "gold_daily_account_summary": "GOLD_DAILY_ACCOUNT_SUMMARY",
    "silver_transactions": "SILVER_TRANSACTIONS",
}


def export_notes_csv(notes: DataFrame, path: str) -> None:
    """Write the notes as CSV with a header, ordered by date and account across the part files.

    The natural key ends the sort key: it is unique, so the range partitioning can split one account's day
    however many rows that holds.
    """
    (
        notes.withColumn("amount", text.plain_number("amount"))
        .orderBy("transaction_date", "account_id", "natural_key")
        .write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_period_csv(notes: DataFrame, path: str, period: str, order: list[str]) -> None:
    """Write notes as CSV in a folder for each period, each file in order and the files of a period by ranges.

    Rows are dealt by ranges of period and sort key, so one busy period is spread over several files; the number of a
    file in its name follows the ranges.
    """
    (
        notes.withColumn("amount", text.plain_number("amount"))
        .repartitionByRange(period, *order)
        .sortWithinPartitions(period, *order)
        .write.partitionBy(period)
        .option("header", True)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_feed_csv(feed: DataFrame, path: str) -> None:
    """Write feed text so that the feed scan gives the same text back."""
    (
        feed.write.mode("overwrite")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report_csv(report: DataFrame, path: str) -> None:
    """The report has one row by construction, so one part file."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def promote_tables(
    tables: dict[str, DataFrame],
    writer_format: str,
    options_for: Callable[[str], dict[str, str]],
    names: list[str] | None = None,
) -> dict[str, int]:
    """Overwrite each target table through any Spark data source; give the rows written per target.

    ``options_for`` gives the writer options of a target name, such as its ``dbtable`` or ``path``. Rows are
    counted by the write job itself, in its last stage, where Spark counts each partition once.
    """
    names = list(PROMOTED_TABLES) if names is None else names
    unknown = [name for name in names if name not in PROMOTED_TABLES or name not in tables]
    if unknown:
        raise ValueError(f"cannot promote unknown tables: {unknown}")
    written = {}
    for name in names:
        target = PROMOTED_TABLES[name]
        counted = Observation()
        (
            tables[name]
            .observe(counted, F.count(F.lit(1)).alias("rows"))
            .write.format(writer_format)
            .options(**options_for(target))
            .mode("overwrite")
            .save()
        )
        written[target] = counted.get["rows"]
    return written
