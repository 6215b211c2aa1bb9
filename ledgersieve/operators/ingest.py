"""From feed text to routed rows: hash, parse, classify, drop copies, skip replays."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgersieve.functions import clock, parsing, text
from ledgersieve.schemas import BRONZE, QUARANTINE

# The hash comes first: its leading bytes differ from row to row, so sorts compare eight bytes in most cases.
HASH_KEY = ["raw_line_hash", "source_name"]


def add_line_hash(feed: DataFrame) -> DataFrame:
    return feed.withColumn("raw_line_hash", text.line_hash())


def drop_exact_copies(hashed: DataFrame) -> DataFrame:
    """Keep one row per line hash.

    ``row_number() = 1`` and not ``dropDuplicates``: Spark limits each group before the shuffle, so a row
    repeated any number of times leaves one copy per task, and the result is sorted by the key, so the
    replay join needs no further shuffle or sort. It is also repeatable when two different rows share a
    line hash, which ``first`` is not: the row with the lowest hash of its other columns is kept.
    """
    others = [name for name in hashed.columns if name not in HASH_KEY]
    rank = F.row_number().over(Window.partitionBy(*HASH_KEY).orderBy(F.xxhash64(*others)))
    return hashed.withColumn("copy_number", rank).where("copy_number = 1").drop("copy_number")


def skip_replayed(hashed: DataFrame, seen: DataFrame) -> DataFrame:
    """Leave out rows whose hash an earlier load accepted. Quarantined rows are not remembered."""
    return hashed.join(seen.select(*HASH_KEY), HASH_KEY, "left_anti")


def parse_fields(feed: DataFrame) -> DataFrame:
    """Keep the text fields and add the typed ones with, for each, whether its text failed to parse."""
    dated = feed.select(
        "*",
        parsing.calendar_text("posted_at").alias("posted_iso"),
        parsing.calendar_text("updated_at").alias("updated_iso"),
    )
    return dated.select(
        "*",
        parsing.parse_timestamp("posted_iso").alias("posted_ts"),
        parsing.parse_amount("amount").alias("amount_value"),
        parsing.parse_timestamp("updated_iso").alias("updated_ts"),
    ).select(
        "*",
        parsing.parse_failed("posted_at", "posted_ts").alias("posted_failed"),
        parsing.parse_failed("amount", "amount_value").alias("amount_failed"),
        parsing.parse_failed("updated_at", "updated_ts").alias("updated_failed"),
    )


def classify(parsed: DataFrame, as_of: datetime) -> DataFrame:
    """Add ``quarantine_reason``: the first reason that holds, or null for an accepted row.

    A posting time with a zone offset cannot be compared with the zone-less clock, so it counts as a parsing
    error once the earlier reasons are ruled out.
    """
    # The five reasons.
    reason = (
        F.when(F.expr("posted_failed or amount_failed or updated_failed"), "parsing_error")
        .when(F.expr("coalesce(account_id, '') = ''"), "missing_account_id")
        .when(F.expr("amount_value is null"), "missing_amount")
        .when(F.expr("posted_ts is null"), "missing_posted_at")
        .when(parsing.has_offset("posted_iso"), "parsing_error")
        .when(F.col("posted_ts") > clock.acceptance_limit(as_of), "future_posted_at")
    )
    return parsed.withColumn("quarantine_reason", reason)


def typed_or_text(classified: DataFrame, more: list[str] = ()) -> DataFrame:
    """One row shape for both routes: typed values for accepted rows, the raw text for rejected ones."""
    accepted = "quarantine_reason is null"
    return classified.selectExpr(
        *more,
        "source_name",
        "transaction_id as raw_transaction_id",
        "account_id",
        f"if({accepted}, posted_ts, null) as posted_at",
        f"if({accepted}, amount_value, null) as amount",
        "currency",
        "description",
        f"if({accepted}, updated_ts, null) as updated_at",
        "status",
        "raw_line_hash",
        f"if({accepted}, null, posted_at) as posted_at_text",
        f"if({accepted}, null, amount) as amount_text",
        f"if({accepted}, null, updated_at) as updated_at_text",
        "quarantine_reason",
    )


def label(rows: DataFrame, run_id: str, as_of: datetime, grain: str = "day") -> DataFrame:
    """Add what follows from the run and the other columns, so that it need not go through a shuffle."""
    return rows.select(
        "*",
        clock.at(as_of).alias("recorded_at"),
        F.lit(run_id).alias("load_run_id"),
        F.expr("if(quarantine_reason is null, 'bronze', 'quarantine')").alias("route"),
        clock.period_of(F.col("posted_at"), grain).alias("posted_period"),
    )


def route_feed(feed: DataFrame, run_id: str, as_of: datetime, grain: str = "day") -> DataFrame:
    """The distinct rows of a feed, routed.

    Parsing comes before the shuffle that finds copies: typed values are smaller than their text, and a filter
    on the route cannot move below that shuffle, which would evaluate the parsing a second time.
    """
    classified = classify(parse_fields(add_line_hash(feed)), as_of)
    return label(drop_exact_copies(typed_or_text(classified)), run_id, as_of, grain)


def parsed_feed(feed: DataFrame, as_of: datetime, grain: str = "day") -> DataFrame:
    """Every row of the feed parsed and classified, copies too, with what the replay guard asks: ``due_period``, where an
    accepted copy of the row would lie, whatever its route is now, and ``ambiguous``, whether a field holds the hash's
    separator. The hash is in bytes: no shuffle can compress its text."""
    known = add_line_hash(feed).withColumn("ambiguous", text.has_separator())
    classified = classify(parse_fields(known), as_of).withColumn("due_period", clock.period_of(F.col("posted_ts"), grain))
    return typed_or_text(classified, ["due_period", "ambiguous"]).withColumn("raw_line_hash", F.unhex("raw_line_hash"))


def with_hash_text(rows: DataFrame) -> DataFrame:
    return rows.withColumn("raw_line_hash", text.hash_text("raw_line_hash"))


def stage_feed(feed: DataFrame, run_id: str, as_of: datetime, grain: str = "day") -> DataFrame:
    """``route_feed`` with ``due_period`` and ``ambiguous`` (see ``parsed_feed``)."""
    return label(with_hash_text(drop_exact_copies(parsed_feed(feed, as_of, grain))), run_id, as_of, grain)


def _columns(schema: T.StructType) -> list[str]:
    return schema.fieldNames()


def accepted_rows(routed: DataFrame) -> DataFrame:
    return (
        routed.where("route = 'bronze'").withColumnRenamed("recorded_at", "ingested_at").select(_columns(BRONZE))
    )


def rejected_rows(routed: DataFrame) -> DataFrame:
    return (
        routed.where("route = 'quarantine'")
        .withColumnRenamed("recorded_at", "quarantined_at")
        .select(_columns(QUARANTINE))
    )


def run_counters(routed: DataFrame) -> DataFrame:
    """Rows per source and route."""
    return routed.groupBy("source_name").agg(
        F.count_if(F.col("route") == "bronze").alias("ingested"),
        F.count_if(F.col("route") == "quarantine").alias("quarantined"),
    )
