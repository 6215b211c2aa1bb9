"""A transaction feed and a run-audit table derived from the ``orders`` and ``events`` tables.

The feed has every kind of dirt the flow must handle: blank and unparseable fields, exact copies, corrected
and deleted versions, and postings in the future.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = datetime(2024, 1, 29)
LATER = datetime(2024, 1, 29, 12)
REPORT_TIME = datetime(2024, 1, 31)


# ISO text of a zone-less timestamp, to whole seconds or with six decimals. The text of a whole second has no
# fraction, so the decimal point is set as well as the zeros.
_ISO_SECONDS = "replace(substr(string({0}), 1, 19), ' ', 'T')"
_ISO_MICROS = "replace(overlay(rpad(string({0}), 26, '0') placing '.' from 20), ' ', 'T')"


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    updated = _ISO_SECONDS.format("o_orderdate + make_dt_interval(0, 0, 0, k % 3600)")
    return (
        spark.read.parquet(f"{sf_dir}/orders.parquet")
        .withColumnRenamed("o_orderkey", "k")
        .selectExpr(
            "'source_a' as source_name",
            "'A' || k as transaction_id",
            "if(k % 97 = 0, '', 'ACC-' || o_custkey) as account_id",
            f"if(k % 211 = 0, '', {_ISO_SECONDS.format('o_orderdate')}) as posted_at",
            "case when k % 89 = 0 then 'abc' when k % 83 = 0 then '' else string(o_totalprice) end as amount",
            "case k % 3 when 0 then 'USD' when 1 then 'usd' else 'Usd' end as currency",
            "' ' || o_orderpriority || ' ' as description",
            f"if(k % 5 = 0, '', {updated}) as updated_at",
            "case when k % 50 = 0 then 'Deleted' when o_orderstatus = 'P' then 'pending' else 'posted' end"
            " as status",
        )
    )


def events_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One scan of ``events``; copies and corrections come from an array of row kinds, not from re-reading."""
    corrected = "kind = 'correction'"
    updated = _ISO_MICROS.format(f"ts + if({corrected}, interval '86400' second, interval '60' second)")
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .withColumnRenamed("event_id", "k")
        .selectExpr(
            "k",
            "ts",
            "user_id",
            "event_type",
            "value",
            "explode(array_compact(array('base', if(k % 7 = 0, 'copy', null),"
            " if(k % 10 = 0, 'correction', null)))) as kind",
        )
        .selectExpr(
            "'source_b' as source_name",
            "'B' || k as transaction_id",
            "if(k % 101 = 0, '', 'ACC-' || user_id) as account_id",
            f"{_ISO_MICROS.format('ts')} as posted_at",
            f"case when k % 103 = 0 then 'abc' when {corrected} then string(k % 500 + 0.25)"
            " else string(value) end as amount",
            "'USD' as currency",
            "event_type as description",
            f"{updated} as updated_at",
            f"if({corrected} and k % 40 = 0, 'DELETED', 'posted') as status",
        )
    )


def transaction_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_feed(spark, sf_dir).unionByName(events_feed(spark, sf_dir))


def first_delivery(feed: DataFrame) -> DataFrame:
    """The part of the feed that a truncated first delivery holds; the full feed is the redelivery."""
    return feed.where(F.substr("transaction_id", F.lit(2)).cast("long") % 2 == 0)


def late_delivery(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Two deliveries of which the second touches a few months only.

    The first lacks the odd transaction numbers of 1996. The second holds all of 1996 again, and deletes every
    transaction posted in June 1995, which empties that month.
    """
    odd = F.substr("transaction_id", F.lit(2)).cast("long") % 2 == 1
    year = F.substr("posted_at", F.lit(1), F.lit(4))
    first = feed.where(~((year == "1996") & odd))
    deleted = (
        feed.where(F.substr("posted_at", F.lit(1), F.lit(7)) == "1995-06")
        .withColumn("updated_at", F.lit("2024-01-20T00:00:00"))
        .withColumn("status", F.lit("deleted"))
    )
    return first, feed.where(year == "1996").unionByName(deleted)


def document_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A feed whose descriptions are whole document texts, with their commas, quotes and line breaks."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").selectExpr(
        "'D' || doc_id as transaction_id",
        "'ACC-' || doc_id % 100 as account_id",
        "'2024-01-05T08:00:00' as posted_at",
        "doc_id || '.5' as amount",
        "'USD' as currency",
        "coalesce(text, '') as description",
        "'2024-01-06T08:00:00' as updated_at",
        "if(doc_id % 4 = 0, 'Deleted', 'posted') as status",
    )


def conversation_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with the texts of conversations."""
    return spark.read.parquet(f"{sf_dir}/conversations.parquet").selectExpr(
        "'C' || conv_id || '-' || turn as transaction_id",
        "'ACC-' || conv_id % 100 as account_id",
        "'2024-01-05T08:00:00' as posted_at",
        "turn || '.5' as amount",
        "'USD' as currency",
        "coalesce(text, '') as description",
        "'2024-01-06T08:00:00' as updated_at",
        "if(turn % 4 = 0, 'Deleted', 'posted') as status",
    )


def daily_run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run-audit table with one run per day of ``events``."""
    errors = F.count_if(F.col("event_type") == "error")
    return (
        spark.read.parquet(f"{sf_dir}/events.parquet")
        .groupBy(F.col("ts").cast("date").alias("day"))
        .agg(
            F.min("ts").alias("start_ts"),
            F.max("ts").alias("end_ts"),
            F.count("*").alias("records_ingested"),
            F.countDistinct("user_id").alias("records_silver"),
            errors.alias("records_quarantine"),
            (F.max("event_id") % 1000).alias("freshness_lag_minutes"),
        )
        .selectExpr(
            "'run-' || replace(string(day), '-', '') as run_id",
            "start_ts",
            "end_ts",
            "if(records_quarantine > 70, 'failed', 'success') as status",
            "records_ingested",
            "records_silver",
            "records_quarantine",
            "freshness_lag_minutes",
            "if(records_quarantine > 70, 'too many errors', null) as error_message",
        )
    )
