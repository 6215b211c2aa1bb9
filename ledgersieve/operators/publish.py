"""Silver to published tables: the daily summary, the sentence-per-transaction notes, the staging model."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersieve.functions import clock, text


def _daily_summary(rows: DataFrame, *more: Column) -> DataFrame:
    return rows.groupBy(F.col("posted_at").cast("date").alias("run_date"), "account_id", "currency").agg(
        F.round(F.sum("amount"), 2).alias("total_amount"),
        F.count("*").alias("transaction_count"),
        *more,
    )


def gold_daily_account_summary(silver: DataFrame, as_of: datetime) -> DataFrame:
    """Totals per day, account and currency, stamped with the time of this refresh."""
    return _daily_summary(silver).withColumn("last_refresh_ts", clock.at(as_of))


def mart_daily_summary(staged: DataFrame) -> DataFrame:
    """The same totals, stamped with the newest refresh among the rows of each group."""
    return _daily_summary(staged, F.max("refreshed_at").alias("last_refresh_ts"))


def staging_model(silver: DataFrame) -> DataFrame:
    """Silver with explicit types, rows without an amount left out."""
    return silver.where(F.col("amount").isNotNull()).select(
        "natural_key",
        "source_name",
        "raw_transaction_id",
        "account_id",
        F.col("posted_at").cast("timestamp_ntz").alias("posted_at"),
        F.col("amount").cast("double").alias("amount"),
        F.upper("currency").alias("currency"),
        "description",
        F.col("updated_at").cast("timestamp_ntz").alias("updated_at"),
        "status",
        "load_run_id",
        F.col("refreshed_at").cast("timestamp_ntz").alias("refreshed_at"),
    )


def register_staging_view(silver: DataFrame, name: str = "stg_silver_transactions") -> DataFrame:
    staged = staging_model(silver)
    staged.createOrReplaceTempView(name)
    return staged


def financial_notes(silver: DataFrame) -> DataFrame:
    """One sentence per transaction that has a description (an empty one counts)."""
    sentence = F.concat_ws(
        "",
        F.expr("concat_ws('', 'Account ', account_id, ' posted ')"),
        text.plain_number("amount"),
        F.expr("concat_ws('', ' ', currency, ' on ', date(posted_at), '. Description: ', description)"),
    )
    return silver.where("description is not null").select(
        "natural_key",
        "account_id",
        F.expr("date(posted_at) as transaction_date"),
        "amount",
        "currency",
        sentence.alias("semantic_text"),
    )
