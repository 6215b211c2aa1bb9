"""Bronze to silver: standardise, keep the latest version of each transaction, drop tombstones."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ledgersieve.functions import clock, text
from ledgersieve.schemas import SILVER


def standardize(bronze: DataFrame) -> DataFrame:
    """Conformed values and the natural key, for rows that have a posting time."""
    return bronze.where("posted_at is not null").select(
        text.natural_key().alias("natural_key"),
        "source_name",
        "raw_transaction_id",
        "account_id",
        "posted_at",
        "amount",
        F.expr("upper(currency) as currency"),
        F.expr("trim(description) as description"),
        F.expr("coalesce(updated_at, posted_at) as updated_at"),
        F.expr("lower(coalesce(status, 'posted')) as status"),
        "load_run_id",
        "raw_line_hash",
    )


def latest_versions(standardized: DataFrame) -> DataFrame:
    """One row per natural key: latest update, then latest load, then line hash to settle ties.

    ``posted_at`` is the last part of the natural key, so grouping by both is grouping by the key; having the
    timestamp first lets the sort compare numbers. ``rn = 1`` sits directly above the window, so Spark limits
    each group before the shuffle and a key with many versions costs one row per task.
    """
    order = Window.partitionBy("posted_at", "natural_key").orderBy(
        F.desc("updated_at"), F.desc("load_run_id"), "raw_line_hash"
    )
    return standardized.withColumn("rn", F.row_number().over(order)).where("rn = 1").drop("rn")


def silver(bronze: DataFrame, as_of: datetime) -> DataFrame:
    """Filters come after the ranking: a deleted latest version hides the versions before it."""
    # Through the shuffle go the hash as bytes and the key without its time; a text that is no hash stays beside it.
    short = standardize(bronze).withColumn("natural_key", text.key_start()).withColumn("__bytes", text.hash_bytes())
    short = short.withColumn("raw_line_hash", F.struct(F.expr("if(__bytes is null, raw_line_hash, null)"), "__bytes"))
    return (
        latest_versions(short.drop("__bytes"))
        .withColumn("natural_key", text.natural_key())
        .where("account_id is not null and amount is not null and status <> 'deleted'")
        .where(F.col("posted_at") <= clock.acceptance_limit(as_of))
        .withColumn("refreshed_at", clock.at(as_of))
        .select(SILVER.fieldNames())
    )
