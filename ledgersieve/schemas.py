"""Column lists and types of the feed and of every layer table."""

from __future__ import annotations

from pyspark.sql import types as T

TEXT = T.StringType()
TS = T.TimestampNTZType()
DOUBLE = T.DoubleType()
LONG = T.LongType()
DATE = T.DateType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


# The text fields of a feed, found by header name. The order is the order in the row hash.
FEED_FIELDS = [
    "transaction_id",
    "account_id",
    "posted_at",
    "amount",
    "currency",
    "description",
    "updated_at",
    "status",
]

BRONZE = _struct(
    ("load_run_id", TEXT),
    ("source_name", TEXT),
    ("raw_transaction_id", TEXT),
    ("account_id", TEXT),
    ("posted_at", TS),
    ("amount", DOUBLE),
    ("currency", TEXT),
    ("description", TEXT),
    ("updated_at", TS),
    ("status", TEXT),
    ("raw_line_hash", TEXT),
    ("ingested_at", TS),
)

QUARANTINE = _struct(
    ("load_run_id", TEXT),
    ("source_name", TEXT),
    ("raw_transaction_id", TEXT),
    ("account_id", TEXT),
    ("posted_at_text", TEXT),
    ("amount_text", TEXT),
    ("currency", TEXT),
    ("description", TEXT),
    ("updated_at_text", TEXT),
    ("status", TEXT),
    ("quarantine_reason", TEXT),
    ("quarantined_at", TS),
)

# What ingest writes, in one job: both routes of the feed. Bronze and quarantine are views of it.
ROUTED = _struct(
    ("raw_transaction_id", TEXT),
    ("account_id", TEXT),
    ("posted_at", TS),
    ("amount", DOUBLE),
    ("currency", TEXT),
    ("description", TEXT),
    ("updated_at", TS),
    ("status", TEXT),
    ("raw_line_hash", TEXT),
    ("posted_at_text", TEXT),
    ("amount_text", TEXT),
    ("updated_at_text", TEXT),
    ("quarantine_reason", TEXT),
    ("recorded_at", TS),
    ("load_run_id", TEXT),
    ("route", TEXT),
    ("source_name", TEXT),
    ("posted_period", DATE),
)

SILVER = _struct(
    ("natural_key", TEXT),
    ("source_name", TEXT),
    ("raw_transaction_id", TEXT),
    ("account_id", TEXT),
    ("posted_at", TS),
    ("amount", DOUBLE),
    ("currency", TEXT),
    ("description", TEXT),
    ("updated_at", TS),
    ("status", TEXT),
    ("load_run_id", TEXT),
    ("refreshed_at", TS),
)

GOLD = _struct(
    ("run_date", DATE),
    ("account_id", TEXT),
    ("currency", TEXT),
    ("total_amount", DOUBLE),
    ("transaction_count", LONG),
    ("last_refresh_ts", TS),
)

NOTES = _struct(
    ("natural_key", TEXT),
    ("account_id", TEXT),
    ("transaction_date", DATE),
    ("amount", DOUBLE),
    ("currency", TEXT),
    ("semantic_text", TEXT),
)

PIPELINE_RUNS = _struct(
    ("run_id", TEXT),
    ("start_ts", TS),
    ("end_ts", TS),
    ("status", TEXT),
    ("records_ingested", LONG),
    ("records_silver", LONG),
    ("records_quarantine", LONG),
    ("freshness_lag_minutes", LONG),
    ("error_message", TEXT),
)

# Which load runs each derived layer already holds, and the clock of that refresh.
LAYER_REFRESHES = _struct(
    ("layer", TEXT),
    ("load_run_id", TEXT),
    ("as_of", TS),
    ("refresh_number", LONG),
)

METRICS = _struct(
    ("run_id", TEXT),
    ("status", TEXT),
    ("records_ingested", LONG),
    ("records_silver", LONG),
    ("records_quarantine", LONG),
    ("freshness_lag_minutes", LONG),
    ("event_ts", TEXT),
)
