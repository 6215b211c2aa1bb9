"""One run: load the feeds, refresh silver, check it, publish, and record the run."""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.operators import quality
from ledgersieve.plans import refresh
from ledgersieve.plans.warehouse import Warehouse
from ledgersieve.sinks.appends import append_metrics, append_run_audit
from ledgersieve.sources.csv_feeds import FeedSource, feed_sources, union_feeds

PUBLISHED = ["gold_daily_account_summary", "ai_ready_financial_notes"]


class RunFailed(RuntimeError):
    """The run was recorded as failed."""


@dataclass
class RunRecord:
    run_id: str
    status: str = "success"
    records_ingested: int = 0
    records_silver: int = 0
    records_quarantine: int = 0
    freshness_lag_minutes: int | None = None
    error_message: str | None = None


def utc_now() -> datetime:
    return datetime.now(timezone.utc).replace(tzinfo=None)


def new_run_id(as_of: datetime) -> str:
    """Run ids settle ties between loads as text, so they start with the time."""
    return f"run-{as_of:%Y%m%d%H%M%S}-{uuid.uuid4().hex[:8]}"


def run_daily(
    spark: SparkSession,
    sources: dict[str, str] | list[FeedSource] | DataFrame,
    base_dir: str,
    run_id: str | None = None,
    as_of: datetime | None = None,
    grain: str = "day",
    full_refresh: bool = False,
    export_notes: bool = True,
) -> RunRecord:
    """Run everything once. ``as_of`` is the one clock of the run (UTC, without zone).

    Raises ``RunFailed`` after recording the failure. Gold and notes are only replaced if the quality checks
    pass; silver and bronze have been replaced by then, and the next good run publishes what is pending.
    """
    as_of = as_of or utc_now()
    started = time.monotonic()
    record = RunRecord(run_id or new_run_id(as_of))
    warehouse = Warehouse(spark, base_dir, grain)
    failure = None
    try:
        feed = sources if isinstance(sources, DataFrame) else _scan(spark, sources)
        _load_and_publish(warehouse, feed, record, as_of, full_refresh, export_notes)
    except Exception as error:
        failure = error
        record.status = "failed"
        record.error_message = str(error)
        record.freshness_lag_minutes = None
    record.records_silver = warehouse.row_count("silver_transactions")
    _record_run(warehouse, record, as_of, timedelta(seconds=time.monotonic() - started))
    if failure is not None:
        raise RunFailed(f"run {record.run_id} failed: {record.error_message}") from failure
    return record


def _scan(spark: SparkSession, sources: dict[str, str] | list[FeedSource]) -> DataFrame:
    return union_feeds(spark, feed_sources(sources) if isinstance(sources, dict) else sources)


def _load_and_publish(
    warehouse: Warehouse,
    feed: DataFrame,
    record: RunRecord,
    as_of: datetime,
    full_refresh: bool,
    export_notes: bool,
) -> None:
    counts = refresh.load_feed(warehouse, feed, record.run_id, as_of)
    record.records_ingested = counts.ingested
    record.records_quarantine = counts.quarantined

    silver_scope = refresh.refresh_silver(warehouse, as_of, full_refresh)
    scopes = refresh.refresh_scopes(warehouse, PUBLISHED, as_of, full_refresh or silver_scope.full)

    # The verdict of all periods, from the counts that were stored with them; data is read only where a posting is
    # newer than the clock allows.
    states = warehouse.check_states()
    late = warehouse.silver(quality.late_periods(states, as_of))
    verdict = quality.verdict_of(quality.checks_from_states(states, late, as_of))
    if not verdict.passed:
        raise RunFailed("Quality checks failed: " + ", ".join(verdict.failures))

    refresh.publish_layers(warehouse, as_of, scopes)
    if export_notes:
        warehouse.export_notes()
    newest = warehouse.check_states().select(F.col("newest").alias("posted_at"))
    record.freshness_lag_minutes = quality.freshness_lag(newest, as_of).first().freshness_lag_minutes


def _record_run(warehouse: Warehouse, record: RunRecord, as_of: datetime, took: timedelta) -> None:
    end = as_of + took
    audit = {**vars(record), "start_ts": as_of, "end_ts": end}
    append_run_audit(warehouse.spark, warehouse.path("pipeline_runs"), audit)
    metrics = {name: value for name, value in vars(record).items() if name != "error_message"}
    append_metrics(warehouse.spark, warehouse.path("pipeline_metrics"), metrics, end)
