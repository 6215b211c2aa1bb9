"""The run-health report: latest run, last seven days, and where quarantined rows come from."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgersieve.functions import clock


def _duration() -> Column:
    return clock.second_boundaries(F.col("start_ts"), F.col("end_ts"))


def latest_run(runs: DataFrame) -> DataFrame:
    """The run that ended last (run id settles ties), with its duration in seconds."""
    return (
        runs.orderBy(F.desc("end_ts"), F.desc("run_id"))
        .limit(1)
        .withColumn("duration_seconds", _duration())
    )


def run_stats_7d(runs: DataFrame, report_time: datetime) -> DataFrame:
    recent = runs.where(F.col("end_ts") >= clock.at(report_time) - F.expr("interval 7 days"))
    return recent.agg(
        F.count("*").alias("runs_last_7d"),
        F.count_if(F.col("status") == "success").alias("successful_runs_last_7d"),
        F.round(F.avg("records_quarantine"), 2).alias("avg_quarantine_last_7d"),
        F.round(F.avg("freshness_lag_minutes"), 2).alias("avg_freshness_lag_last_7d"),
        F.round(F.avg(_duration()), 2).alias("avg_duration_seconds_last_7d"),
    )


def quarantine_breakdown(quarantine: DataFrame, source_name: str | None = None) -> DataFrame:
    """Quarantined rows by reason, over all time, for all sources or for one."""
    rows = quarantine if source_name is None else quarantine.where(F.col("source_name") == source_name)
    return rows.groupBy("quarantine_reason").agg(F.count("*").alias("issue_count"))


def quarantine_top(quarantine: DataFrame) -> DataFrame:
    """``reason:count`` of every reason in one text, most frequent first, names settle ties."""
    return quarantine_breakdown(quarantine).agg(
        F.expr(
            "listagg(concat(quarantine_reason, ':', issue_count), ', ') "
            "within group (order by issue_count desc, quarantine_reason)"
        ).alias("top_quarantine_reasons")
    )


def health_report(runs: DataFrame, quarantine: DataFrame, report_time: datetime) -> DataFrame:
    """One row (none before the first run). The two one-row parts come in as scalar subqueries, so no join
    is planned and each part is reduced on its own."""
    stats = run_stats_7d(runs, report_time)
    stats_row = stats.select(F.struct(*stats.columns)).scalar()
    top_reasons = quarantine_top(quarantine).scalar()
    joined = latest_run(runs).select("*", stats_row.alias("stats"), top_reasons.alias("top_quarantine_reasons"))
    total = F.col("stats.runs_last_7d")
    success_rate = F.when(
        total != 0, F.round(F.col("stats.successful_runs_last_7d").cast("double") / total * 100, 2)
    )
    return joined.select(
        "run_id",
        F.col("status").alias("latest_status"),
        "duration_seconds",
        "records_ingested",
        "records_silver",
        "records_quarantine",
        "freshness_lag_minutes",
        "stats.runs_last_7d",
        "stats.successful_runs_last_7d",
        success_rate.alias("success_rate_last_7d"),
        "stats.avg_quarantine_last_7d",
        "stats.avg_freshness_lag_last_7d",
        "stats.avg_duration_seconds_last_7d",
        "top_quarantine_reasons",
        "error_message",
    )


def layer_counts(**layers: DataFrame) -> DataFrame:
    """Row count of each named table."""
    counts = [
        rows.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("layer"), "row_count")
        for name, rows in layers.items()
    ]
    result = counts[0]
    for more in counts[1:]:
        result = result.unionByName(more)
    return result


def backfill_by_date(silver: DataFrame, load_run_id: str) -> DataFrame:
    """Rows that one load brought in, by posting date."""
    return (
        silver.where(F.col("load_run_id") == load_run_id)
        .groupBy(F.col("posted_at").cast("date").alias("posted_date"))
        .agg(F.count("*").alias("row_count"))
    )
