"""Silver, gold, notes, quality rules and reports on small hand-made tables."""

from __future__ import annotations

import csv
import json
from datetime import date, datetime, timedelta
from pathlib import Path

import duckdb
import pytest
from conftest import AS_OF, line, rows_of
from pyspark.sql import functions as F

from ledgersieve.functions import clock, text
from ledgersieve.operators import conform, ingest, publish, quality, report
from ledgersieve.schemas import BRONZE, PIPELINE_RUNS, QUARANTINE, SILVER
from ledgersieve.session import scratch_dir, size_settings
from ledgersieve.sinks.appends import append_metrics, append_run_audit
from ledgersieve.sinks.exports import export_notes_csv, promote_tables, write_report_csv


def bronze_of(spark, *rows):
    """Rows as dicts; what is left out takes the default."""
    default = {
        "load_run_id": "run-1",
        "source_name": "s",
        "raw_transaction_id": "T1",
        "account_id": "ACC-1",
        "posted_at": datetime(2026, 5, 20, 8),
        "amount": 10.0,
        "currency": "USD",
        "description": "x",
        "updated_at": datetime(2026, 5, 20, 9),
        "status": "posted",
        "raw_line_hash": "h",
        "ingested_at": AS_OF,
    }
    filled = [{**default, **row} for row in rows]
    return spark.createDataFrame([tuple(r[c] for c in BRONZE.fieldNames()) for r in filled], BRONZE)


def silver_of(spark, *rows):
    default = {
        "natural_key": "k",
        "source_name": "s",
        "raw_transaction_id": "T1",
        "account_id": "ACC-1",
        "posted_at": datetime(2026, 5, 20, 8),
        "amount": 10.0,
        "currency": "USD",
        "description": "x",
        "updated_at": datetime(2026, 5, 20, 9),
        "status": "posted",
        "load_run_id": "run-1",
        "refreshed_at": AS_OF,
    }
    filled = [{**default, **row} for row in rows]
    return spark.createDataFrame([tuple(r[c] for c in SILVER.fieldNames()) for r in filled], SILVER)


# Silver -----------------------------------------------------------------------------------------------


def test_standard_values(spark):
    rows = bronze_of(
        spark,
        {"currency": "usd", "description": "  a\t ", "updated_at": None, "status": None},
        {"raw_transaction_id": None, "currency": "", "status": "", "description": None},
        {"raw_transaction_id": "no time", "posted_at": None},
    )
    found = rows_of(
        conform.standardize(rows), "natural_key", "currency", "description", "updated_at", "status"
    )
    assert found == [
        ("s|T1|2026-05-20 08:00:00", "USD", "a\t", datetime(2026, 5, 20, 8), "posted"),
        ("s||2026-05-20 08:00:00", "", None, datetime(2026, 5, 20, 9), ""),
    ]


def test_key_text_of_fractions(spark):
    rows = bronze_of(spark, {"posted_at": datetime(2026, 5, 20, 8, 0, 0, 120000)})
    assert conform.standardize(rows).first().natural_key == "s|T1|2026-05-20 08:00:00.12"


def test_latest_update_then_latest_load_then_hash_wins(spark):
    late, early = datetime(2026, 5, 21), datetime(2026, 5, 20)
    rows = bronze_of(
        spark,
        {"raw_transaction_id": "update", "updated_at": early, "amount": 1.0, "load_run_id": "run-9"},
        {"raw_transaction_id": "update", "updated_at": late, "amount": 2.0},
        {"raw_transaction_id": "load", "updated_at": late, "amount": 3.0, "load_run_id": "run-1"},
        {"raw_transaction_id": "load", "updated_at": late, "amount": 4.0, "load_run_id": "run-2"},
        {"raw_transaction_id": "hash", "amount": 5.0, "raw_line_hash": "b"},
        {"raw_transaction_id": "hash", "amount": 6.0, "raw_line_hash": "a"},
    )
    found = rows_of(conform.silver(rows, AS_OF), "raw_transaction_id", "amount")
    assert found == [("hash", 6.0), ("load", 4.0), ("update", 2.0)]


def test_deleted_latest_version_hides_earlier_ones(spark):
    rows = bronze_of(
        spark,
        {"amount": 1.0},
        {"amount": 2.0, "updated_at": datetime(2026, 5, 22), "status": "DELETED"},
        {"raw_transaction_id": "T2", "status": "Deleted"},
        {"raw_transaction_id": "T2", "updated_at": datetime(2026, 5, 22), "status": "reposted"},
    )
    assert rows_of(conform.silver(rows, AS_OF), "raw_transaction_id", "status") == [("T2", "reposted")]


def test_bad_latest_version_hides_earlier_ones(spark):
    newer = {"updated_at": datetime(2026, 5, 22)}
    rows = bronze_of(
        spark,
        {"raw_transaction_id": "a"},
        {"raw_transaction_id": "a", "account_id": None, **newer},
        {"raw_transaction_id": "b"},
        {"raw_transaction_id": "b", "amount": None, **newer},
        {"raw_transaction_id": "c", "posted_at": datetime(2026, 5, 26)},
    )
    assert conform.silver(rows, AS_OF).count() == 0


def test_corrected_posting_time_is_another_transaction(spark):
    rows = bronze_of(spark, {}, {"posted_at": datetime(2026, 5, 20, 9)})
    assert conform.silver(rows, AS_OF).count() == 2


def test_rows_without_id_and_equal_times_collapse(spark):
    rows = bronze_of(spark, {"raw_transaction_id": None}, {"raw_transaction_id": ""})
    assert conform.silver(rows, AS_OF).count() == 1


# Gold, mart, notes ------------------------------------------------------------------------------------


def test_gold_and_mart_differ_in_refresh_time(spark):
    earlier = AS_OF - timedelta(days=1)
    rows = silver_of(
        spark,
        {"amount": 1.1, "refreshed_at": earlier},
        {"amount": 2.2, "refreshed_at": earlier},
        {"amount": 5.0, "currency": None},
        {"amount": None, "account_id": "ACC-2"},
    )
    day = date(2026, 5, 20)
    assert rows_of(publish.gold_daily_account_summary(rows, AS_OF)) == [
        (day, "ACC-1", None, 5.0, 1, AS_OF),
        (day, "ACC-1", "USD", 3.3, 2, AS_OF),
        (day, "ACC-2", "USD", None, 1, AS_OF),
    ]
    staged = publish.register_staging_view(rows, "stg_test")
    assert spark.table("stg_test").count() == 3
    assert rows_of(publish.mart_daily_summary(staged)) == [
        (day, "ACC-1", None, 5.0, 1, AS_OF),
        (day, "ACC-1", "USD", 3.3, 2, earlier),
    ]


def test_note_sentence_and_null_descriptions(spark):
    rows = silver_of(
        spark,
        {"amount": 12345678.9, "description": ""},
        {"amount": 1250.4, "currency": None, "description": "fee"},
        {"description": None},
    )
    assert rows_of(publish.financial_notes(rows), "semantic_text") == [
        ("Account ACC-1 posted 12345678.9 USD on 2026-05-20. Description: ",),
        ("Account ACC-1 posted 1250.4  on 2026-05-20. Description: fee",),
    ]


NUMBERS = [
    0.0, -0.0, 1.0, -45.99, 1250.4, 0.1, 0.001, 0.00012, 1.5e-4, 1e-4, 9.9e-5, 1e-5, 2.5e-7, 1e7, 12345678.9,
    -98765432.125, 123456789012345.6, 999999999999999.9, 1e15, 1e16, 1.5e16, 2e22, 1e100, 1.25e-300,
    float("nan"), float("inf"), float("-inf"), 1e6, 9999999.99, 10000000.01, 123456789.123,
]


def test_number_text_matches_duckdb(spark):
    rows = spark.createDataFrame([(v,) for v in NUMBERS], "v double")
    found = [r.t for r in rows.select(text.plain_number("v").alias("t")).collect()]
    con = duckdb.connect()
    wanted = [con.execute("select cast(? :: double as varchar)", [v]).fetchone()[0] for v in NUMBERS]
    assert dict(zip(map(repr, NUMBERS), found)) == dict(zip(map(repr, NUMBERS), wanted))


def test_csv_export_is_ordered_over_part_files(spark, tmp_path):
    posted = [datetime(2026, 5, 1) + timedelta(days=(i * 7) % 10) for i in range(200)]
    rows = silver_of(
        spark,
        *[
            {"natural_key": f"k{i:03}", "account_id": f"ACC-{i % 3}", "posted_at": when, "description": ' a, "b" '}
            for i, when in enumerate(posted)
        ],
    )
    path = tmp_path / "notes"
    export_notes_csv(publish.financial_notes(rows).repartition(5), str(path))
    lines = []
    for part in sorted(path.glob("part-*")):
        with part.open(newline="", encoding="utf-8") as handle:
            lines += list(csv.DictReader(handle))
    order = [(r["transaction_date"], r["account_id"]) for r in lines]
    assert len(order) == 200 and order == sorted(order)
    assert lines[0]["semantic_text"].endswith('Description:  a, "b" ')
    assert lines[0]["amount"] == "10.0"


def test_promotion_overwrites_and_counts(spark, tmp_path):
    silver = silver_of(spark, {}, {"natural_key": "k2"})
    gold = publish.gold_daily_account_summary(silver, AS_OF)
    tables = {"silver_transactions": silver, "gold_daily_account_summary": gold}
    for _ in range(2):
        written = promote_tables(tables, "parquet", lambda t: {"path": f"{tmp_path}/{t}"})
    assert written == {"GOLD_DAILY_ACCOUNT_SUMMARY": 1, "SILVER_TRANSACTIONS": 2}
    assert spark.read.parquet(f"{tmp_path}/SILVER_TRANSACTIONS").count() == 2
    only = promote_tables(tables, "parquet", lambda t: {"path": f"{tmp_path}/x"}, ["silver_transactions"])
    assert only == {"SILVER_TRANSACTIONS": 2}
    with pytest.raises(ValueError, match="other"):
        promote_tables(tables, "parquet", lambda t: {}, ["other"])


# Quality ----------------------------------------------------------------------------------------------


def test_each_check_can_fail(spark):
    limit = AS_OF + timedelta(days=1)
    rows = silver_of(
        spark,
        {"natural_key": "a", "account_id": None},
        {"natural_key": "a", "currency": None},
        {"natural_key": "b", "currency": ""},
        {"natural_key": "c", "posted_at": limit},
        {"natural_key": "d", "posted_at": limit + timedelta(microseconds=1)},
        {"natural_key": "d"},
        {"natural_key": "d"},
    )
    verdict = quality.run_quality_checks(rows, AS_OF)
    assert sorted(verdict.checks) == [
        ("duplicate_natural_key_check", False, 2),
        ("future_timestamp_check", False, 1),
        ("null_key_check", False, 2),
    ]
    assert not verdict.passed and len(verdict.failures) == 3


def test_checks_on_nothing_pass(spark):
    verdict = quality.run_quality_checks(silver_of(spark, {}).where("false"), AS_OF)
    assert verdict.passed and [n for _, _, n in verdict.checks] == [0, 0, 0]


def test_freshness_lag_rounds_down(spark):
    def lag(posted):
        return quality.freshness_lag(silver_of(spark, {"posted_at": posted}), AS_OF).first()[0]

    assert lag(datetime(2026, 5, 23, 11, 11)) == 2177
    assert lag(AS_OF + timedelta(seconds=1)) == -1
    assert lag(AS_OF - timedelta(seconds=59)) == 0
    assert quality.freshness_lag(silver_of(spark, {}).where("false"), AS_OF).first()[0] is None


def test_rules(spark):
    rows = silver_of(
        spark,
        {"natural_key": "a", "currency": "USD"},
        {"natural_key": "a", "currency": "EUR"},
        {"natural_key": None, "currency": None},
        {"natural_key": None, "amount": None},
    )
    columns = ["natural_key", "currency", "amount"]
    found = quality.rule_not_null("m", rows, columns).select("column_name", "failing_count", "passed")
    assert rows_of(found) == [("amount", 1, False), ("currency", 1, False), ("natural_key", 2, False)]
    assert rows_of(quality.rule_unique("m", rows, "natural_key"), "failing_count") == [(1,)]
    assert rows_of(quality.rule_accepted_values("m", rows, {"currency": ["USD"]}), "failing_count") == [(1,)]
    clean = silver_of(spark, {})
    rules = quality.published_model_rules(clean, publish.mart_daily_summary(clean))
    assert rules.count() == 9 and rules.where("not passed").count() == 0


# Reports ----------------------------------------------------------------------------------------------


def runs_of(spark, *rows):
    return spark.createDataFrame(rows, PIPELINE_RUNS)


def test_second_boundaries_are_counted(spark):
    pair = (datetime(2026, 3, 8, 1, 59, 59, 900000), datetime(2026, 3, 8, 2, 0, 0, 100000))
    rows = spark.createDataFrame([pair, pair[::-1]], "a timestamp_ntz, b timestamp_ntz")
    found = rows.select(clock.second_boundaries(F.col("a"), F.col("b")).alias("s")).collect()
    assert [r.s for r in found] == [1, -1]


def test_health_report(spark, tmp_path):
    now = datetime(2026, 5, 24, 12)
    runs = runs_of(
        spark,
        ("run-1", now - timedelta(days=9), now - timedelta(days=8), "failed", 0, 0, 9, None, "old"),
        ("run-2", now - timedelta(days=7), now - timedelta(days=7), "failed", 1, 1, 1, None, "boom"),
        ("run-3", now - timedelta(days=1), now - timedelta(days=1), "success", 2, 3, 2, 10, None),
        ("run-4", now, now + timedelta(seconds=3), "success", 8, 8, 3, 2177, None),
    )
    quarantine = spark.createDataFrame(
        [tuple([reason if c == "quarantine_reason" else None for c in QUARANTINE.fieldNames()]) for reason in
         ["b", "a", "c", "c"]],
        QUARANTINE,
    )
    made = report.health_report(runs, quarantine, now)
    row = made.first().asDict()
    assert row == {
        "run_id": "run-4",
        "latest_status": "success",
        "duration_seconds": 3,
        "records_ingested": 8,
        "records_silver": 8,
        "records_quarantine": 3,
        "freshness_lag_minutes": 2177,
        "runs_last_7d": 3,
        "successful_runs_last_7d": 2,
        "success_rate_last_7d": 66.67,
        "avg_quarantine_last_7d": 2.0,
        "avg_freshness_lag_last_7d": 1093.5,
        "avg_duration_seconds_last_7d": 1.0,
        "top_quarantine_reasons": "c:2, a:1, b:1",
        "error_message": None,
    }
    write_report_csv(made, str(tmp_path / "report"))
    parts = list((tmp_path / "report").glob("part-*"))
    assert len(parts) == 1 and len(parts[0].read_text().splitlines()) == 2
    later = report.health_report(runs, quarantine, now + timedelta(days=30)).first()
    assert (later.runs_last_7d, later.successful_runs_last_7d, later.success_rate_last_7d) == (0, 0, None)
    assert report.health_report(runs.where("false"), quarantine, now).count() == 0
    assert report.health_report(runs, quarantine.where("false"), now).first().top_quarantine_reasons is None


def test_audit_and_metrics_append(spark, tmp_path):
    path = str(tmp_path / "runs")
    for i in range(2):
        append_run_audit(spark, path, {"run_id": f"r{i}", "start_ts": AS_OF, "records_ingested": i})
    assert rows_of(spark.read.parquet(path), "run_id", "start_ts", "records_ingested", "error_message") == [
        ("r0", AS_OF, 0, None),
        ("r1", AS_OF, 1, None),
    ]
    with pytest.raises(ValueError, match="nonsense"):
        append_run_audit(spark, path, {"nonsense": 1})
    metrics = str(tmp_path / "metrics")
    payload = {"scenario": "s", "quality_passed": False, "quality_failures": ["x"], "lag": None}
    for _ in range(2):
        append_metrics(spark, metrics, payload, AS_OF)
    lines = [json.loads(t) for p in Path(metrics).glob("part-*") for t in p.read_text().splitlines()]
    assert lines == [{**payload, "event_ts": "2026-05-24T23:28:46+00:00"}] * 2


def test_counts_per_layer(spark):
    assert rows_of(report.layer_counts(a=silver_of(spark, {}), b=silver_of(spark, {}, {}))) == [("a", 1), ("b", 2)]


def test_feed_to_silver_with_blank_fields(spark, feed):
    """A blank status or currency stays blank, and a blank description makes a note."""
    rows = feed(line("T1", status="", currency="", description="", updated_at=""))
    bronze = ingest.accepted_rows(ingest.route_feed(rows, "run-1", AS_OF))
    silver = conform.silver(bronze, AS_OF)
    row = silver.first()
    assert (row.status, row.currency, row.description, row.updated_at) == ("", "", "", datetime(2026, 5, 20, 8))
    assert publish.financial_notes(silver).count() == 1
    assert quality.run_quality_checks(silver, AS_OF).passed


def test_task_sizes_follow_the_input():
    small, large = size_settings(10**9), size_settings(100 * 10**12)
    assert small["spark.sql.shuffle.partitions"] == "8"
    assert small["spark.sql.files.maxPartitionBytes"] == str(128 * 1024 * 1024)
    assert int(large["spark.sql.shuffle.partitions"]) <= 30_000
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    assert small[advisory] == large[advisory] == str(128 * 1024 * 1024)


def test_scratch_folders_are_new_and_shared(spark):
    first, second = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert first != second
    shared = spark.conf.get("spark.checkpoint.dir", None)
    assert shared is None or first.startswith(shared)
