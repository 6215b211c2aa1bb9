"""Whole runs over a stored warehouse: golden results, replays, failures, partial refreshes."""

from __future__ import annotations

import io
import json
import random
from contextlib import redirect_stdout
from datetime import date, datetime, timedelta
from functools import partial
from pathlib import Path

import pytest
from conftest import AS_OF, FEED_A, line, rows_of, write_csv

from ledgersieve.functions import clock
from ledgersieve.operators import report
from ledgersieve.plans import refresh
from ledgersieve.plans.daily_run import RunFailed, new_run_id
from ledgersieve.plans.daily_run import run_daily as run_with_export
from ledgersieve.plans.warehouse import Warehouse
from ledgersieve.schemas import FEED_FIELDS

run_daily = partial(run_with_export, export_notes=False)

GOLDEN_GOLD = [
    (date(2026, 5, 19), "ACC-006", "USD", 100.0, 1),
    (date(2026, 5, 20), "ACC-001", "USD", 1204.41, 2),
    (date(2026, 5, 20), "ACC-002", "USD", 505.15, 1),
    (date(2026, 5, 21), "ACC-002", "USD", 8999.99, 1),
    (date(2026, 5, 21), "ACC-005", "USD", 1275.0, 1),
    (date(2026, 5, 22), "ACC-003", "USD", 320.0, 1),
    (date(2026, 5, 23), "ACC-004", "USD", 2100.0, 1),
]
GOLD_COLUMNS = ["run_date", "account_id", "currency", "total_amount", "transaction_count"]


def gold_of(warehouse):
    return rows_of(warehouse.gold(), *GOLD_COLUMNS)


def content(warehouse, *ignored):
    """All layers as comparable rows, without the columns that name the run or its time."""
    skip = {"refreshed_at", "last_refresh_ts", "ingested_at", *ignored}
    layers = [warehouse.bronze(), warehouse.silver(), warehouse.gold(), warehouse.notes()]
    return [rows_of(rows, *[c for c in rows.columns if c not in skip]) for rows in layers]


def test_golden_run_then_replay_then_later_clock(spark, tmp_path, sources):
    base = str(tmp_path / "wh")
    first = run_with_export(spark, sources, base, run_id="run-1", as_of=AS_OF)
    warehouse = Warehouse(spark, base)
    assert vars(first) == {
        "run_id": "run-1",
        "status": "success",
        "records_ingested": 8,
        "records_silver": 8,
        "records_quarantine": 3,
        "freshness_lag_minutes": 2177,
        "error_message": None,
    }
    assert gold_of(warehouse) == GOLDEN_GOLD
    assert warehouse.notes().count() == 8
    exported = spark.read.option("header", True).csv(f"{base}/exports/ai_ready_financial_notes")
    assert exported.count() == 8 and exported.columns == warehouse.notes().columns
    reasons = rows_of(report.quarantine_breakdown(warehouse.quarantine()))
    assert reasons == [("future_posted_at", 1), ("missing_account_id", 1), ("parsing_error", 1)]
    before = content(warehouse)

    again = run_daily(spark, sources, base, run_id="run-2", as_of=AS_OF + timedelta(hours=1))
    assert (again.records_ingested, again.records_quarantine, again.records_silver) == (0, 3, 8)
    assert content(warehouse) == before
    assert warehouse.quarantine().count() == 6

    later = run_daily(spark, sources, base, run_id="run-3", as_of=datetime(2026, 5, 31, 10))
    assert (later.records_ingested, later.records_quarantine, later.records_silver) == (1, 2, 9)
    assert gold_of(warehouse) == [*GOLDEN_GOLD, (date(2026, 6, 1), "ACC-008", "USD", 750.0, 1)]

    runs = rows_of(warehouse.runs(), "run_id", "status", "records_ingested", "records_quarantine")
    assert runs == [("run-1", "success", 8, 3), ("run-2", "success", 0, 3), ("run-3", "success", 1, 2)]
    lines = [json.loads(t) for p in Path(base, "pipeline_metrics").glob("part-*") for t in p.open()]
    assert sorted(m["run_id"] for m in lines) == ["run-1", "run-2", "run-3"]
    assert set(lines[0]) == {
        "run_id",
        "status",
        "records_ingested",
        "records_silver",
        "records_quarantine",
        "freshness_lag_minutes",
        "event_ts",
    }
    health = report.health_report(warehouse.runs(), warehouse.quarantine(), datetime(2026, 5, 31, 11)).first()
    assert (health.run_id, health.runs_last_7d, health.success_rate_last_7d) == ("run-3", 3, 100.0)
    assert health.top_quarantine_reasons == "missing_account_id:3, parsing_error:3, future_posted_at:2"

    warehouse.register_views()
    assert spark.sql("select count(*) from silver_transactions join bronze_transactions using (load_run_id)")
    assert spark.sql("select count(*) n from gold_daily_account_summary").first().n == 8


def test_truncated_delivery_then_full(spark, tmp_path):
    rows = [
        line(f"T{i}", f"ACC-{10 + i}", f"2026-05-24T08:{5 * i:02}:00", "500.00", description=f"row {i}")
        for i in range(5)
    ]
    base = str(tmp_path / "wh")
    path = write_csv(tmp_path / "s.csv", rows[:2])
    assert run_daily(spark, {"scenario_source": path}, base, "run-1", AS_OF).records_ingested == 2
    write_csv(tmp_path / "s.csv", rows)
    second = run_daily(spark, {"scenario_source": path}, base, "run-2", AS_OF)
    assert (second.records_ingested, second.records_quarantine, second.records_silver) == (3, 0, 5)
    keys = rows_of(Warehouse(spark, base).silver(), "natural_key")
    assert len(keys) == len(set(keys)) == 5


def test_late_rows_refresh_past_dates_only(spark, tmp_path, feed):
    base = str(tmp_path / "wh")
    run_daily(spark, feed(*FEED_A), base, "run-1", AS_OF)
    late = [
        line("L1", "ACC-411", "2026-05-22T06:17:00", "18.40"),
        line("L2", "ACC-412", "2026-05-22T21:05:00", "913.65"),
        line("L3", "ACC-413", "2026-05-18T03:41:00", "7.25"),
    ]
    done = run_daily(spark, feed(*late, source="scenario_source"), base, "run-2", AS_OF + timedelta(hours=1))
    assert (done.records_ingested, done.records_silver) == (3, 8)
    warehouse = Warehouse(spark, base)
    assert rows_of(report.backfill_by_date(warehouse.silver(), "run-2")) == [
        (date(2026, 5, 18), 1),
        (date(2026, 5, 22), 2),
    ]
    refreshed = rows_of(warehouse.silver(), "raw_transaction_id", "refreshed_at")
    assert {t for t, when in refreshed if when > AS_OF} == {"A4", "L1", "L2", "L3"}
    assert (date(2026, 5, 22), "ACC-412", "USD", 913.65, 1) in gold_of(warehouse)


def test_failed_gate_keeps_published_tables_until_a_good_run(spark, tmp_path, feed):
    base = str(tmp_path / "wh")
    run_daily(spark, feed(line("T1")), base, "run-1", AS_OF)
    warehouse = Warehouse(spark, base)
    published = gold_of(warehouse)

    header = [name for name in FEED_FIELDS if name != "currency"]
    row = [value for name, value in zip(FEED_FIELDS, line("T2", posted_at="2026-05-21T08:00:00")) if name in header]
    drifted = {"source_a": write_csv(tmp_path / "f.csv", [row], header)}
    with pytest.raises(RunFailed, match="null_key_check"):
        run_daily(spark, drifted, base, "run-2", AS_OF + timedelta(hours=1))
    audit = warehouse.runs().where("run_id = 'run-2'").first()
    assert (audit.status, audit.records_ingested, audit.records_silver) == ("failed", 1, 2)
    assert audit.error_message == "Quality checks failed: null_key_check"
    assert audit.freshness_lag_minutes is None
    assert gold_of(warehouse) == published and warehouse.silver().count() == 2

    # A good load elsewhere does not hide the bad row; correcting the row publishes both.
    elsewhere = feed(line("T3", posted_at="2026-05-23T08:00:00"))
    with pytest.raises(RunFailed, match="null_key_check"):
        run_daily(spark, elsewhere, base, "run-3", AS_OF + timedelta(hours=2))
    assert gold_of(warehouse) == published
    fixed = feed(line("T2", posted_at="2026-05-21T08:00:00", updated_at="2026-05-23T08:00:00"))
    run_daily(spark, fixed, base, "run-4", AS_OF + timedelta(hours=3))
    assert [row[0] for row in gold_of(warehouse)] == [date(2026, 5, 20), date(2026, 5, 21), date(2026, 5, 23)]


def test_missing_source_is_recorded_and_writes_nothing(spark, tmp_path, sources):
    base = str(tmp_path / "wh")
    with pytest.raises(RunFailed):
        run_daily(spark, {**sources, "source_c": str(tmp_path / "none.csv")}, base, "run-1", AS_OF)
    warehouse = Warehouse(spark, base)
    audit = warehouse.runs().first()
    assert (audit.status, audit.records_ingested, audit.records_silver) == ("failed", 0, 0)
    assert "none.csv" in audit.error_message
    assert warehouse.bronze().count() == 0
    assert run_daily(spark, sources, base, "run-1", AS_OF).records_ingested == 8


def test_load_that_crashed_before_silver_is_picked_up(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    run_daily(spark, feed(line("T1")), warehouse.base_dir, "run-1", AS_OF)
    refresh.load_feed(warehouse, feed(line("T2", posted_at="2026-05-21T08:00:00")), "run-2", AS_OF)
    # The driver stops here. The same id may load again, and a later run takes both in.
    refresh.load_feed(warehouse, feed(line("T2", posted_at="2026-05-21T08:00:00")), "run-2", AS_OF)
    assert warehouse.bronze().count() == 2
    done = run_daily(spark, feed(line("T3", posted_at="2026-05-22T08:00:00")), warehouse.base_dir, "run-3", AS_OF)
    assert done.records_silver == 3 and len(gold_of(warehouse)) == 3
    with pytest.raises(RunFailed, match="already loaded"):
        run_daily(spark, feed(line("T4")), warehouse.base_dir, "run-2", AS_OF)


def deliveries(seed, parts):
    """Random versions, deletions, copies and bad rows in several deliveries."""
    rng = random.Random(seed)
    rows = []
    for i in range(160):
        day, update = rng.randint(1, 6), rng.randint(0, 10**6)
        rows.append(
            line(
                f"T{rng.randint(0, 40)}|" if rng.random() < 0.1 else f"T{rng.randint(0, 40)}",
                rng.choice(["ACC-1", "ACC-2", "ACC-3", ""]),
                f"2026-05-{day:02}T08:00:00",
                rng.choice(["1.25", "10.50", "7", "abc"]),
                rng.choice(["USD", "usd"]),
                rng.choice(["a", " b ", "", "x|y"]),
                (datetime(2026, 5, 10) + timedelta(seconds=update)).isoformat(),
                rng.choice(["posted", "posted", "Deleted", ""]),
            )
        )
    rows += rng.choices(rows, k=40)
    rng.shuffle(rows)
    cuts = sorted(rng.sample(range(1, len(rows)), parts - 1))
    return [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]


@pytest.mark.parametrize("grain", ["day", "month"])
def test_any_split_into_loads_gives_the_same_layers(spark, tmp_path, feed, grain):
    parts = deliveries(7, 3)
    whole = Warehouse(spark, str(tmp_path / "whole"), grain)
    run_daily(spark, feed(*sum(parts, [])), whole.base_dir, "run-1", AS_OF, grain)
    split = Warehouse(spark, str(tmp_path / "split"), grain)
    for i, part in enumerate(parts):
        run_daily(spark, feed(*part), split.base_dir, f"run-{i}", AS_OF + timedelta(minutes=i), grain)
    assert content(split, "load_run_id") == content(whole, "load_run_id")
    full = Warehouse(spark, split.base_dir, grain)
    before = content(full)
    refresh.refresh_silver(full, AS_OF + timedelta(hours=1), force_full=True)
    assert content(full) == before


def test_period_whose_rows_are_all_deleted_is_emptied(spark, tmp_path, feed):
    base = str(tmp_path / "wh")
    run_daily(spark, feed(line("T1"), line("T2", posted_at="2026-05-21T08:00:00")), base, "run-1", AS_OF)
    gone = line("T2", posted_at="2026-05-21T08:00:00", updated_at="2026-05-22T00:00:00", status="DELETED")
    done = run_daily(spark, feed(gone), base, "run-2", AS_OF)
    warehouse = Warehouse(spark, base)
    assert (done.records_ingested, done.records_silver) == (1, 1)
    assert [row[0] for row in gold_of(warehouse)] == [date(2026, 5, 20)]
    assert warehouse.notes().count() == 1


def test_clock_that_goes_back_refreshes_everything(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    ahead = line("T2", posted_at="2026-05-25T12:00:00")
    run_daily(spark, feed(line("T1"), ahead), warehouse.base_dir, "run-1", AS_OF)
    assert warehouse.silver().count() == 2
    run_daily(spark, feed(line("T3")), warehouse.base_dir, "run-2", AS_OF - timedelta(days=2))
    assert rows_of(warehouse.silver(), "raw_transaction_id") == [("T1",), ("T3",)]
    assert len(gold_of(warehouse)) == 1
    run_daily(spark, feed(line("T4")), warehouse.base_dir, "run-3", AS_OF)
    assert rows_of(warehouse.silver(), "raw_transaction_id") == [("T1",), ("T2",), ("T3",), ("T4",)]
    layers = ["silver_transactions", "gold_daily_account_summary"]
    scopes = refresh.refresh_scopes(warehouse, layers, AS_OF + timedelta(days=1))
    assert all(scope.nothing_to_do for scope in scopes.values())


def test_a_load_over_many_periods_stays_partial(spark, tmp_path, feed):
    """However many days a load touches, untouched months keep their refresh time."""
    days = [(datetime(2019, 1, 1) + timedelta(days=i)).isoformat() for i in range(1100)]
    warehouse = Warehouse(spark, str(tmp_path / "wh"), grain="month")
    later = AS_OF + timedelta(hours=5)
    refresh.load_feed(warehouse, feed(*(line(f"T{i}", posted_at=d) for i, d in enumerate(days))), "run-1", AS_OF)
    refresh.refresh_silver(warehouse, AS_OF)
    second = [line(f"U{i}", posted_at=d) for i, d in enumerate(days) if i >= 59]
    refresh.load_feed(warehouse, feed(*second), "run-2", later)
    assert not refresh.refresh_silver(warehouse, later).full
    counts = rows_of(warehouse.silver().groupBy("refreshed_at").count())
    assert counts == [(AS_OF, 59), (later, 2 * (1100 - 59))]


def test_replay_of_a_row_that_shares_its_hash_over_periods(spark, tmp_path, feed):
    """With the separator inside fields, two rows of different days can have one hash: the second is a replay."""
    one = line("T", "A", "2026-05-20", "1", "2026-05-21|1|USD", "d", "", "posted")
    two = line("T", "A|2026-05-20|1", "2026-05-21", "1", "USD", "d", "", "posted")
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    assert refresh.load_feed(warehouse, feed(one), "run-1", AS_OF).ingested == 1
    assert refresh.load_feed(warehouse, feed(two, line("T9")), "run-2", AS_OF).by_source == {"source_a": (1, 0)}


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def test_scans_are_pruned(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = [line(f"T{d}", posted_at=f"2026-05-{d:02}T08:00:00") for d in range(1, 9)]
    run_daily(spark, feed(*rows), warehouse.base_dir, "run-1", AS_OF)

    picked = warehouse.silver_between(datetime(2026, 5, 3, 9), datetime(2026, 5, 5, 9))
    assert rows_of(picked, "raw_transaction_id") == [("T4",), ("T5",)]
    plan = plan_of(picked.select("amount"))
    assert "PartitionFilters: [isnotnull(posted_period" in plan
    assert "ReadSchema: struct<posted_at:timestamp_ntz,amount:double>" in plan
    assert "PushedFilters: [IsNotNull(posted_at)" in plan

    replay = refresh.net_new_rows(warehouse, feed(rows[2]), "run-2", AS_OF)
    plan = plan_of(replay)
    assert "posted_period" in plan.split("PartitionFilters:")[1].split("\n")[0]
    assert "ReadSchema: struct<raw_line_hash:string>" in plan
    assert replay.count() == 0

    assert "dynamicpruning" in plan_of(warehouse.newest_silver()) or "Subquery" in plan_of(
        warehouse.newest_silver()
    )


def test_report_plan_has_no_join(spark, tmp_path):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    plan = plan_of(report.health_report(warehouse.runs(), warehouse.quarantine(), AS_OF))
    assert "Join" not in plan and "Cartesian" not in plan


def test_warehouse_keeps_its_grain(spark, tmp_path):
    Warehouse(spark, str(tmp_path / "wh"), "month")
    with pytest.raises(ValueError, match="grain"):
        Warehouse(spark, str(tmp_path / "wh"), "day")
    with pytest.raises(ValueError, match="grain"):
        Warehouse(spark, str(tmp_path / "other"), "week")
    assert rows_of(spark.range(1).select(clock.period_of(clock.at(AS_OF), "year"))) == [(date(2026, 1, 1),)]


def test_run_ids():
    assert new_run_id(AS_OF).startswith("run-20260524232846-")
    assert len({new_run_id(AS_OF) for _ in range(100)}) == 100


def test_run_id_must_be_a_folder_name(spark, tmp_path, feed):
    with pytest.raises(RunFailed, match="folder"):
        run_daily(spark, feed(line()), str(tmp_path / "wh"), "a/b", AS_OF)
