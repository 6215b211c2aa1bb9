"""Versions, manifests and compaction of the stored tables."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pyarrow.parquet as pq
import pytest
from conftest import AS_OF, line, rows_of

from ledgersieve.operators import quality
from ledgersieve import files as store
from ledgersieve.plans import refresh
from ledgersieve.plans.daily_run import RunFailed, run_daily
from ledgersieve.plans.snapshots import ConcurrentChange
from ledgersieve.plans.warehouse import LOADS, PERIODIC_LAYERS, Warehouse, all_periods

GOLD, NOTES, SILVER = "gold_daily_account_summary", "ai_ready_financial_notes", "silver_transactions"


def content(warehouse):
    skip = {"refreshed_at", "last_refresh_ts", "ingested_at"}
    layers = [warehouse.bronze(), warehouse.quarantine(), warehouse.silver(), warehouse.gold(), warehouse.notes()]
    return [rows_of(rows, *[c for c in rows.columns if c not in skip]) for rows in layers]


def days(n, month=5, prefix="T", **more):
    return [line(f"{prefix}{d}", f"ACC-{d % 3}", f"2026-{month:02}-{d:02}T08:00:00", **more) for d in range(1, n + 1)]


def opened(rows):
    return {path.rsplit("posted_period=", 1)[1][:10] for path in rows.inputFiles()}


@pytest.fixture
def two_loads(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    run_daily(spark, feed(*days(6)), warehouse.base_dir, "run-1", AS_OF, export_notes=False)
    run_daily(spark, feed(line("L1", posted_at="2026-05-03T21:30:00")), warehouse.base_dir, "run-2", AS_OF, export_notes=False)
    return warehouse


def test_reads_open_only_the_files_asked_for(spark, two_loads):
    assert opened(two_loads.silver_between(datetime(2026, 5, 2, 9), datetime(2026, 5, 4, 8))) == {"2026-05-03"}
    between = two_loads.silver_between(datetime(2026, 5, 3, 20), datetime(2026, 5, 3, 22))
    assert rows_of(between, "raw_transaction_id") == [("L1",)]
    assert opened(two_loads.gold()) == {f"2026-05-0{d}" for d in range(1, 7)}
    chosen = all_periods([date(2026, 5, 2), date(2026, 5, 5), date(2020, 1, 1)], spark)
    assert opened(two_loads.silver(chosen)) == opened(two_loads.bronze_of(chosen)) == {"2026-05-02", "2026-05-05"}
    assert two_loads.silver(chosen.limit(0)).count() == 0
    manifest = two_loads.files(SILVER).where("posted_period = '2026-05-03'").collect()
    assert sum(f.row_count for f in manifest) == 2
    assert max(f.greatest for f in manifest) == datetime(2026, 5, 3, 21, 30)
    assert all(f.byte_count > 0 for f in manifest)


def test_older_versions_stay_as_they_were(spark, two_loads, feed):
    before = two_loads.version().number
    seen = content(Warehouse(spark, two_loads.base_dir, version=before))
    gone = line("T2", "ACC-2", "2026-05-02T08:00:00", updated_at="2026-05-22T00:00:00", status="DELETED")
    run_daily(spark, feed(gone), two_loads.base_dir, "run-3", AS_OF, export_notes=False)
    assert content(Warehouse(spark, two_loads.base_dir, version=before)) == seen
    assert "2026-05-02" not in opened(two_loads.silver()) | opened(two_loads.gold())
    assert Warehouse(spark, two_loads.base_dir, version=1).bronze().count() == 0


def test_a_crash_at_any_step_shows_one_whole_version(spark, tmp_path, feed, monkeypatch):
    """The run dies before each of its commits, and before each write of a layer; readers see whole versions only."""
    base = str(tmp_path / "wh")
    run_daily(spark, feed(*days(3)), base, "run-1", AS_OF, export_notes=False)
    warehouse = Warehouse(spark, base)
    published = rows_of(warehouse.gold()), rows_of(warehouse.notes())
    delivery = feed(line("T2", "ACC-9", "2026-05-02T08:00:00", "99.00", updated_at="2026-05-09T00:00:00"), *days(2, 6, "N"))
    real_commit, real_write = store.create_text, warehouse.snapshots.__class__.write

    class Crash(BaseException):
        pass

    def dying(real, step):
        calls = []

        def call(*given, **named):
            calls.append(1)
            if len(calls) == step:
                raise Crash
            return real(*given, **named)

        return call

    for step in (1, 2, 3):
        monkeypatch.setattr(store, "create_text", dying(real_commit, step))
        with pytest.raises(Crash):
            run_daily(spark, delivery, base, f"crash-{step}", AS_OF + timedelta(days=20, minutes=step), export_notes=False)
        monkeypatch.setattr(store, "create_text", real_commit)
        assert (rows_of(warehouse.gold()), rows_of(warehouse.notes())) == published
        assert warehouse.silver().count() == (3 if step < 3 else 5)
    for step in (1, 2, 3, 4):
        monkeypatch.setattr(type(warehouse.snapshots), "write", dying(real_write, step))
        try:
            run_daily(spark, delivery, base, f"write-{step}", AS_OF + timedelta(days=21, minutes=step), export_notes=False)
        except Crash:
            assert (rows_of(warehouse.gold()), rows_of(warehouse.notes())) == published
        monkeypatch.setattr(type(warehouse.snapshots), "write", real_write)
        if rows_of(warehouse.gold()) != published[0]:
            break
    run_daily(spark, feed(line("E", posted_at="2026-05-30T08:00:00")), base, "run-9", AS_OF + timedelta(days=22), export_notes=False)
    whole = Warehouse(spark, str(tmp_path / "whole"))
    everything = feed(*days(3)).union(delivery).union(feed(line("E", posted_at="2026-05-30T08:00:00")))
    run_daily(spark, everything, whole.base_dir, "run-1", AS_OF + timedelta(days=22), export_notes=False)
    for layer in ("silver", "gold", "notes"):
        found, wanted = getattr(warehouse, layer)(), getattr(whole, layer)()
        columns = [c for c in found.columns if c not in ("refreshed_at", "last_refresh_ts", "load_run_id")]
        assert rows_of(found, *columns) == rows_of(wanted, *columns)


def test_of_two_writers_one_is_told(spark, two_loads, feed):
    start = two_loads.version()
    late = feed(line("L2", posted_at="2026-05-04T01:00:00"))
    mine = two_loads.replace_layer(GOLD, two_loads.gold(), None, {})
    refresh.load_feed(two_loads, late, "run-3", AS_OF)  # a load in between changes other tables
    assert two_loads.put_in_force(start, [mine]).number == start.number + 2
    assert two_loads.bronze().count() == 8
    other = two_loads.replace_layer(GOLD, two_loads.gold(), None, {})
    with pytest.raises(ConcurrentChange):
        two_loads.put_in_force(start, [other])


def test_two_loads_at_once_both_land(spark, two_loads, feed, monkeypatch):
    """Another load takes the next version while this one lists its files: it looks again and is numbered anew."""
    real = store.create_text
    done = []

    def beaten(spark_, path, text):
        if not done:
            done.append(1)
            refresh.load_feed(two_loads, feed(line("M1", posted_at="2026-05-05T01:00:00")), "run-4", AS_OF)
        return real(spark_, path, text)

    monkeypatch.setattr(store, "create_text", beaten)
    counts = refresh.load_feed(two_loads, feed(line("L2", posted_at="2026-05-04T01:00:00")), "run-3", AS_OF)
    monkeypatch.setattr(store, "create_text", real)
    assert counts.ingested == 1 and two_loads.bronze().count() == 9
    refresh.refresh_silver(two_loads, AS_OF)
    assert two_loads.silver().count() == 9


def test_compaction_merges_small_files_and_keeps_rows(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), "month")
    for i in range(8):
        rows = [line(f"T{i}-{j}", "" if j == 9 else "ACC-1", f"2026-05-{1 + i:02}T0{j}:00:00") for j in range(10)]
        refresh.load_feed(warehouse, feed(*rows, source="a b/é+%"), f"run-{i}", AS_OF)
    for layer in PERIODIC_LAYERS:
        assert warehouse.version().held(layer) == 0
    assert warehouse.compact().number == warehouse.version().number  # no layer holds the loads: nothing to merge
    refresh.refresh_silver(warehouse, AS_OF)
    refresh.publish_layers(warehouse, AS_OF, refresh.refresh_scopes(warehouse, [GOLD, NOTES], AS_OF))
    before, many = content(warehouse), warehouse.files(LOADS).count()
    assert many == 16
    warehouse.compact()
    assert warehouse.files(LOADS).count() == 2
    assert content(warehouse) == before
    assert {r.load_run_id for r in warehouse.bronze().collect()} == {f"run-{i}" for i in range(8)}
    scopes = refresh.refresh_scopes(warehouse, [SILVER, GOLD], AS_OF)
    assert all(scope.nothing_to_do for scope in scopes.values())
    again = [line("T3-1", "ACC-1", "2026-05-04T01:00:00"), line("T3-99", posted_at="2026-05-04T11:00:00")]
    assert refresh.load_feed(warehouse, feed(*again, source="a b/é+%"), "run-8", AS_OF).ingested == 1
    with pytest.raises(ValueError, match="already loaded"):
        refresh.load_feed(warehouse, feed(*again), "run-3", AS_OF)
    gone = warehouse.clean(keep_versions=1)
    assert len([name for name in gone if name.startswith(f"{LOADS}/")]) == 8
    assert warehouse.bronze().count() == 8 * 9 + 1


def test_bins_of_files_follow_their_sizes(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), "year")
    for i in range(6):
        refresh.load_feed(warehouse, feed(line(f"T{i}")), f"run-{i}", AS_OF)
    refresh.refresh_silver(warehouse, AS_OF)
    refresh.publish_layers(warehouse, AS_OF, refresh.refresh_scopes(warehouse, [GOLD, NOTES], AS_OF))
    before, one = content(warehouse), warehouse.files(LOADS).first().byte_count
    warehouse.compact(small=one // 2)
    assert warehouse.files(LOADS).count() == 6
    warehouse.compact()
    assert warehouse.files(LOADS).count() == 1 and content(warehouse) == before


def test_the_verdict_of_all_periods_from_their_counts(spark, tmp_path, feed):
    """Random loads with deletions, missing currencies and postings ahead of the clock: counts give what a scan gives."""
    rng = random.Random(11)
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for i in range(4):
        rows = [
            (
                f"T{rng.randint(0, 12)}",
                f"ACC-{rng.randint(1, 3)}",
                f"2026-05-{rng.randint(20, 25):02}T{rng.randint(0, 23):02}:00:00",
                "1.00",
                rng.choice(["USD", None]),
                "d",
                f"2026-05-2{rng.randint(0, 4)}T00:00:0{i}",
                rng.choice(["posted", "posted", "deleted"]),
            )
            for _ in range(25)
        ]
        refresh.load_feed(warehouse, feed(*rows), f"run-{i}", AS_OF)
        refresh.refresh_silver(warehouse, AS_OF)
        for clock in (AS_OF, AS_OF - timedelta(days=2)):
            states = warehouse.check_states()
            late = warehouse.silver(quality.late_periods(states, clock))
            assert rows_of(quality.checks_from_states(states, late, clock)) == rows_of(
                quality.quality_checks(warehouse.silver(), clock)
            )
    assert late.count() > 0 and warehouse.row_count(SILVER) == warehouse.silver().count()


def test_repeated_keys_are_counted_for_their_period(spark):
    schema = "posted_period date, natural_key string, account_id string, currency string, posted_at timestamp_ntz"
    day, at = date(2026, 5, 1), datetime(2026, 5, 1, 3)
    rows = [(day, "a", "x", "USD", at), (day, "a", None, "USD", at), (day, "b", "x", None, at), (date(2026, 5, 2), "c", "x", "USD", at)]
    assert rows_of(quality.period_states(spark.createDataFrame(rows, schema))) == [(day, 3, 2, 1, at), (date(2026, 5, 2), 1, 0, 0, at)]


def test_gold_lies_in_account_order_and_row_groups_can_be_skipped(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), "year")
    rng = random.Random(3)
    accounts = [f"ACC-{i:05}" for i in range(3000)]
    rng.shuffle(accounts)
    spark.conf.set("parquet.block.size", "16384")
    spark.conf.set("parquet.block.size.row.check.min", "10")
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", "16384")
    try:
        run_daily(spark, feed(*(line(f"T{a}", a) for a in accounts)), warehouse.base_dir, "run-1", AS_OF, "year", export_notes=False)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    for path in warehouse.gold().inputFiles():
        file = pq.ParquetFile(path.removeprefix("file://").removeprefix("file:"))
        found = file.read(["run_date", "account_id", "currency"]).to_pylist()
        assert found == sorted(found, key=lambda r: tuple(r.values()))
        column = file.schema_arrow.names.index("account_id")
        bounds = [file.metadata.row_group(g).column(column).statistics for g in range(file.num_row_groups)]
        assert len(bounds) > 1
        assert all(a.max <= b.min for a, b in zip(bounds, bounds[1:]))
        hit = [b for b in bounds if b.min <= "ACC-01234" <= b.max]
        assert len(hit) <= 1


def test_failed_gate_leaves_published_version(spark, tmp_path, feed):
    base = str(tmp_path / "wh")
    run_daily(spark, feed(line("T1")), base, "run-1", AS_OF, export_notes=False)
    warehouse = Warehouse(spark, base)
    before = warehouse.version()
    bad = feed(line("T2", posted_at="2026-05-21T08:00:00")).drop("currency").selectExpr("*", "cast(null as string) currency")
    with pytest.raises(RunFailed, match="null_key_check"):
        run_daily(spark, bad.select(feed(line()).columns), base, "run-2", AS_OF, export_notes=False)
    after = warehouse.version()
    assert after.tables[GOLD] == before.tables[GOLD] and after.tables[SILVER] != before.tables[SILVER]
