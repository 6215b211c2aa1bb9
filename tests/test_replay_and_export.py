"""Replay bitmaps against the plain anti-join, and the export that follows changed periods."""

from __future__ import annotations

import csv
import random
from datetime import timedelta
from pathlib import Path

import pytest
from conftest import AS_OF, line, rows_of

from ledgersieve.operators import conform, ingest, replay
from ledgersieve import files as store
from ledgersieve.plans import refresh
from ledgersieve.plans.daily_run import run_daily
from ledgersieve.plans.warehouse import BITMAPS, Warehouse

LAYERS = ["gold_daily_account_summary", "ai_ready_financial_notes"]


def plain_net_new(warehouse, feed, run_id):
    routed = ingest.route_feed(feed, run_id, AS_OF, warehouse.grain)
    return ingest.skip_replayed(routed, warehouse.bronze())


@pytest.mark.parametrize("sparsity", [16, 0.001])
def test_bitmaps_give_what_the_plain_anti_join_gives(spark, tmp_path, feed, monkeypatch, sparsity):
    """Replays, new rows and rows whose bit is set by another row; with almost every bit set too."""
    monkeypatch.setattr(replay, "SPARSITY", sparsity)
    monkeypatch.setattr(replay, "BUCKET_BITS", 15)
    rng = random.Random(5)

    def some(n, prefix):
        days = [f"2026-05-{rng.randint(1, 4):02}T08:00:00" for _ in range(n)]
        return [line(f"{prefix}{i}", rng.choice(["ACC-1", ""]) if i % 9 == 0 else "ACC-2", d) for i, d in enumerate(days)]

    first, other = some(300, "A"), some(300, "C")
    warehouse = Warehouse(spark, str(tmp_path / "wh"), "month")
    refresh.load_feed(warehouse, feed(*first), "run-1", AS_OF)
    refresh.load_feed(warehouse, feed(*other, source="source_b"), "run-2", AS_OF)
    odd = [line("T|x", description="a|b"), line(None), line("Z", posted_at="2026-07-01T00:00:00"), line("Y", amount="abc")]
    delivery = feed(*first[::2], *some(700, "B"), *odd).union(feed(*other[:50], *first[:50], source="source_b"))
    found = refresh.net_new_rows(warehouse, delivery, "run-3", AS_OF)
    wanted = plain_net_new(warehouse, delivery, "run-3")
    assert rows_of(found, *wanted.columns) == rows_of(wanted)
    staged = warehouse.staged(ingest.stage_feed(delivery, "run-3", AS_OF, "month"), "test")
    due = staged.select(ingest.F.col("due_period").alias("posted_period")).distinct()
    maybe = replay.possible_replays(staged, warehouse.bitmaps(due, ingest.F.lit(True)))
    bronze = warehouse.bronze().select(*ingest.HASH_KEY)
    replayed = staged.join(bronze, ingest.HASH_KEY, "left_semi").count()
    assert maybe.join(bronze, ingest.HASH_KEY, "left_semi").count() == replayed
    assert replayed < maybe.count() < staged.count()  # some bits are set by other rows, and most rows are ruled out


def test_rows_that_can_not_be_replays_meet_no_stored_hash(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    refresh.load_feed(warehouse, feed(line("A"), line("B", posted_at="2026-05-21T08:00:00")), "run-1", AS_OF)
    new = refresh.net_new_rows(warehouse, feed(line("C"), line("D", posted_at="2026-05-22T08:00:00")), "run-2", AS_OF)
    assert new.count() == 2 and not any("/transactions/" in path for path in new.inputFiles())
    half = refresh.net_new_rows(warehouse, feed(line("A"), line("D", posted_at="2026-05-21T08:00:00")), "run-2", AS_OF)
    assert rows_of(half, "raw_transaction_id") == [("D",)]
    opened = [path for path in half.inputFiles() if "/transactions/" in path]
    assert opened and all("posted_period=2026-05-20" in path for path in opened)


def test_merged_bitmaps_answer_alike(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), "month")
    loads = [[line(f"T{i}-{j}", posted_at=f"2026-05-0{1 + j}T08:00:00") for j in range(5)] for i in range(3)]
    for i, rows in enumerate(loads):
        refresh.load_feed(warehouse, feed(*rows), f"run-{i}", AS_OF)
    refresh.refresh_silver(warehouse, AS_OF)
    refresh.publish_layers(warehouse, AS_OF, refresh.refresh_scopes(warehouse, LAYERS, AS_OF))
    assert warehouse.files(BITMAPS).count() == 3
    warehouse.compact_bitmaps()
    assert warehouse.files(BITMAPS).count() == 1
    delivery = feed(*sum(loads, []), line("N", posted_at="2026-05-03T08:00:00"))
    assert refresh.load_feed(warehouse, delivery, "run-9", AS_OF).ingested == 1


def test_a_load_that_is_retried_is_not_its_own_replay(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    for _ in range(2):
        assert refresh.load_feed(warehouse, feed(line("A"), line("B")), "run-1", AS_OF).ingested == 2
    assert warehouse.bronze().count() == 2
    assert refresh.load_feed(warehouse, feed(line("A"), line("C")), "run-2", AS_OF).ingested == 1


def exported(warehouse):
    rows = []
    for path in warehouse.exported_files():
        with open(path, newline="") as file:
            rows += list(csv.DictReader(file))
    return rows


def test_export_rewrites_changed_periods_only(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    rows = [line(f"T{d}-{k}", f"ACC-{9 - k}", f"2026-05-{d:02}T08:00:00") for d in range(1, 7) for k in range(3)]
    run_daily(spark, feed(*rows), warehouse.base_dir, "run-1", AS_OF)
    folder = Path(warehouse.path("exports/ai_ready_financial_notes"))
    before = {p.name: p.stat().st_mtime_ns for p in folder.glob("*.csv")}
    late = [line("L", "ACC-5", "2026-05-03T21:00:00", description='a "b"\nc')]
    gone = [line(f"T5-{k}", f"ACC-{9 - k}", "2026-05-05T08:00:00", updated_at="2026-05-21T00:00:00", status="deleted") for k in range(3)]
    run_daily(spark, feed(*late, *gone), warehouse.base_dir, "run-2", AS_OF + timedelta(hours=1))
    after = {p.name: p.stat().st_mtime_ns for p in folder.glob("*.csv")}
    assert {name[:10] for name in set(before) ^ set(after)} == {"2026-05-03", "2026-05-05"}
    assert all(after[name] == before[name] for name in set(before) & set(after))
    found = exported(warehouse)
    assert [(r["transaction_date"], r["account_id"]) for r in found] == sorted((r["transaction_date"], r["account_id"]) for r in found)
    assert sorted(r["natural_key"] for r in found) == [r[0] for r in rows_of(warehouse.notes(), "natural_key")]
    assert len(found) == 16 and set(after) == {Path(p).name for p in warehouse.exported_files()}
    assert warehouse.export_notes() == []


def test_export_of_a_crashed_run_is_made_up_for(spark, tmp_path, feed, monkeypatch):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    run_daily(spark, feed(line("A")), warehouse.base_dir, "run-1", AS_OF)
    run_daily(spark, feed(line("B", posted_at="2026-05-21T08:00:00")), warehouse.base_dir, "run-2", AS_OF, export_notes=False)
    real = store.create_text

    class Crash(BaseException):
        pass

    def crash(*_):
        raise Crash

    monkeypatch.setattr(store, "create_text", crash)
    with pytest.raises(Crash):
        warehouse.export_notes()
    monkeypatch.setattr(store, "create_text", real)
    assert len(exported(warehouse)) == 1  # the moved file is not in the manifest yet
    assert warehouse.export_notes() == ["2026-05-21"]
    assert len(exported(warehouse)) == 2
    assert len(list(Path(warehouse.path("exports/ai_ready_financial_notes")).glob("*.csv"))) == 2


def plan_of(rows):
    return rows._jdf.queryExecution().executedPlan().toString()


def test_replays_are_found_by_the_bytes_of_hashes_too(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"), "month")
    refresh.load_feed(warehouse, feed(line("A"), line("B")), "run-1", AS_OF)
    parsed = ingest.parsed_feed(feed(line("A"), line("A"), line("C")), AS_OF, "month")
    sidecar = warehouse.bitmaps(parsed.select(ingest.F.col("due_period").alias("posted_period")).distinct(), ingest.F.lit(True))
    found = ingest.with_hash_text(replay.possible_replays(parsed, sidecar)).select("raw_line_hash")
    stored = warehouse.bronze().where("raw_transaction_id = 'A'").select("raw_line_hash")
    assert dict(parsed.dtypes)["raw_line_hash"] == "binary"
    assert rows_of(found.intersect(stored)) == rows_of(stored) and found.count() < 3


def test_copies_within_a_later_load_are_dropped(spark, tmp_path, feed):
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    refresh.load_feed(warehouse, feed(line("A")), "run-1", AS_OF)
    delivery = feed(line("A"), line("A"), line("B"), line("B"), line("C|", description="x|y"), line("C|", description="x|y"))
    new = refresh.net_new_rows(warehouse, delivery, "run-2", AS_OF)
    assert rows_of(new, "raw_transaction_id") == [("B",), ("C|",)]
    # Copies are dropped by the shuffle that meets the replays, not by one of their own before.
    assert "WindowGroupLimit" in plan_of(new)


def test_bitmaps_are_made_after_their_shuffle(spark):
    rows = spark.range(5000).selectExpr(
        "sha2(string(id), 256) as raw_line_hash", "'s' as source_name", "date'2026-05-01' as posted_period"
    )
    plan = plan_of(replay.bitmaps(rows))
    assert plan.index("partial_bitmap_construct_agg") < plan.index("REPARTITION_BY_COL")
    assert replay.bitmaps(rows).selectExpr("sum(bitmap_count(bitmap)) as n").first().n > 4500


def test_loads_keep_the_text_of_every_hash(spark, tmp_path, feed):
    """Hashes go through shuffles as bytes; texts that bytes would not give back stay texts."""
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    odd = ["ab", "AB", "abc", "", "no hash", None, "é" * 20]
    routed = ingest.route_feed(feed(*[line(f"T{i}") for i in range(len(odd) + 1)]), "run-1", AS_OF)
    chosen = ingest.F.expr("map({})".format(", ".join(f"'T{i}', {'null' if h is None else repr(h)}" for i, h in enumerate(odd))))
    hashed = routed.withColumn("raw_line_hash", ingest.F.expr("if(raw_transaction_id = 'T7', raw_line_hash, null)"))
    hashed = hashed.withColumn("raw_line_hash", ingest.F.coalesce("raw_line_hash", chosen[ingest.F.col("raw_transaction_id")]))
    wanted = rows_of(hashed, "raw_transaction_id", "raw_line_hash")
    warehouse.write_routed(hashed, "run-1")
    assert rows_of(warehouse.bronze(), "raw_transaction_id", "raw_line_hash") == wanted
    assert all(path.endswith(".zstd.parquet") for path in warehouse.bronze().inputFiles())


def test_silver_shuffles_no_text_of_hashes_and_no_time_in_keys(spark, feed):
    rows = feed(line("A"), line("A", "ACC-2"), line(None), line("", description="x"), source="s|A")
    silver = conform.silver(ingest.accepted_rows(ingest.route_feed(rows, "run-1", AS_OF)), AS_OF)
    keys = rows_of(silver, "natural_key")
    assert keys == [("s|A|A|2026-05-20 08:00:00",), ("s|A||2026-05-20 08:00:00",)]
    plan = plan_of(silver)
    assert "cast(posted_at" in plan[: plan.index("Exchange hashpartitioning(posted_at")]


def test_notes_are_written_without_a_shuffle(spark, tmp_path, feed, monkeypatch):
    """Files of silver are of one period each, so the notes made from them need not be gathered."""
    warehouse = Warehouse(spark, str(tmp_path / "wh"))
    refresh.load_feed(warehouse, feed(line("A"), line("B", posted_at="2026-05-21T08:00:00")), "run-1", AS_OF)
    refresh.refresh_silver(warehouse, AS_OF)
    plans, write = {}, type(warehouse.snapshots).write

    def noted(self, table, rows, folders, write_id):
        plans[table] = plan_of(rows)
        write(self, table, rows, folders, write_id)

    monkeypatch.setattr(type(warehouse.snapshots), "write", noted)
    refresh.publish_layers(warehouse, AS_OF, refresh.refresh_scopes(warehouse, LAYERS, AS_OF))
    assert "Exchange" not in plans["ai_ready_financial_notes"] and "Exchange" in plans["gold_daily_account_summary"]
    assert rows_of(warehouse.notes(), "natural_key") == rows_of(warehouse.silver(), "natural_key")
