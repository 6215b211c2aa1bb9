"""Loading a feed and bringing the derived layers up to date, in full or only where something changed.

Every version of a transaction has the same ``posted_at`` (it is part of the natural key), so a load can only
change silver, gold and notes rows of the periods it has rows for. Each layer notes the version of the loads it holds;
what later versions brought is pending, and the manifest says which periods that touches.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgersieve.functions import text
from ledgersieve.operators import conform, ingest, publish, replay
from ledgersieve.plans.snapshots import Version
from ledgersieve.plans.warehouse import LOADED, LOADED_RUNS, LOADS, PERIOD, Warehouse


def net_new_rows(warehouse: Warehouse, feed: DataFrame, run_id: str, as_of: datetime) -> DataFrame:
    """Distinct routed rows of the feed that no other run has accepted.

    The feed is read once: hashed, parsed and routed rows are staged, and all that follows reads those. Copies are
    dropped after that, by the one shuffle that also brings the rows to the replays found among them. ``posted_at``
    is part of the hash, so a row can only be found again in its own period; the bitmaps of those periods say which rows
    may be there, and only these meet stored hashes. A daily load costs the same however long the history is. The
    exception is a row with the hash's separator inside a field, which can share its hash with a row of another period
    (never with a row that has no separator inside); such rows are compared with all periods.
    """
    version = warehouse.version()
    others = ~F.col("load_run_id").eqNullSafe(run_id)
    stored = warehouse.snapshots.manifest(version, LOADS).where(others & (F.col("route") == "bronze"))
    if stored.isEmpty():
        return ingest.stage_feed(feed, run_id, as_of, warehouse.grain).drop("due_period", "ambiguous")
    staged = warehouse.staged(ingest.parsed_feed(feed, as_of, warehouse.grain), run_id)
    due = warehouse.snapshots.kept(staged.where("due_period is not null").select(F.col("due_period").alias(PERIOD)).distinct())
    sidecar = warehouse.bitmaps(due, others)
    maybe = warehouse.staged(replay.possible_replays(staged.where("not ambiguous"), sidecar), f"{run_id}-maybe")
    periods = warehouse.snapshots.kept(maybe.select(F.col("due_period").alias(PERIOD)).distinct())
    seen = _in_bytes(warehouse.accepted_hashes(stored.join(periods, PERIOD, "left_semi"), periods))
    replayed = maybe.join(seen, ingest.HASH_KEY, "left_semi").select(*ingest.HASH_KEY)
    ambiguous = staged.where("ambiguous")
    if not ambiguous.isEmpty():
        every = ambiguous.join(_in_bytes(warehouse.accepted_hashes(stored)), ingest.HASH_KEY, "left_semi")
        replayed = replayed.unionByName(every.select(*ingest.HASH_KEY))
    new = ingest.skip_replayed(ingest.drop_exact_copies(staged), replayed).drop("due_period", "ambiguous")
    return ingest.label(ingest.with_hash_text(new), run_id, as_of, warehouse.grain)


def _in_bytes(keys: DataFrame) -> DataFrame:
    return keys.select(text.hash_bytes().alias("raw_line_hash"), "source_name")


@dataclass(frozen=True)
class LoadCounts:
    ingested: int
    quarantined: int
    by_source: dict[str, tuple[int, int]]


def load_feed(warehouse: Warehouse, feed: DataFrame, run_id: str, as_of: datetime) -> LoadCounts:
    """Route a feed into bronze and quarantine in one write job, then count what landed.

    The counts come from the manifest of the written files, not from accumulators, so a task that runs twice cannot
    change them.
    """
    now = warehouse.version()
    known = warehouse.snapshots.manifest(now, LOADED, LOADED_RUNS).where(F.col("load_run_id") == run_id).first()
    if known and known.version <= max((now.held(layer) for layer in now.layers), default=0):
        raise ValueError(f"run id {run_id!r} was already loaded; give every run its own id")
    warehouse.write_routed(net_new_rows(warehouse, feed, run_id, as_of), run_id)
    landed = (
        warehouse.files(LOADS)
        .where(F.col("load_run_id") == run_id)
        .groupBy("source_name")
        .agg(
            F.sum(F.when(F.col("route") == "bronze", F.col("row_count")).otherwise(0)).alias("ingested"),
            F.sum(F.when(F.col("route") == "quarantine", F.col("row_count")).otherwise(0)).alias("quarantined"),
        )
        .collect()
    )
    by_source = {row.source_name: (row.ingested, row.quarantined) for row in landed}
    return LoadCounts(
        ingested=sum(pair[0] for pair in by_source.values()),
        quarantined=sum(pair[1] for pair in by_source.values()),
        by_source=by_source,
    )


@dataclass(frozen=True)
class RefreshScope:
    """What a layer refresh must cover, worked out at one version.

    ``periods`` is a small table of them, or None for all (a forced refresh, a first one, or the clock went back).
    """

    start: Version
    periods: DataFrame | None
    nothing_to_do: bool = False

    @property
    def full(self) -> bool:
        return self.periods is None


def refresh_scopes(
    warehouse: Warehouse, layers: list[str], as_of: datetime, force_full: bool = False
) -> dict[str, RefreshScope]:
    """For each layer, find the loads it does not hold yet, also those of earlier runs that failed half-way.

    A partial refresh equals a full one as long as the clock does not go back: rows accepted at one time pass
    the same check at any later one. If it went back, now or at the last refresh, the scope is full.
    The periods stay a table: they come from the manifest, and reads and checks join them.
    """
    now = warehouse.version()
    scopes = {}
    pending: dict[int, RefreshScope] = {}
    for layer in layers:
        last, latest = now.clock(layer), now.clock(layer, "latest")
        if force_full or last is None or latest > as_of or latest != last:
            scopes[layer] = RefreshScope(now, None)
            continue
        held = now.held(layer)
        if held not in pending:
            new = (F.col("route") == "bronze") & (F.col("version") > held)
            periods = warehouse.snapshots.kept(warehouse.snapshots.manifest(now, LOADS).where(new).select(PERIOD).distinct())
            pending[held] = RefreshScope(now, periods, periods.isEmpty())
        scopes[layer] = pending[held]
    return scopes


def _held_after(scope: RefreshScope, layer: str, as_of: datetime) -> dict:
    latest = scope.start.clock(layer, "latest")
    return {
        "holds": scope.start.number,
        "as_of": as_of.isoformat(),
        "latest": max(as_of, latest or as_of).isoformat(),
    }


def refresh_silver(warehouse: Warehouse, as_of: datetime, force_full: bool = False) -> RefreshScope:
    layer = "silver_transactions"
    scope = refresh_scopes(warehouse, [layer], as_of, force_full)[layer]
    if scope.nothing_to_do:
        return scope
    bronze = warehouse.bronze() if scope.full else warehouse.bronze_of(scope.periods)
    made = warehouse.replace_layer(layer, conform.silver(bronze, as_of), scope.periods, _held_after(scope, layer, as_of))
    warehouse.put_in_force(scope.start, [made])
    return scope


def publish_layers(warehouse: Warehouse, as_of: datetime, scopes: dict[str, RefreshScope]) -> Version | None:
    """Refresh gold and notes from stored silver; one version brings both, so no reader sees one without the other.

    Until that version the new files are in no manifest: a crash before it leaves everything as it was, and the next
    run finds the same loads pending.
    """
    builders = {
        "gold_daily_account_summary": lambda rows: publish.gold_daily_account_summary(rows, as_of),
        "ai_ready_financial_notes": publish.financial_notes,
    }
    made = []
    for layer, build in builders.items():
        scope = scopes[layer]
        if not scope.nothing_to_do:
            rows = build(warehouse.silver(scope.periods))
            by_row = layer == "ai_ready_financial_notes"  # from the files of silver, each of one period
            held = _held_after(scope, layer, as_of)
            made.append(warehouse.replace_layer(layer, rows, scope.periods, held, gathered=by_row))
    if not made:
        return None
    return warehouse.put_in_force(min((s.start for s in scopes.values()), key=lambda v: v.number), made)
