"""The stored layer tables: where they lie, how they are read, replaced and compacted.

Layout under ``base_dir``:

``transactions/write=W/route=bronze|quarantine/source_name=S/posted_period=D``
    both routes of every load; a load is one write;
``silver_transactions``, ``gold_daily_account_summary``, ``ai_ready_financial_notes`` ``/write=W/posted_period=D``
    derived layers, replaced period by period;
``replay_bitmaps/write=W/posted_period=D``
    bitmaps of the accepted rows' hashes, one write for each load (see ``operators.replay``);
``_log``
    the manifest of files and its versions (see ``snapshots``);
``pipeline_runs``, ``pipeline_metrics``
    one row per run.

A write shows nothing until a version names its files, so readers see loads and layers whole, and what a crash leaves
behind is never read. ``posted_period`` is the day of ``posted_at``, or the first day of its month or year, as the grain
says. Choose the finest grain at which a period still fills a file (100 MB or more): a coarser one re-ranks more rows
per late row, a finer one writes many small files.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ledgersieve import schemas
from ledgersieve.functions import clock, text
from ledgersieve.operators import quality, replay
from ledgersieve.operators.ingest import HASH_KEY, accepted_rows, rejected_rows
from ledgersieve import files as store
from ledgersieve.plans.snapshots import COMPRESSION, ConcurrentChange, Snapshots, Version, no_rows
from ledgersieve.sinks.appends import one_row
from ledgersieve.sinks.exports import write_period_csv

PERIOD = "posted_period"
LOADS = "transactions"
BITMAPS = "replay_bitmaps"
EXPORT = "exports/ai_ready_financial_notes"
LOADED = "loads"
CHECKS = "silver_checks"
LOADED_RUNS = T.StructType([T.StructField("load_run_id", T.StringType()), T.StructField("version", T.LongType())])
LOAD_FOLDERS = ["route", "source_name", PERIOD]

# Layer table -> its schema, the column its period is taken from, and the order of the rows within a period.
PERIODIC_LAYERS = {
    "silver_transactions": (schemas.SILVER, "posted_at", ["posted_at", "natural_key"]),
    "gold_daily_account_summary": (schemas.GOLD, "run_date", ["run_date", "account_id", "currency"]),
    "ai_ready_financial_notes": (schemas.NOTES, "transaction_date", ["transaction_date", "account_id", "natural_key"]),
}


def _with_period(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(PERIOD, T.DateType())])


@dataclass(frozen=True)
class Replacement:
    """New files of a layer that are written but in no version yet."""

    tables: dict[str, DataFrame]
    held: dict[str, dict]


class Warehouse:
    """The tables as of one version; ``refreshed()`` gives them as of the newest one.

    Reads without a version see the newest one at the time of the call.
    """

    def __init__(self, spark: SparkSession, base_dir: str, grain: str = "day", version: int | None = None):
        clock.period_of(F.lit(None), grain)  # rejects an unknown grain
        self.spark = spark
        self.base_dir = base_dir.rstrip("/")
        self.grain = grain
        self.snapshots = Snapshots(spark, self.base_dir)
        stored = self.snapshots.start(grain)
        if stored.grain != grain:
            raise ValueError(f"this warehouse was made with grain {stored.grain!r}, not {grain!r}")
        self._fixed = None if version is None else self.snapshots.at(version)

    def version(self) -> Version:
        return self._fixed or self.snapshots.newest()

    def path(self, table: str) -> str:
        return f"{self.base_dir}/{table}"

    # Reads ------------------------------------------------------------------------------------------

    def _small(self, table: str, schema: T.StructType) -> DataFrame:
        """A table of one row per run. It has no folder before its first row."""
        if not any(name.startswith("part-") for name in store.names(self.spark, self.path(table))):
            return no_rows(self.spark, schema)
        return self.spark.read.schema(schema).parquet(self.path(table))

    def routed(self, chosen: Column | DataFrame | None = None) -> DataFrame:
        return self.snapshots.read(self.version(), LOADS, schemas.ROUTED, chosen)

    def accepted_hashes(self, files: DataFrame, periods: DataFrame | None = None) -> DataFrame:
        """Hash keys of some files of the loads; no other column is read.

        With ``periods`` Spark prunes again at run time, so a plan that is kept and run later reads no more than it needs.
        """
        paths = [row.path for row in files.select("path").collect()]
        rows = self.snapshots.open(LOADS, schemas.ROUTED, paths)
        if periods is not None:
            rows = rows.join(periods.where(F.col(PERIOD).isNotNull()), PERIOD, "left_semi")
        return rows.select(*HASH_KEY)

    def bitmaps(self, periods: DataFrame, chosen: Column) -> DataFrame:
        """The replay bitmaps of some periods and loads."""
        found = self.snapshots.manifest(self.version(), BITMAPS).where(chosen).join(periods, PERIOD, "left_semi")
        return self.snapshots.open(BITMAPS, replay.SIDECAR, [row.path for row in found.select("path").collect()])

    def staged(self, rows: DataFrame, label: str) -> DataFrame:
        """Rows written beside the tables, for a load that uses them more than once; ``clean`` deletes them."""
        path = f"{self.base_dir}/_staging/{label}-{uuid.uuid4().hex[:12]}"
        rows.write.option("compression", COMPRESSION).parquet(path)
        return self.spark.read.schema(rows.schema).parquet(path)

    def bronze(self) -> DataFrame:
        return accepted_rows(self.routed(F.col("route") == "bronze"))

    def bronze_of(self, periods: DataFrame) -> DataFrame:
        """Accepted rows of the periods in a table of them; only their files are opened."""
        return accepted_rows(self.routed(periods))

    def quarantine(self) -> DataFrame:
        return rejected_rows(self.routed(F.col("route") == "quarantine"))

    def stored(self, layer: str, chosen: Column | DataFrame | None = None) -> DataFrame:
        """A periodic layer with its partition column."""
        return self.snapshots.read(self.version(), layer, _with_period(PERIODIC_LAYERS[layer][0]), chosen)

    def layer(self, layer: str, periods: DataFrame | None = None) -> DataFrame:
        return self.stored(layer, periods).drop(PERIOD)

    def layer_of(self, version: Version, layer: str, periods: DataFrame) -> DataFrame:
        """Some periods of a layer as one version has them, with their partition column."""
        return self.snapshots.read(version, layer, _with_period(PERIODIC_LAYERS[layer][0]), periods)

    def silver(self, periods: DataFrame | None = None) -> DataFrame:
        return self.layer("silver_transactions", periods)

    def silver_between(self, start: datetime, end: datetime) -> DataFrame:
        """Silver rows posted in [start, end). Only files whose least and greatest time overlap it are opened."""
        first, last = (clock.period_of(clock.at(moment), self.grain) for moment in (start, end))
        overlapping = (F.col("greatest") >= clock.at(start)) & (F.col("least") < clock.at(end))
        rows = self.stored("silver_transactions", overlapping).where(F.col(PERIOD).between(first, last))
        in_range = (F.col("posted_at") >= clock.at(start)) & (F.col("posted_at") < clock.at(end))
        return rows.where(in_range).drop(PERIOD)

    def newest_silver(self) -> DataFrame:
        """Silver rows of the newest period, found at run time and used as a partition filter."""
        rows = self.stored("silver_transactions")
        newest = self.files("silver_transactions").agg(F.max(PERIOD)).scalar()
        return rows.where(F.col(PERIOD) == newest).drop(PERIOD)

    def gold(self) -> DataFrame:
        return self.layer("gold_daily_account_summary")

    def notes(self) -> DataFrame:
        return self.layer("ai_ready_financial_notes")

    def runs(self) -> DataFrame:
        return self._small("pipeline_runs", schemas.PIPELINE_RUNS)

    def files(self, table: str) -> DataFrame:
        """The manifest of a table: a row for each file."""
        return self.snapshots.manifest(self.version(), table)

    def loads(self) -> DataFrame:
        """A row for each load that was committed: load_run_id, and the version that brought it first."""
        return self.snapshots.manifest(self.version(), LOADED, LOADED_RUNS)

    def check_states(self) -> DataFrame:
        """Counts of each silver period that the quality checks need; stored with the rows they count."""
        return self.snapshots.manifest(self.version(), CHECKS, quality.PERIOD_STATE)

    def row_count(self, table: str) -> int:
        """From the manifest; no data is read."""
        return self.files(table).agg(F.sum("row_count").alias("n")).first()["n"] or 0

    def register_views(self) -> None:
        """Make every layer table available to ``spark.sql`` under its name."""
        views = {
            "bronze_transactions": self.bronze(),
            "quarantine_transactions": self.quarantine(),
            "silver_transactions": self.silver(),
            "gold_daily_account_summary": self.gold(),
            "ai_ready_financial_notes": self.notes(),
            "pipeline_runs": self.runs(),
        }
        for name, rows in views.items():
            rows.createOrReplaceTempView(name)

    # Writes -----------------------------------------------------------------------------------------

    def write_routed(self, routed: DataFrame, run_id: str) -> Version:
        """Land one load. It becomes visible as a whole; a load with the same id is replaced, so a retry does not double.

        ``rebalance`` gathers each partition folder's rows into few files; where one source or period holds
        much of the data, AQE splits it over several tasks. Hashes go there as bytes, texts that are no hash as they are.
        """
        if not re.fullmatch(r"[A-Za-z0-9._-]+", run_id):
            raise ValueError(f"run id {run_id!r} cannot be a folder name")
        write_id = f"{run_id}-{uuid.uuid4().hex[:12]}"
        packed = routed.withColumn("__bytes", text.hash_bytes()).withColumn(
            "raw_line_hash", F.expr("if(__bytes is null, raw_line_hash, null)")
        )
        whole = F.coalesce(text.hash_text("__bytes"), "raw_line_hash")
        gathered = packed.hint("rebalance", *LOAD_FOLDERS).withColumn("raw_line_hash", whole).select(routed.columns)
        self.snapshots.write(LOADS, gathered, LOAD_FOLDERS, write_id)
        landed = self.snapshots.open(LOADS, schemas.ROUTED, [f"write={write_id}"]).where("route = 'bronze'")
        found = replay.bitmaps(landed.select("raw_line_hash", "source_name", PERIOD))
        self.snapshots.write(BITMAPS, found.hint("rebalance", PERIOD), [PERIOD], write_id)
        while True:
            start = self.snapshots.newest()
            number = start.number + 1
            added = self.snapshots.listed(LOADS, schemas.ROUTED, write_id, "posted_at", number, run_id)
            kept = self.snapshots.manifest(start, LOADS).where(~F.col("load_run_id").eqNullSafe(run_id))
            loads = self.snapshots.manifest(start, LOADED, LOADED_RUNS)
            load = one_row(self.spark, LOADED_RUNS, {"load_run_id": run_id, "version": number})
            bits = self.snapshots.manifest(start, BITMAPS).where(~F.col("load_run_id").eqNullSafe(run_id))
            tables = {
                LOADS: kept.unionByName(added),
                BITMAPS: bits.unionByName(self.snapshots.listed(BITMAPS, replay.SIDECAR, write_id, None, number, run_id)),
                LOADED: loads.where(F.col("load_run_id") != run_id).unionByName(load),
            }
            try:
                new = self.snapshots.commit(start, tables)
            except ConcurrentChange:
                continue
            if new.number == number:
                return new

    def replace_layer(
        self, layer: str, rows: DataFrame, periods: DataFrame | None = None, held: dict | None = None, gathered: bool = False
    ) -> Replacement:
        """Write a whole layer, or the given periods of it, for a commit to put in force.

        Files of a period lie in the order of its rows, so their statistics and those of their row groups tell
        accounts and times apart. Periods that no row is left of have no file afterwards. The counts that the quality
        checks need are taken from the written files and stored with them. ``gathered`` says that the rows come period by
        period, as a scan of another layer gives them, so that no shuffle has to bring those of a period together.
        """
        schema, moment, order = PERIODIC_LAYERS[layer]
        start = self.version()
        write_id = uuid.uuid4().hex
        placed = rows.select(*schema.fieldNames(), clock.period_of(F.col(moment), self.grain).alias(PERIOD))
        together = placed if gathered else placed.hint("rebalance", PERIOD)
        self.snapshots.write(layer, together.sortWithinPartitions(PERIOD, *order), [PERIOD], write_id)
        added = self.snapshots.listed(layer, _with_period(schema), write_id, moment, start.number + 1)
        tables = {layer: self._exchanged(self.snapshots.manifest(start, layer), periods, added)}
        if layer == "silver_transactions":
            written = self.snapshots.open(layer, _with_period(schema), [f"write={write_id}"])
            states = self.snapshots.manifest(start, CHECKS, quality.PERIOD_STATE)
            tables[CHECKS] = self._exchanged(states, periods, quality.period_states(written))
        return Replacement(tables, {layer: held or {}})

    @staticmethod
    def _exchanged(old: DataFrame, periods: DataFrame | None, new: DataFrame) -> DataFrame:
        return new if periods is None else old.join(periods, PERIOD, "left_anti").select(new.columns).unionByName(new)

    def put_in_force(self, start: Version, replacements: list[Replacement]) -> Version:
        """Commit the new files of several layers as one version."""
        tables = {name: rows for each in replacements for name, rows in each.tables.items()}
        held = {layer: state for each in replacements for layer, state in each.held.items()}
        return self.snapshots.commit(start, tables, held)

    # Export -----------------------------------------------------------------------------------------

    def export_notes(self) -> list[str]:
        """Bring the CSV export of the notes up to date: only periods whose files have changed are written anew.

        The export is a folder of CSV files with a header. Rows are ordered within a file, and the files by their names,
        which begin with the period; a period of many rows has several, made by ranges. The export's manifest says
        which files count and which files of the notes they were made from. New files are moved in under new names
        before the manifest names them, and old ones are deleted after that, so whoever reads by the manifest sees one
        whole export; a plain reader of the folder should not read while it is written. Files that an export which
        crashed has left are deleted first. Gives the periods that were written.
        """
        notes, folder = "ai_ready_financial_notes", self.path(EXPORT)
        start = self.snapshots.newest()
        wanted = self.snapshots.manifest(start, notes).select(PERIOD, "write_id").distinct()
        made = self.snapshots.manifest(start, EXPORT)
        listed = {row.path for row in made.select("path").collect()}
        for name in store.names(self.spark, folder):
            if name not in listed:
                store.remove(self.spark, f"{folder}/{name}")
        changed = self.snapshots.kept(wanted.join(made.select(PERIOD, "write_id"), [PERIOD, "write_id"], "left_anti").select(PERIOD).distinct())
        kept = made.join(wanted, [PERIOD, "write_id"], "left_semi").join(changed, PERIOD, "left_anti").select(made.columns)
        kept = self.snapshots.kept(kept)
        beside = f"{self.base_dir}/_staging/export-{uuid.uuid4().hex[:12]}"
        order = PERIODIC_LAYERS[notes][2]
        write_period_csv(self.layer_of(start, notes, changed), beside, PERIOD, order)
        moved = []
        store.make_folder(self.spark, folder)
        for period in sorted(name for name in store.names(self.spark, beside) if "=" in name):
            for name in sorted(n for n in store.names(self.spark, f"{beside}/{period}") if n.startswith("part-")):
                target = f"{period.partition('=')[2]}-{name}"
                store.move(self.spark, f"{beside}/{period}/{name}", f"{folder}/{target}")
                moved.append((target, period.partition("=")[2]))
        names = self.spark.createDataFrame(moved, "path string, period string") if moved else None
        fresh = kept.limit(0)
        if names is not None:
            dated = names.select("path", F.col("period").cast("date").alias(PERIOD)).join(wanted, PERIOD)
            fresh = dated.select([(F.col(f.name) if f.name in dated.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in kept.schema])
        self.snapshots.commit(start, {EXPORT: kept.unionByName(fresh)})
        now = {row.path for row in self.files(EXPORT).select("path").collect()}
        for name in store.names(self.spark, folder):
            if name not in now:
                store.remove(self.spark, f"{folder}/{name}")
        return sorted({period for _, period in moved})

    def exported_files(self) -> list[str]:
        """The files of the export in the order of their rows."""
        return [f"{self.path(EXPORT)}/{row.path}" for row in self.files(EXPORT).select("path").distinct().orderBy("path").collect()]

    # Upkeep -----------------------------------------------------------------------------------------

    def compact(self, table: str = LOADS, small: int = 32 * 1024 * 1024, target: int = 128 * 1024 * 1024) -> Version:
        """Merge the small files of a table: those of one route, source and period, as many as fill a file.

        Small files are put into bins by their sizes as the manifest has them: in the order of their paths, a new bin
        begins where the running sum passes the target. Only loads that every layer holds are merged, so a load that
        may still be retried keeps its own files. The rows stay as they are; the new files carry the newest version of
        theirs, and one commit exchanges the old files for the new.
        """
        start = self.snapshots.newest()
        manifest = self.snapshots.manifest(start, table)
        found = manifest.where(F.col("byte_count") < small)
        if table == LOADS:
            held = min((start.held(layer) for layer in PERIODIC_LAYERS), default=0)
            found = found.where(F.col("version") <= held)
        place = [name for name in LOAD_FOLDERS if table == LOADS or name == PERIOD]
        running = Window.partitionBy(*place).orderBy("path").rowsBetween(Window.unboundedPreceding, -1)
        binned = found.withColumn("bin", F.floor(F.coalesce(F.sum("byte_count").over(running), F.lit(0)) / target))
        several = Window.partitionBy(*place, "bin")
        merged = binned.withColumn("many", F.count(F.lit(1)).over(several)).where("many > 1").drop("many")
        merged = self.snapshots.kept(merged)
        if merged.isEmpty():
            return start
        schema, moment = (schemas.ROUTED, "posted_at") if table == LOADS else (
            _with_period(PERIODIC_LAYERS[table][0]), PERIODIC_LAYERS[table][1]
        )
        paths = [row.path for row in merged.select("path").collect()]
        rows = self.snapshots.open(table, schema, paths)
        write_id = uuid.uuid4().hex
        order = [] if table == LOADS else PERIODIC_LAYERS[table][2]
        self.snapshots.write(
            table, rows.hint("rebalance", *place).sortWithinPartitions(*place, *order), place, write_id
        )
        newest = merged.agg(F.max("version").alias("v")).first()["v"]
        added = self.snapshots.listed(table, schema, write_id, moment, newest)
        rest = manifest.join(merged.select("path"), "path", "left_anti").select(added.columns)
        return self.snapshots.commit(start, {table: rest.unionByName(added)})

    def compact_bitmaps(self) -> Version:
        """Put the replay bitmaps of each source and period together: one for each size and bucket instead of one a load."""
        start = self.snapshots.newest()
        held = min((start.held(layer) for layer in PERIODIC_LAYERS), default=0)
        manifest = self.snapshots.manifest(start, BITMAPS)
        old = self.snapshots.kept(manifest.where(F.col("version") <= held))
        if old.select("write_id").distinct().count() < 2:
            return start
        write_id = uuid.uuid4().hex
        rows = self.snapshots.open(BITMAPS, replay.SIDECAR, [row.path for row in old.select("path").collect()])
        self.snapshots.write(BITMAPS, replay.merged(rows).hint("rebalance", PERIOD), [PERIOD], write_id)
        added = self.snapshots.listed(BITMAPS, replay.SIDECAR, write_id, None, held)
        rest = manifest.join(old.select("path"), "path", "left_anti").select(added.columns)
        return self.snapshots.commit(start, {BITMAPS: rest.unionByName(added)})

    def clean(self, keep_versions: int = 10) -> list[str]:
        """Delete writes that none of the newest versions names, and staged rows. Don't run it beside a load or refresh.

        Gives the deleted folders. Readers of older versions fail afterwards.
        """
        newest = self.snapshots.newest()
        numbers = range(max(1, newest.number - keep_versions + 1), newest.number + 1)
        tables = [LOADS, BITMAPS, *PERIODIC_LAYERS]
        store.remove(self.spark, self.path("_staging"))
        store.remove(self.spark, f"{self.snapshots.log}/work")
        used: dict[str, set[str]] = {table: set() for table in tables}
        for number in numbers:
            version = self.snapshots.at(number)
            for table in tables:
                found = self.snapshots.manifest(version, table).select("write_id").distinct()
                used[table].update(row.write_id for row in found.collect())
        gone = []
        for table in tables:
            for name in store.names(self.spark, self.path(table)):
                if name.startswith("write=") and name.removeprefix("write=") not in used[table]:
                    store.remove(self.spark, f"{self.path(table)}/{name}")
                    gone.append(f"{table}/{name}")
        return sorted(gone)


def all_periods(days: list[date], spark: SparkSession) -> DataFrame:
    """A table of periods, for reads of chosen ones."""
    return spark.createDataFrame([(day,) for day in days], f"{PERIOD} date")
