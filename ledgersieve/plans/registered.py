"""The registered queries: each takes (spark, sf_dir), reads the given tables and gives a DataFrame.

``duck_sql`` has the SQL that computes the same rows. Queries that store data use a new folder under the
shared scratch folder on each call.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.operators import conform, ingest, publish, quality, report
from ledgersieve import files as store
from ledgersieve.plans import refresh
from ledgersieve.plans.daily_run import RunFailed, run_daily
from ledgersieve.plans.warehouse import LOADS, Warehouse
from ledgersieve.schemas import FEED_FIELDS, METRICS, NOTES
from ledgersieve.session import scratch_dir
from ledgersieve.sinks.appends import append_metrics
from ledgersieve.sinks.exports import export_notes_csv, promote_tables, write_feed_csv, write_report_csv
from ledgersieve.sources import derived
from ledgersieve.sources.csv_feeds import FeedSource, by_header_name, scan_feed, union_feeds
from ledgersieve.sources.derived import AS_OF, LATER, REPORT_TIME
from ledgersieve.sources.object_store import landing_manifest, listing_changes, object_store_sources, whole_listing

Query = Callable[[SparkSession, str], DataFrame]

RUN_1 = "run-20240129000000-00000001"
RUN_2 = "run-20240129000000-00000002"
EARLIER = datetime(2024, 1, 15)
GRAIN = "year"  # the tables hold few rows per month
RANGE = (datetime(1998, 3, 10), datetime(1998, 7, 20))

REGISTERED: dict[str, Query] = {}


def _register(query: Query) -> Query:
    REGISTERED[query.__name__] = query
    return query


# Shared inputs ----------------------------------------------------------------------------------------


def _routed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.route_feed(derived.transaction_feed(spark, sf_dir), RUN_1, AS_OF)


def _bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.accepted_rows(_routed(spark, sf_dir))


def _quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.rejected_rows(_routed(spark, sf_dir))


def _silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.silver(_bronze(spark, sf_dir), AS_OF)


def _distinct_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.drop_exact_copies(ingest.add_line_hash(derived.transaction_feed(spark, sf_dir)))


def _redelivery(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """A truncated delivery, and what the full redelivery after it still adds."""
    feed = derived.transaction_feed(spark, sf_dir)
    first = ingest.route_feed(derived.first_delivery(feed), RUN_1, AS_OF)
    second = ingest.skip_replayed(ingest.route_feed(feed, RUN_2, AS_OF), ingest.accepted_rows(first))
    return first, second


def _two_load_warehouse(spark: SparkSession, sf_dir: str, publish_too: bool = False, export_too: bool = False) -> Warehouse:
    """A stored warehouse, by month, after both deliveries; an export follows each if asked for.

    The second one comes later, touches the months of 1996 and empties June 1995; all other months keep the rows
    and the refresh time of the first one.
    """
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse"), "month")
    first, second = derived.late_delivery(derived.transaction_feed(spark, sf_dir))
    layers = ["gold_daily_account_summary", "ai_ready_financial_notes"]
    for run_id, delivery, clock in [(RUN_1, first, AS_OF), (RUN_2, second, LATER)]:
        refresh.load_feed(warehouse, delivery, run_id, clock)
        refresh.refresh_silver(warehouse, clock)
        if publish_too:
            refresh.publish_layers(warehouse, clock, refresh.refresh_scopes(warehouse, layers, clock))
        if export_too:
            warehouse.export_notes()
    return warehouse


def _stored(spark: SparkSession, rows: DataFrame, label: str) -> DataFrame:
    """Rows written once and read back, for queries that use them more than once."""
    path = scratch_dir(spark, label)
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


# Scans ------------------------------------------------------------------------------------------------


@_register
def csv_feed_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "feed-a")
    write_feed_csv(derived.orders_feed(spark, sf_dir).drop("source_name"), path)
    return scan_feed(spark, FeedSource("source_a", (path,)))


@_register
def feed_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two sources; the second has its columns in another order and one more column."""
    root = scratch_dir(spark, "feeds")
    write_feed_csv(derived.orders_feed(spark, sf_dir).drop("source_name"), f"{root}/a")
    reordered = derived.events_feed(spark, sf_dir).select(
        *sorted(FEED_FIELDS, reverse=True), F.lit("x").alias("vendor_note")
    )
    write_feed_csv(reordered, f"{root}/b")
    return union_feeds(
        spark, [FeedSource("source_a", (f"{root}/a",)), FeedSource("source_b", (f"{root}/b",))]
    )


@_register
def object_store_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve both feeds as objects under a prefix and scan them in place."""
    root = scratch_dir(spark, "bucket")
    write_feed_csv(derived.orders_feed(spark, sf_dir).drop("source_name"), f"{root}/feeds/daily/a.csv")
    write_feed_csv(derived.events_feed(spark, sf_dir).drop("source_name"), f"{root}/feeds/daily/b.csv")
    scheme, _, bucket = root.rpartition("://")
    sources = object_store_sources(
        spark, bucket, "feeds/daily/", {"source_a": "a.csv", "source_b": "b.csv"}, scheme=scheme or "file"
    )
    return ingest.run_counters(ingest.route_feed(union_feeds(spark, sources), RUN_1, AS_OF))


@_register
def feed_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as descriptions, and damaged records among them.

    Source a allows line breaks inside quotes; a tenth of its records are cut off after the amount. Source b does not
    allow them: of its records only those without a line break are whole, and what is left of the others goes to
    quarantine piece by piece, so that no deletion is taken for a posting. Gives what was accepted, and the cut records.
    """
    root = scratch_dir(spark, "malformed")
    documents = derived.document_feed(spark, sf_dir)
    cut = F.substr("transaction_id", F.lit(2)).cast("long") % 10 == 3
    write_feed_csv(documents.where(~cut), f"{root}/a")
    line = F.concat_ws(",", "transaction_id", "account_id", "posted_at", "amount")
    # No field of a cut record holds a comma or a quote, so the line needs no quoting; \x01 keeps it one column.
    documents.where(cut).select(line.alias(",".join(FEED_FIELDS))).write.option("header", True).option("sep", "\x01").csv(
        f"{root}/cut"
    )
    write_feed_csv(derived.conversation_feed(spark, sf_dir), f"{root}/b")
    sources = [FeedSource("source_a", (f"{root}/a", f"{root}/cut"), multiline=True), FeedSource("source_b", (f"{root}/b",))]
    routed = ingest.route_feed(union_feeds(spark, sources), RUN_1, AS_OF)
    return routed.where("route = 'bronze' or source_name = 'source_a'").select(
        "source_name",
        "raw_transaction_id",
        F.md5("description").alias("description_md5"),
        "status",
        "amount",
        "posted_at_text",
        "quarantine_reason",
    )


@_register
def feed_quoted_parallel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole texts as descriptions, with their quotes and line breaks, each file read by as many tasks as it has ranges."""
    root = scratch_dir(spark, "quoted")
    write_feed_csv(derived.document_feed(spark, sf_dir), root)
    feed = scan_feed(spark, FeedSource("source_a", (root,), multiline=True, strict_quotes=True))
    return feed.select("source_name", "transaction_id", F.md5("description").alias("description_md5"), "amount", "status")


@_register
def feed_damaged_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of records with line breaks in a feed that does not allow them: distinct pieces and their bytes.

    Every piece must be in quarantine with its text; a scan that lost one would show here. A piece that has as many
    commas as a record by chance is a record with a posting time that can't be read, and is put together from its fields.
    """
    root = scratch_dir(spark, "pieces")
    write_feed_csv(derived.conversation_feed(spark, sf_dir), root)
    routed = ingest.route_feed(scan_feed(spark, FeedSource("source_b", (root,))), RUN_1, AS_OF)
    damaged = F.startswith("posted_at_text", F.lit("damaged record: "))
    text_of = {"transaction_id": "raw_transaction_id", **{c: f"{c}_text" for c in ("posted_at", "amount", "updated_at")}}
    record = F.concat_ws(",", *[text_of.get(name, name) for name in FEED_FIELDS])
    return (
        routed.where("route = 'quarantine'")
        .groupBy("source_name", "quarantine_reason")
        .agg(
            F.count(F.lit(1)).alias("pieces"),
            F.sum(F.when(damaged, F.octet_length("posted_at_text") - 16).otherwise(F.octet_length(record))).alias("bytes"),
        )
    )


def _land(spark: SparkSession, rows: DataFrame, root: str, mode: str = "error") -> None:
    """Land feed lines by source and posting year."""
    year = F.substr("posted_at", F.lit(1), F.lit(4))
    (
        rows.select("source_name", F.concat_ws("|", *FEED_FIELDS).alias("value"), year.alias("year"))
        .withColumn("delivery_year", F.expr("if(year = '', 'undated', year)"))
        .drop("year")
        .hint("rebalance", "source_name", "delivery_year")
        .write.mode(mode)
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("source_name", "delivery_year")
        .text(root)
    )


def _delivery() -> list[Column]:
    return [F.regexp_extract("path", f"{name}=([^/]*)/", 1).alias(name) for name in ("source_name", "delivery_year")]


@_register
def landing_objects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land the feed's lines by source and posting year, then list the landing zone: the bytes of each delivery."""
    root = scratch_dir(spark, "landing")
    _land(spark, derived.transaction_feed(spark, sf_dir), root)
    objects = landing_manifest(spark, root)
    return (
        objects.groupBy(*_delivery())
        .agg(F.sum("length").alias("bytes"))
        .select("source_name", "delivery_year", "bytes")
    )


@_register
def landing_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two listings around a second delivery, which replaces 1996 by its odd transactions and adds a marker: what differs."""
    root, kept = scratch_dir(spark, "landing"), scratch_dir(spark, "listings")
    feed = derived.transaction_feed(spark, sf_dir)
    _land(spark, feed, root)
    before = whole_listing(spark, root, f"{kept}/before")
    odd = F.substr("transaction_id", F.lit(2)).cast("long") % 2 == 1
    _land(spark, feed.where(odd & F.startswith("posted_at", F.lit("1996"))), root, "overwrite")
    store.create_text(spark, f"{root}/_source_name=marker/delivery_year=1996/.delivered", "done")
    changes = listing_changes(before, whole_listing(spark, root, f"{kept}/after"))
    feeds = changes.where(~F.endswith("path", F.lit(".crc")) & ~F.endswith("path", F.lit("_SUCCESS")))
    return feeds.groupBy("change", *_delivery()).agg(F.sum(F.coalesce("new_length", "old_length")).alias("bytes"))


# Ingest -----------------------------------------------------------------------------------------------


@_register
def feed_line_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    hashed = ingest.add_line_hash(derived.transaction_feed(spark, sf_dir))
    return hashed.select("source_name", "transaction_id", "raw_line_hash")


@_register
def feed_dedup_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _distinct_rows(spark, sf_dir)


@_register
def feed_typed_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.parse_fields(_distinct_rows(spark, sf_dir)).select(
        "raw_line_hash",
        "posted_ts",
        "amount_value",
        "updated_ts",
        "posted_failed",
        "amount_failed",
        "updated_failed",
    )


@_register
def feed_quarantine_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _routed(spark, sf_dir).select(
        "source_name", "raw_transaction_id", "raw_line_hash", "route", "quarantine_reason"
    )


@_register
def bronze_accepted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _bronze(spark, sf_dir)


@_register
def quarantine_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _quarantine(spark, sf_dir)


@_register
def run_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ingest.run_counters(_routed(spark, sf_dir))


@_register
def feed_replay_antijoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, second = _redelivery(spark, sf_dir)
    return second.select("source_name", "raw_transaction_id", "raw_line_hash", "route", "quarantine_reason")


@_register
def drift_quarantine_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second source renames its amount column; its rows are quarantined, the first source is not."""
    drifted = derived.events_feed(spark, sf_dir).withColumnRenamed("amount", "transaction_amount")
    feed = derived.orders_feed(spark, sf_dir).unionByName(by_header_name(drifted, "source_b"))
    rejected = ingest.rejected_rows(ingest.route_feed(feed, RUN_1, AS_OF))
    return report.quarantine_breakdown(rejected, "source_b")


# Silver, gold, notes ----------------------------------------------------------------------------------


@_register
def silver_standardize(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conform.standardize(_bronze(spark, sf_dir))


@_register
def silver_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _silver(spark, sf_dir)


@_register
def gold_daily_account_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.gold_daily_account_summary(_silver(spark, sf_dir), AS_OF)


@_register
def ai_ready_notes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.financial_notes(_silver(spark, sf_dir))


@_register
def ai_ready_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "notes-csv")
    export_notes_csv(publish.financial_notes(_silver(spark, sf_dir)), path)
    return spark.read.schema(NOTES).option("header", True).option("escape", '"').csv(path)


@_register
def staging_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    publish.register_staging_view(_silver(spark, sf_dir))
    return spark.table("stg_silver_transactions")


@_register
def mart_daily_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return publish.mart_daily_summary(publish.staging_model(_silver(spark, sf_dir)))


@_register
def backfill_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A second load brings rows for past dates: which dates, and how many rows of it are current."""
    feed = derived.transaction_feed(spark, sf_dir)
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse"), GRAIN)
    refresh.load_feed(warehouse, derived.first_delivery(feed), RUN_1, AS_OF)
    refresh.load_feed(warehouse, feed, RUN_2, AS_OF)
    return report.backfill_by_date(conform.silver(warehouse.bronze(), AS_OF), RUN_2)


@_register
def silver_incremental_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_load_warehouse(spark, sf_dir).silver()


@_register
def gold_incremental_publish(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _two_load_warehouse(spark, sf_dir, publish_too=True).gold()


@_register
def notes_export_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV export after both deliveries, of which the second one rewrites its months only; read by its manifest."""
    warehouse = _two_load_warehouse(spark, sf_dir, publish_too=True, export_too=True)
    return spark.read.schema(NOTES).option("header", True).option("escape", '"').csv(warehouse.exported_files())


@_register
def stored_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the manifest says of the loads after small files were merged, held against what the merged files hold."""
    warehouse = _two_load_warehouse(spark, sf_dir, publish_too=True)
    warehouse.compact()
    place = ["route", "source_name", "posted_period"]
    said = warehouse.files(LOADS).groupBy(*place).agg(
        F.sum("row_count").alias("row_count"), F.min("least").alias("least"), F.max("greatest").alias("greatest")
    )
    rows = warehouse.routed().groupBy(*place).agg(F.count(F.lit(1)).alias("rows_read"))
    same = reduce(Column.__and__, [said[c].eqNullSafe(rows[c]) for c in place])
    return said.join(rows, same).select(*[said[c] for c in place], "row_count", "least", "greatest", "rows_read")


@_register
def silver_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of posting times from stored silver: only the years that overlap it are read."""
    warehouse = Warehouse(spark, scratch_dir(spark, "warehouse"), GRAIN)
    silver = warehouse.replace_layer("silver_transactions", _silver(spark, sf_dir))
    warehouse.put_in_force(warehouse.version(), [silver])
    return warehouse.silver_between(*RANGE)


# Quality ----------------------------------------------------------------------------------------------


@_register
def quality_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks on silver, and on rows that are not reduced to latest versions, at an earlier clock."""
    on_silver = quality.quality_checks(_silver(spark, sf_dir), AS_OF)
    versions = conform.standardize(_bronze(spark, sf_dir))
    on_versions = quality.quality_checks(versions, EARLIER)
    return on_silver.withColumn("dataset", F.lit("silver")).unionByName(
        on_versions.withColumn("dataset", F.lit("versions"))
    )


@_register
def quality_checks_from_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The checks of all silver periods after both deliveries, from the counts stored with them, at two clocks."""
    warehouse = _two_load_warehouse(spark, sf_dir)
    states = warehouse.check_states()
    found = []
    for name, moment in [("later", LATER), ("earlier", EARLIER)]:
        late = warehouse.silver(quality.late_periods(states, moment))
        found.append(quality.checks_from_states(states, late, moment).withColumn("dataset", F.lit(name)))
    return found[0].unionByName(found[1])


@_register
def freshness_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.freshness_lag(_silver(spark, sf_dir), AS_OF)


def _models(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The staged model and the mart; silver is made once and stored, as both read it."""
    staged = publish.staging_model(_stored(spark, _silver(spark, sf_dir), "silver"))
    return staged, publish.mart_daily_summary(staged)


@_register
def rule_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, mart = _models(spark, sf_dir)
    parsed = ingest.parse_fields(_distinct_rows(spark, sf_dir))
    return reduce(
        DataFrame.unionByName,
        [
            quality.rule_not_null(
                "stg_silver_transactions", staged, ["natural_key", "account_id", "currency", "amount"]
            ),
            quality.rule_not_null("fct_daily_account_summary", mart, ["run_date", "account_id", "total_amount"]),
            quality.rule_not_null("parsed_feed", parsed, ["posted_ts", "amount_value", "updated_ts"]),
        ],
    )


@_register
def rule_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, _ = _models(spark, sf_dir)
    return quality.rule_unique("stg_silver_transactions", staged, "natural_key").unionByName(
        quality.rule_unique("bronze_transactions", _bronze(spark, sf_dir), "raw_transaction_id")
    )


@_register
def rule_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    staged, _ = _models(spark, sf_dir)
    accepted = {"currency": ["USD"]}
    return quality.rule_accepted_values("stg_silver_transactions", staged, accepted).unionByName(
        quality.rule_accepted_values("bronze_transactions", _bronze(spark, sf_dir), accepted)
    )


@_register
def published_model_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.published_model_rules(*_models(spark, sf_dir))


# Runs and reports -------------------------------------------------------------------------------------


@_register
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.latest_run(derived.daily_run_audit(spark, sf_dir))


@_register
def run_stats_7d(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.run_stats_7d(derived.daily_run_audit(spark, sf_dir), REPORT_TIME)


@_register
def quarantine_breakdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.quarantine_breakdown(_quarantine(spark, sf_dir))


@_register
def quarantine_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.quarantine_top(_quarantine(spark, sf_dir))


@_register
def run_health_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.health_report(
        derived.daily_run_audit(spark, sf_dir), _quarantine(spark, sf_dir), REPORT_TIME
    )


@_register
def run_health_report_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "report")
    made = run_health_report(spark, sf_dir)
    write_report_csv(made, path)
    return spark.read.schema(made.schema).option("header", True).csv(path)


@_register
def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of stored layers: the feed is routed once, and each layer is made once."""
    routed = _stored(spark, _routed(spark, sf_dir), "routed")
    silver = _stored(spark, conform.silver(ingest.accepted_rows(routed), AS_OF), "silver")
    return report.layer_counts(
        silver=silver,
        gold=publish.gold_daily_account_summary(silver, AS_OF),
        quarantine=ingest.rejected_rows(routed),
    )


@_register
def run_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One whole run over the feed; its audit row, with whether the measured end is after the start."""
    base = scratch_dir(spark, "warehouse")
    feed = derived.transaction_feed(spark, sf_dir)
    run_daily(spark, feed, base, run_id=RUN_1, as_of=AS_OF, grain=GRAIN)
    runs = Warehouse(spark, base, GRAIN).runs()
    return runs.withColumn("ends_after_start", F.col("end_ts") > F.col("start_ts")).drop("end_ts")


@_register
def failed_gate_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A good run over the first source, then a run over the second one, which has lost its currency column.

    The second run lands its rows and replaces silver, but fails the checks: its audit row says so, and gold is what
    the first run published.
    """
    base = scratch_dir(spark, "warehouse")
    run_daily(spark, derived.orders_feed(spark, sf_dir), base, run_id=RUN_1, as_of=EARLIER, grain=GRAIN)
    no_currency = by_header_name(derived.events_feed(spark, sf_dir).drop("currency"), "source_b")
    try:
        run_daily(spark, no_currency, base, run_id=RUN_2, as_of=AS_OF, grain=GRAIN)
    except RunFailed:
        pass
    warehouse = Warehouse(spark, base, GRAIN)
    gold = warehouse.gold().agg(
        F.count(F.lit(1)).alias("gold_rows"),
        F.sum("transaction_count").alias("gold_transactions"),
        F.max("last_refresh_ts").alias("gold_refreshed_at"),
    )
    facts = [gold.select(name).scalar().alias(name) for name in gold.columns]
    return warehouse.runs().drop("end_ts").select("*", *facts)


@_register
def silver_absent_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds without their id, description and status columns, through the natural key, silver and the notes.

    Rows without a description have a key without an id, the default status, and no sentence.
    """
    lost = derived.orders_feed(spark, sf_dir).drop("transaction_id", "status", "updated_at")
    mute = derived.events_feed(spark, sf_dir).drop("description")
    feed = by_header_name(lost, "source_a").unionByName(by_header_name(mute, "source_b"))
    silver = conform.silver(ingest.accepted_rows(ingest.route_feed(feed, RUN_1, AS_OF)), AS_OF)
    notes = publish.financial_notes(silver).select("natural_key", "semantic_text")
    return silver.select(
        "natural_key", "raw_transaction_id", "account_id", "amount", "description", "updated_at", "status"
    ).join(notes, "natural_key", "left")


@_register
def metrics_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metrics line per source, read back."""
    path = scratch_dir(spark, "metrics")
    for row in ingest.run_counters(_routed(spark, sf_dir)).collect():
        payload = {
            "run_id": f"{RUN_1}/{row.source_name}",
            "status": "success",
            "records_ingested": row.ingested,
            "records_silver": None,
            "records_quarantine": row.quarantined,
            "freshness_lag_minutes": None,
        }
        append_metrics(spark, path, payload, AS_OF)
    return spark.read.schema(METRICS).json(path)


@_register
def promoted_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promote silver and gold, then count what arrived; the reported counts must agree with it."""
    root = scratch_dir(spark, "external")
    silver = _stored(spark, _silver(spark, sf_dir), "silver")
    tables = {
        "silver_transactions": silver,
        "gold_daily_account_summary": publish.gold_daily_account_summary(silver, AS_OF),
    }
    written = promote_tables(tables, "parquet", lambda target: {"path": f"{root}/{target}"})
    arrived = report.layer_counts(**{target: spark.read.parquet(f"{root}/{target}") for target in written})
    reported = F.element_at(
        F.create_map(*[part for pair in written.items() for part in map(F.lit, pair)]), F.col("layer")
    )
    return arrived.select(
        F.col("layer").alias("target_table"), reported.cast("long").alias("rows_reported"), "row_count"
    )
