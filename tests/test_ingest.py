from __future__ import annotations

import hashlib
import io
from contextlib import redirect_stdout
from datetime import datetime

import pytest
from conftest import AS_OF, line, rows_of, write_csv
from pyspark.sql import functions as F

from ledgersieve.operators import ingest, report
from ledgersieve.schemas import BRONZE, FEED_FIELDS, QUARANTINE
from ledgersieve.sources.csv_feeds import FeedSource, by_header_name, feed_sources, scan_feed, union_feeds
from ledgersieve.sources.object_store import landing_manifest, object_store_sources, object_uri


def reasons(df, as_of=AS_OF):
    routed = ingest.route_feed(df, "run-1", as_of)
    return {row.raw_transaction_id: row.quarantine_reason for row in routed.collect()}


def plan_of(df):
    out = io.StringIO()
    with redirect_stdout(out):
        df.explain()
    return out.getvalue()


def test_hash_covers_source_and_fields_in_order(feed):
    row = line()
    found = ingest.add_line_hash(feed(row)).first().raw_line_hash
    assert found == hashlib.sha256("|".join(["source_a", *row]).encode()).hexdigest()


def test_absent_field_hashes_as_empty(spark, feed):
    absent = feed(line(amount="")).withColumn("amount", F.lit(None).cast("string"))
    blank = feed(line(amount=""))
    hashes = [ingest.add_line_hash(df).first().raw_line_hash for df in (absent, blank)]
    assert hashes[0] == hashes[1]


def test_first_reason_in_order_wins(feed):
    found = reasons(
        feed(
            line("ok"),
            line("bad amount and no account", account_id="", amount="abc"),
            line("bad update only", updated_at="yesterday"),
            line("no account, no amount", account_id="", amount=""),
            line("no amount, no time", amount="", posted_at=""),
            line("no time", posted_at=""),
            line("future", posted_at="2026-05-25T23:28:46.000001"),
            line("exactly one day ahead", posted_at="2026-05-25T23:28:46"),
            line("no update", updated_at=""),
            line("zone", posted_at="2026-05-20T08:00:00Z"),
            line("zone, no account", posted_at="2026-05-20T08:00:00+02:00", account_id=""),
            line("zone in update", updated_at="2026-05-20T08:00:00+02:00"),
            line("nan", amount="nan"),
        )
    )
    assert found == {
        "ok": None,
        "bad amount and no account": "parsing_error",
        "bad update only": "parsing_error",
        "no account, no amount": "missing_account_id",
        "no amount, no time": "missing_amount",
        "no time": "missing_posted_at",
        "future": "future_posted_at",
        "exactly one day ahead": None,
        "no update": None,
        "zone": "parsing_error",
        "zone, no account": "missing_account_id",
        "zone in update": None,
        "nan": None,
    }


def test_future_depends_on_the_clock(feed):
    row = line("B6", posted_at="2026-06-01T10:00:00")
    assert reasons(feed(row), datetime(2026, 5, 31, 9, 59, 59)) == {"B6": "future_posted_at"}
    assert reasons(feed(row), datetime(2026, 5, 31, 10)) == {"B6": None}


def test_routes_keep_typed_values_or_raw_text(feed):
    routed = ingest.route_feed(feed(line("good"), line("bad", amount=" x ")), "run-1", AS_OF)
    good, bad = ingest.accepted_rows(routed), ingest.rejected_rows(routed)
    assert good.columns == BRONZE.fieldNames() and bad.columns == QUARANTINE.fieldNames()
    good_row, bad_row = good.first(), bad.first()
    assert (good_row.amount, good_row.posted_at) == (10.0, datetime(2026, 5, 20, 8))
    assert (good_row.load_run_id, good_row.ingested_at) == ("run-1", AS_OF)
    assert (bad_row.amount_text, bad_row.posted_at_text) == (" x ", "2026-05-20T08:00:00")
    assert (bad_row.quarantine_reason, bad_row.quarantined_at) == ("parsing_error", AS_OF)


def test_copies_count_once_per_source(feed):
    rows = [line("X")] * 5 + [line("Y", amount="abc")] * 3
    both = feed(*rows).unionByName(feed(*rows, source="source_b"))
    counters = ingest.run_counters(ingest.route_feed(both, "run-1", AS_OF))
    assert rows_of(counters) == [("source_a", 1, 1), ("source_b", 1, 1)]


def test_rows_that_share_a_hash_count_once_and_repeatably(feed):
    """A separator inside a field is not escaped, so these two have the same hash."""
    pair = [line("T|1", "ACC"), line("T", "1|ACC")]
    kept = {
        ingest.drop_exact_copies(ingest.add_line_hash(feed(*order))).first().transaction_id
        for order in (pair, pair[::-1])
    }
    assert len(kept) == 1


def test_replayed_rows_are_skipped_but_quarantined_ones_come_back(feed):
    first = ingest.route_feed(feed(line("1"), line("2", amount="abc")), "run-1", AS_OF)
    again = ingest.route_feed(feed(line("1"), line("2", amount="abc"), line("3")), "run-2", AS_OF)
    net_new = ingest.skip_replayed(again, ingest.accepted_rows(first))
    assert rows_of(net_new, "raw_transaction_id", "route") == [("2", "quarantine"), ("3", "bronze")]


def test_replay_is_per_source(feed):
    first = ingest.route_feed(feed(line("1")), "run-1", AS_OF)
    other = ingest.route_feed(feed(line("1"), source="source_b"), "run-2", AS_OF)
    assert ingest.skip_replayed(other, ingest.accepted_rows(first)).count() == 1


def test_copies_are_limited_before_the_only_shuffle_of_the_feed(spark, feed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        seen = spark.createDataFrame([("h", "s")], "raw_line_hash string, source_name string")
        plan = plan_of(ingest.skip_replayed(ingest.route_feed(feed(line()), "run-1", AS_OF), seen))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    feed_side = plan[: plan.index("Scan ExistingRDD")]
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert feed_side.count("Exchange") == 1
    assert feed_side.index("Final") < feed_side.index("Exchange") < feed_side.index("Partial")


def test_route_filter_does_not_repeat_the_parsing(feed):
    plan = plan_of(ingest.accepted_rows(ingest.route_feed(feed(line()), "run-1", AS_OF)))
    assert plan.count("try_cast(amount") == plan_of(ingest.route_feed(feed(line()), "r", AS_OF)).count(
        "try_cast(amount"
    )
    assert "PythonUDF" not in plan and "BatchEvalPython" not in plan


# CSV scans --------------------------------------------------------------------------------------------


def test_columns_are_found_by_name_and_others_left_out(spark, tmp_path):
    header = ["note", *reversed(FEED_FIELDS)]
    path = write_csv(tmp_path / "f.csv", [("extra", *reversed(line("T9")))], header)
    scanned = scan_feed(spark, FeedSource("s", path))
    assert scanned.columns == ["source_name", *FEED_FIELDS]
    assert tuple(scanned.first()) == ("s", *line("T9"))


def test_blank_is_text_but_absent_is_null(spark, tmp_path):
    header = [name for name in FEED_FIELDS if name != "status"]
    text = ",".join(header) + "\nT1,,,1,USD, spaced ,\n\nT2,\"\",,2,USD,\"a, \"\"b\"\"\",\nT3\n"
    (tmp_path / "f.csv").write_text(text)
    found = rows_of(scan_feed(spark, FeedSource("s", str(tmp_path / "f.csv"))))
    assert found == [
        ("s", "T1", "", "", "1", "USD", " spaced ", "", None),
        ("s", "T2", "", "", "2", "USD", 'a, "b"', "", None),
        ("s", "T3", "", "damaged record: T3", "", "", "", "", None),
    ]


def test_line_break_in_quotes_needs_the_source_option(spark, tmp_path):
    path = write_csv(tmp_path / "f.csv", [line("T1", description="two\nlines")])
    assert scan_feed(spark, FeedSource("s", path, multiline=True)).first().description == "two\nlines"


def test_damaged_records_are_never_accepted(spark, tmp_path):
    """A deletion with a line break read line by line, and a last line cut off inside the amount."""
    path = tmp_path / "f.csv"
    write_csv(path, [line("T1", description="two\nlines", status="Deleted"), line("T2")])
    path.write_text(path.read_text() + "T3,ACC-1,2026-05-20T09:00:00,123")
    routed = ingest.route_feed(scan_feed(spark, FeedSource("s", str(path))), "run-1", AS_OF)
    assert rows_of(ingest.accepted_rows(routed), "raw_transaction_id") == [("T2",)]
    rejected = ingest.rejected_rows(routed).collect()
    assert {r.quarantine_reason for r in rejected} == {"parsing_error"}
    assert "damaged record: T3,ACC-1,2026-05-20T09:00:00,123" in {r.posted_at_text for r in rejected}


def test_renamed_column_quarantines_as_missing_amount(spark, tmp_path):
    header = [name if name != "amount" else "transaction_amount" for name in FEED_FIELDS]
    path = write_csv(tmp_path / "f.csv", [line("D1"), line("D2")], header)
    rejected = ingest.rejected_rows(
        ingest.route_feed(scan_feed(spark, FeedSource("scenario_source", path)), "run-1", AS_OF)
    )
    assert rows_of(report.quarantine_breakdown(rejected, "scenario_source")) == [("missing_amount", 2)]
    assert rejected.first().amount_text is None
    assert rows_of(report.quarantine_breakdown(rejected, "source_a")) == []


def test_header_name_match_is_exact(spark):
    raw = spark.createDataFrame([("T1", "5")], "transaction_id string, Amount string")
    assert by_header_name(raw, "s").first().amount is None


def test_files_with_other_headers_are_separate_paths(spark, tmp_path):
    one = write_csv(tmp_path / "one.csv", [line("T1")])
    two = write_csv(tmp_path / "two.csv", [tuple(reversed(line("T2")))], list(reversed(FEED_FIELDS)))
    found = scan_feed(spark, FeedSource("s", (one, two)))
    assert rows_of(found) == [("s", *line("T1")), ("s", *line("T2"))]


def test_other_header_under_the_same_path_fails_instead_of_shifting_columns(spark, tmp_path):
    folder = tmp_path / "feed"
    folder.mkdir()
    write_csv(folder / "a.csv", [line("T1")])
    write_csv(folder / "b.csv", [tuple(reversed(line("T2")))], list(reversed(FEED_FIELDS)))
    with pytest.raises(Exception, match="(?i)header"):
        scan_feed(spark, FeedSource("s", str(folder))).collect()


def test_sources_are_tagged_and_unioned(spark, sources):
    found = union_feeds(spark, feed_sources(sources)).groupBy("source_name").count()
    assert rows_of(found) == [("source_a", 5), ("source_b", 7)]


def test_object_names():
    assert object_uri("b", "feeds/daily/", "x.csv") == "s3a://b/feeds/daily/x.csv"
    assert object_uri("b", "feeds", "x.csv") == "s3a://b/feeds/x.csv"
    assert object_uri("b", "", "x.csv") == "s3a://b/x.csv"


def test_object_store_sources(spark, tmp_path):
    (tmp_path / "daily").mkdir()
    write_csv(tmp_path / "daily" / "a.csv", [line("T1")])
    names = {"source_a": "a.csv", "source_b": "b.csv"}
    planned = object_store_sources(spark, str(tmp_path), "daily/", names, dry_run=True, scheme="file")
    assert [s.paths for s in planned] == [
        (f"file://{tmp_path}/daily/a.csv",),
        (f"file://{tmp_path}/daily/b.csv",),
    ]
    with pytest.raises(FileNotFoundError, match="b.csv"):
        object_store_sources(spark, str(tmp_path), "daily/", names, scheme="file")
    found = object_store_sources(spark, str(tmp_path), "daily", {"source_a": "a.csv"}, scheme="file")
    assert union_feeds(spark, found).count() == 1
    with pytest.raises(ValueError, match="bucket"):
        object_store_sources(spark, "", "daily", names)


def test_landing_manifest_lists_nested_objects_without_reading_them(spark, tmp_path):
    (tmp_path / "x" / "y").mkdir(parents=True)
    (tmp_path / "x" / "one.csv").write_text("12345")
    (tmp_path / "x" / "y" / "two.csv").write_text("1")
    found = landing_manifest(spark, str(tmp_path))
    assert sorted((row.path.rsplit("/", 1)[1], row.length) for row in found.collect()) == [
        ("one.csv", 5),
        ("two.csv", 1),
    ]
    assert "content" not in plan_of(found)
