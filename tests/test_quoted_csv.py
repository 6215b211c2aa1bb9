"""Parallel reading of quoted CSV against the reading in one task."""

from __future__ import annotations

import csv
import random

import pytest
from conftest import rows_of

from ledgersieve.schemas import FEED_FIELDS
from ledgersieve.sources import quoted_csv
from ledgersieve.sources.csv_feeds import FeedSource, scan_feed


@pytest.fixture
def small_ranges(spark):
    """Byte ranges of 300 bytes, so that records and quotes span many of them."""
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield
    for key, value in before.items():
        spark.conf.set(key, value)


def write(path, rng, rows, blank=True, header=(*FEED_FIELDS, "note")):
    values = ["", "plain", "a,b", 'say "hi"', "two\nlines", '"', "\n\n", 'x"\ny', "é😀", " sp ", "z" * 700, 'l1\nl2\n"q",\nl4', "\n" * 400]
    with open(path, "w", newline="") as file:
        out = csv.writer(file, lineterminator="\n")
        out.writerow(header)
        for i in range(rows):
            out.writerow([f"{path.name}-{i}"] + [rng.choice(values) for _ in range(len(header) - 1)])
            if blank and rng.random() < 0.1:
                file.write("\n")


def test_many_tasks_read_what_one_task_reads(spark, tmp_path, small_ranges):
    rng = random.Random(5)
    for k in range(3):
        write(tmp_path / f"f{k}.csv", rng, 40 if k else 0)
    with open(tmp_path / "f2.csv", "a") as file:
        file.write("cut,off\n" + 'x,"left open\nto the end,')
    one = scan_feed(spark, FeedSource("s", (str(tmp_path),), multiline=True))
    many = scan_feed(spark, FeedSource("s", (str(tmp_path),), multiline=True, strict_quotes=True))
    assert quoted_csv._lines(spark, str(tmp_path)).rdd.getNumPartitions() > 50
    found, wanted = rows_of(many), rows_of(one)
    damaged = [r for r in wanted if r[3].startswith("damaged record: ")]
    assert len(damaged) == 2
    assert [r for r in found if r not in damaged] == [r for r in wanted if r not in damaged]
    assert len(found) == len(wanted) == 82 and sum(r[3].startswith("damaged record: ") for r in found) == 2


def test_a_record_that_fills_many_ranges(spark, tmp_path, small_ranges):
    long = 'a "quoted" word,\n' * 300
    with open(tmp_path / "f.csv", "w", newline="") as file:
        csv.writer(file, lineterminator="\r\n").writerows([["transaction_id", "description"], ["1", "x"], ["2", long], ["3", "y\nz"]])
    feed = scan_feed(spark, FeedSource("s", (str(tmp_path / "f.csv"),), multiline=True, strict_quotes=True))
    assert rows_of(feed, "transaction_id", "description") == [("1", "x"), ("2", long), ("3", "y\nz")]


def test_files_with_another_header_fail(spark, tmp_path):
    rng = random.Random(1)
    write(tmp_path / "a.csv", rng, 3)
    write(tmp_path / "b.csv", rng, 3, header=["note", *FEED_FIELDS])
    with pytest.raises(Exception, match="header differs"):
        scan_feed(spark, FeedSource("s", (str(tmp_path),), multiline=True, strict_quotes=True)).collect()
