from __future__ import annotations

import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from ledgersieve.schemas import FEED_FIELDS  # noqa: E402
from ledgersieve.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        master="local[4]",
        shuffle_partitions=2,
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.driver.bindAddress": "127.0.0.1",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


AS_OF = datetime(2026, 5, 24, 23, 28, 46)


def line(
    transaction_id="T1",
    account_id="ACC-1",
    posted_at="2026-05-20T08:00:00",
    amount="10.00",
    currency="USD",
    description="card payment",
    updated_at="2026-05-20T08:05:00",
    status="posted",
):
    """One feed row as a tuple in header order."""
    return (transaction_id, account_id, posted_at, amount, currency, description, updated_at, status)


@pytest.fixture
def feed(spark):
    """Make a feed DataFrame from feed rows."""

    def make(*rows, source="source_a"):
        schema = ", ".join(f"{name} string" for name in ["source_name", *FEED_FIELDS])
        return spark.createDataFrame([(source, *row) for row in rows], schema)

    return make


def write_csv(path, rows, header=FEED_FIELDS):
    def cell(value):
        return '"' + value.replace('"', '""') + '"' if set(value) & set(',"\n') else value

    lines = [",".join(header)] + [",".join(cell(v) for v in row) for row in rows]
    Path(path).write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


# Two small feeds with every kind of bad row: an exact copy, a missing account, a late update, an amount that
# does not parse, a posting in the future. The dates, accounts and amounts, from which the recorded run's
# daily totals follow, the newest posting (2026-05-23 11:11), which gives its lag, and the future posting.
FEED_A = [
    line("A1", "ACC-001", "2026-05-20T06:41:00", "1250.40", updated_at="2026-05-20T07:02:30"),
    line("A2", "ACC-001", "2026-05-20T12:08:00", "-45.99", updated_at="2026-05-20T12:31:10"),
    line("A3", "ACC-002", "2026-05-21T05:27:00", "8999.99", updated_at="2026-05-21T06:00:45"),
    line("A4", "ACC-003", "2026-05-22T18:03:00", "320.00", updated_at="2026-05-22T18:44:20"),
    line("A5", "ACC-004", "2026-05-23T11:11:00", "2100.00", updated_at="2026-05-23T12:39:00"),
]
FEED_B = [
    line("B1", "ACC-002", "2026-05-20T15:19:00", "505.15", updated_at="2026-05-20T15:58:00"),
    line("B1", "ACC-002", "2026-05-20T15:19:00", "505.15", updated_at="2026-05-20T15:58:00"),
    line("B2", "ACC-005", "2026-05-21T13:52:00", "1275.00", updated_at="2026-05-21T14:10:00"),
    line("B3", "", "2026-05-21T16:24:00", "330.00", updated_at="2026-05-21T16:59:00"),
    line("B4", "ACC-006", "2026-05-19T10:36:00", "100.00", updated_at="2026-05-22T19:20:00"),
    line("B5", "ACC-007", "2026-05-24T01:13:00", "abc", updated_at="2026-05-24T02:48:00"),
    line("B6", "ACC-008", "2026-06-01T10:00:00", "750.00", updated_at="2026-05-24T14:30:00"),
]


@pytest.fixture
def sources(tmp_path):
    return {
        "source_a": write_csv(tmp_path / "a.csv", FEED_A),
        "source_b": write_csv(tmp_path / "b.csv", FEED_B),
    }


def rows_of(df, *columns):
    chosen = df.select(*columns) if columns else df
    return sorted((tuple(row) for row in chosen.collect()), key=lambda r: tuple(str(v) for v in r))
