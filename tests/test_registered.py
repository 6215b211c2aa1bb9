"""Every registered query gives the rows of its SQL, from the same tables."""

from __future__ import annotations

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from ledgersieve.plans.duck_sql import ORACLE_SQL as SQL
from ledgersieve.plans.registered import REGISTERED as QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"create view {table.stem} as select * from '{table}'")
    return con


def comparable(rows):
    def cell(value):
        return f"{value:.9g}" if isinstance(value, float) else str(value)

    return sorted(tuple(cell(v) for v in row) for row in rows)


def test_every_query_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    found = QUERIES[name](spark, SF_DIR)
    columns = sorted(found.columns)
    wanted = duck.execute(SQL[name])
    assert sorted(c[0] for c in wanted.description) == columns
    rows = duck.execute(f"select {', '.join(columns)} from ({SQL[name]})").fetchall()
    assert len(rows) > 0
    assert comparable(found.select(columns).collect()) == comparable(rows)


def test_entry(spark):
    found = entry.entry(spark)
    assert found.columns == [
        "run_date",
        "account_id",
        "currency",
        "total_amount",
        "transaction_count",
        "last_refresh_ts",
    ]
    assert found.count() == 1794


def test_known_counts(spark):
    """Counts worked out beforehand for these tables."""
    found = {r.source_name: (r.ingested, r.quarantined) for r in QUERIES["run_counters"](spark, SF_DIR).collect()}
    assert found == {"source_a": (1443, 57), "source_b": (1036, 64)}
    assert QUERIES["silver_latest"](spark, SF_DIR).count() == 2332
