"""Listings of a landing zone with all names, and what differs between two of them."""

from __future__ import annotations

import os
from pathlib import Path

from conftest import rows_of

from ledgersieve.sources import object_store


def test_listing_has_names_that_sparks_leaves_out(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(object_store, "PAGE", 3)
    root = tmp_path / "zone"
    names = ["a.csv", "_b.csv", ".c.csv", "_late/d.csv", "x/.y/e é.csv", "x/f+g%20.csv", "z/empty"]
    for i, name in enumerate(names):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("x" * i)
    found = object_store.whole_listing(spark, str(root), str(tmp_path / "listing"))
    assert sorted((r.path.split("/zone/")[1], r.length) for r in found.collect()) == sorted((n, i) for i, n in enumerate(names))
    times = {r.path.split("/zone/")[1]: r.t for r in found.selectExpr("path", "unix_millis(modificationTime) t").collect()}
    assert all(times[n] == int(os.stat(root / n).st_mtime_ns // 10**6) for n in names)


def test_no_object_at_all(spark, tmp_path):
    (tmp_path / "zone").mkdir()
    assert object_store.whole_listing(spark, str(tmp_path / "zone"), str(tmp_path / "listing")).count() == 0


def test_changes_between_two_listings(spark, tmp_path):
    root = tmp_path / "zone"
    root.mkdir()
    for name in ("same", "grown", "touched", "gone", "_hidden"):
        (root / name).write_text(name)
    before = object_store.whole_listing(spark, str(root), str(tmp_path / "before"))
    (root / "grown").write_text("grown more")
    os.utime(root / "touched", (1, 1))
    (root / "gone").unlink()
    (root / ".new").write_text("n")
    after = object_store.whole_listing(spark, str(root), str(tmp_path / "after"))
    found = object_store.listing_changes(before, after)
    assert [(Path(p).name, *rest) for p, *rest in rows_of(found)] == [
        (".new", "new", None, 1),
        ("gone", "gone", 4, None),
        ("grown", "changed", 5, 10),
        ("touched", "changed", 7, 7),
    ]
    assert object_store.listing_changes(after, after).count() == 0
