"""Infill, repeated passages and the Merkle manifest against plain recomputations, with odd tables."""

from __future__ import annotations

import hashlib
import os
import random
import re
import zlib
from collections import Counter
from pathlib import Path

import duckdb
import pytest

from ledgersieve.llm import infill, merkle, suffixtrees
from ledgersieve.llm.registered import LLM_QUERIES, LLM_SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, form string, digest string, pos long"


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def made_rows():
    rng = random.Random(2)

    def some(n):
        return " ".join(rng.choice("abcdefghij") + rng.choice("kl") for _ in range(n))

    passages = [some(50) for _ in range(5)]
    texts = [
        " \n".join(
            rng.choice([some(rng.randint(0, 80)), rng.choice(passages)[: rng.randint(1, 149)]]) for _ in range(rng.randint(0, 6))
        )
        for _ in range(120)
    ]
    rows = list(enumerate(texts)) + [(4, texts[4])] * 30 + [(None, texts[7]), (None, texts[7]), (900, None), (901, "")]
    rows += [(902, " x "), (903, "a b " * 300), (904, some(34)), (905, passages[0]), (906, "é😀 " * 40), (907, "A<S>b"), (908, "<P")]
    rows += [(909, some(30_000)), (910, "x\x0b\x0cY\tz\r\nQ\xa0q"), (911, "<<P<M" * 9), (None, None)]
    sources = [None, "", "é", "s1", *["s0"] * 6]
    return [(i, t, rng.choice([None, "en"]), rng.choice(sources), rng.choice([None, 3]), "x", "y", 1) for i, t in rows]


ROWS = made_rows()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(ROWS, SCHEMA).repartition(3).write.parquet(f"{path}/documents.parquet")
    return str(path)


@pytest.fixture(scope="module")
def docs(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet")


def in_order(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("name", sorted(set(LLM_SQL) - {"op1_seekable_warc"}))
def test_sql_gives_the_same_rows(spark, name):
    if not Path(SF_DIR).is_dir():
        pytest.skip("no test tables")
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    found = LLM_QUERIES[name](spark, SF_DIR)
    wanted = con.execute(f"select {', '.join(found.columns)} from ({LLM_SQL[name]})").fetchall()
    assert len(wanted) > 0
    assert in_order(found.collect()) == in_order(wanted)


@pytest.mark.parametrize("name", ["op11_rotated_infill", "op12_suffix_tree_repeats", "op13_merkle_manifest"])
def test_no_rows(spark, folder, tmp_path, name):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert LLM_QUERIES[name](spark, str(tmp_path)).count() == 0


def plain_infill(doc_id, text):
    text = text or ""
    digest = sha("1:", "" if doc_id is None else str(doc_id))
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(text)
    if not text or any(s in text for s in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return doc_id, n, "plain", None, None, sha(text), sha(text)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = text[:low], text[low:high], text[high:]
    if h[3] % 100 < 20:
        form, output = "spm", f"<S>{suffix}<P>{prefix}<M>{middle}"
    else:
        form, output = "psm", f"<P>{prefix}<S>{suffix}<M>{middle}"
    return doc_id, n, form, low, high - low, sha(output), sha(text)


def test_infill_equals_plain_slicing(spark, folder, docs):
    rows = LLM_QUERIES["op11_rotated_infill"](spark, folder).collect()
    expected = [plain_infill(r[0], r[1]) for r in ROWS]
    assert in_order(rows) == in_order(expected)
    assert {e[2] for e in expected} == {"plain", "psm", "spm"}
    made = infill.transform(docs)
    assert set(docs.columns) <= set(made.columns)
    assert in_order(r[:2] for r in infill.restore(made).select("doc_id", "restored").collect()) == in_order(
        (r[0], r[1] or "") for r in ROWS
    )


def test_rotation_exchanges_blocks_and_back():
    for n in range(7):
        for begin in range(n + 1):
            for end in range(begin, n + 1):
                for cut in range(begin, end + 1):
                    text = bytes(range(n))
                    buffer = bytearray(text)
                    infill.rotate(buffer, begin, cut, end)
                    assert bytes(buffer) == text[:begin] + text[cut:end] + text[begin:cut] + text[end:]
                    infill.rotate(buffer, begin, begin + end - cut, end)
                    assert bytes(buffer) == text


def test_all_cuts_restore():
    text = "é<a😀P>".encode()
    starts = [*infill.code_point_starts(text).tolist(), len(text)]
    for first in starts:
        for second in starts:
            if first <= second:
                for form in ("psm", "spm"):
                    assert infill.restored(infill.rearranged(text, first, second, form == "spm"), form) == text


def plain_repeats(rows, window):
    words = [re.findall(rb"[^\x20\x09-\x0d]+", (r[1] or "").encode()) for r in rows]
    seen = Counter(tuple(w[i : i + window]) for w in words for i in range(len(w) - window + 1))
    out = []
    for r, w in zip(rows, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i : i + window])] > 1:
                gone[i : i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((r[0], len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize(("group", "run"), [(suffixtrees.GROUP, suffixtrees.RUN), (40, suffixtrees.RUN), (40, 300)])
def test_repeats_equal_brute_force(docs, monkeypatch, group, run):
    """In one group and one run, in many small groups with split prefixes, and with copies in different runs."""
    monkeypatch.setattr(suffixtrees, "RUN", run)
    cut = suffixtrees.without_repeats(docs, group=group)
    assert set(docs.columns) - {"digest"} <= set(cut.columns)
    rows = cut.select("doc_id", "n_words", "n_removed", "kept_sha256", "kept_text").collect()
    assert in_order(r[:4] for r in rows) == in_order(plain_repeats(ROWS, 35))
    assert all(r.kept_sha256 == sha(r.kept_text) for r in rows)


def test_windows_of_another_size(docs):
    cut = suffixtrees.without_repeats(docs, window=3, prefix=2, keep_text=False)
    rows = cut.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert in_order(rows) == in_order(plain_repeats(ROWS, 3))


def plain_proofs(rows):
    def field(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(r, low=False):
        text = r[1]
        if low and text is not None:
            text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        return sha(*map(field, (r[0], r[3], r[2], r[4], text)))

    def tree(level):
        paths, at = [[] for _ in level], list(range(len(level)))
        while len(level) > 1:
            for k, p in enumerate(at):
                begin = p // 16 * 16
                paths[k].append((level[begin:p], level[p + 1 : begin + 16]))
                at[k] = p // 16
            level = [sha(*level[i : i + 16]) for i in range(0, len(level), 16)]
        return level[0], paths

    by_source = {}
    for r in rows:
        by_source.setdefault(r[3], []).append(r)
    trees = []
    for source in sorted(by_source, key=lambda s: (s is not None, (s or "").encode())):
        held = sorted(by_source[source], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append((held, *tree([leaf(r) for r in held])))
    root, above = tree([top for _, top, _ in trees])
    out = []
    for (held, top, paths), up in zip(trees, above, strict=True):
        for r, own in zip(held, paths, strict=True):
            path = own + up
            changed = zlib.crc32(("" if r[0] is None else str(r[0])).encode()) % 5 == 0
            node = leaf(r, changed)
            for left, right in path:
                node = sha(*left, node, *right)
            out.append((r[0], leaf(r), top, root, sha(*[x for a, b in path for x in a + b]), node, node == root))
    return out


@pytest.mark.parametrize("levels", [1, 2, 3])
def test_manifest_equals_plain_trees(spark, folder, monkeypatch, levels):
    """Small blocks make the roots of blocks recurse several times."""
    monkeypatch.setattr(merkle, "LEVELS", levels)
    monkeypatch.setattr(merkle, "BLOCK", 16**levels)
    rows = LLM_QUERIES["op13_merkle_manifest"](spark, folder).collect()
    expected = plain_proofs(ROWS)
    assert in_order(rows) == in_order(expected)
    assert {e[-1] for e in expected} == {True, False}


def test_trees_of_one_and_seventeen_leaves(spark):
    for n in (1, 2, 16, 17):
        rows = [(i, f"T{i}", None, "s", 1) for i in range(n)]
        made = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
        got = merkle.tamper_proofs(made).collect()
        assert in_order(got) == in_order(plain_proofs(rows))
        assert merkle.manifest(made).root().first().root == got[0].root
