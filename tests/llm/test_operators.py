"""Small tests of the operators: brute force, round trips, held-out accuracy, and odd tables."""

from __future__ import annotations

import random
import re
import zlib

import corpus_pipeline
import numpy as np
import pytest

from ledgersieve.llm import (
    ann,
    components,
    decontamination,
    language,
    minhash,
    packing,
    quality,
    shared,
    sharding,
    tokenfiles,
    tokens,
    toxicity,
    warc,
)
from ledgersieve.llm.registered import LLM_QUERIES, LLM_SQL
from ledgersieve.llm.shared import new_folder

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score string, node string, rank string"
LANGUAGES = {
    "aa": "the cat sat on a warm mat and watched birds over there with great interest".split(),
    "bb": "der hund lief durch den wald und suchte nach knochen unter alten tannen".split(),
    "cc": "le chien mange une pomme rouge dans la grande maison pres du lac".split(),
}


def words(rng, lang, n):
    return " ".join(rng.choice(LANGUAGES[lang]) + rng.choice(["", "", ",", "."]) for _ in range(n))


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Tables with copies, near copies, nulls, empty and long texts, repeated rows and clashing extra columns."""
    rng = random.Random(4)
    path = tmp_path_factory.mktemp("tables")
    docs = [(i, words(rng, rng.choice("abc") * 2, rng.randint(1, 120))) for i in range(160)]
    docs += [(200 + i, docs[i][1]) for i in range(20)]
    docs += [(300 + i, docs[i][1].upper() + " extra") for i in range(20)]
    docs += [(400, None), (401, ""), (402, " \n\t"), (403, "x"), (404, "123 !!"), (405, words(rng, "aa", 9000))]
    docs += [(5, docs[5][1]), (None, "no id here"), (None, None), (406, "it's <|endoftext|> here, ... É́  x")]
    passage = words(rng, "bb", 40)
    docs += [(500, f"before {passage.upper()} after"), (501, f"{words(rng, 'aa', 30)}\n{passage}"), (502, passage[:60])]
    rows = [(i, t, None if i is None or i % 7 == 0 else "aa bb cc".split()[i % 3], "s", 0, "x", "y", "z") for i, t in docs]
    spark.createDataFrame(rows, DOCS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, i % 2, i % 5 == 0 and 1 or 0) for i in range(160)] + [(1, None, None), (None, 1, 1)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, passage), (2, "short"), (None, "x" * 90), (3, None)], "item_id long, text string").write.parquet(
        f"{path}/benchmark.parquet"
    )
    big = "<html>" + "page " * 400
    pages = [(1, "http://a/", big), (2, None, big), (3, "b\r\nc", "small"), (4, "c", "small"), (5, "d", None), (6, "e", "")]
    pages += [(2, "again", big), (None, "f", big + "x"), (None, "g", big + "x"), (7, "h", big + "é" * 9)]
    spark.createDataFrame([(*p, "v") for p in pages], "page_id long, url string, html string, salt string").write.parquet(
        f"{path}/pages.parquet"
    )
    vec = np.random.default_rng(2).normal(size=(300, 8))
    vectors = [(i, v.tolist()) for i, v in enumerate(vec)] + [(300 + i, vec[0].tolist()) for i in range(60)]
    vectors += [(400, None), (420, [0.0] * 8), (440, [float("nan")] * 8), (460, [1.0]), (None, vec[1].tolist())]
    spark.createDataFrame([(*v, 1) for v in vectors], "vec_id long, embedding array<float>, label int").write.parquet(
        f"{path}/embeddings.parquet"
    )
    return str(path)


@pytest.fixture(scope="module")
def empty(spark, folder, tmp_path_factory):
    path = tmp_path_factory.mktemp("none")
    for name in ("documents", "labels", "benchmark", "pages", "embeddings"):
        spark.read.parquet(f"{folder}/{name}.parquet").limit(0).write.parquet(f"{path}/{name}.parquet")
    return str(path)


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@pytest.mark.parametrize("name", sorted(LLM_QUERIES))
def test_empty_tables_give_no_rows(spark, empty, name):
    assert LLM_QUERIES[name](spark, empty).count() == 0


def texts_of(spark, folder):
    return [(r.doc_id, r.text or "") for r in table(spark, folder, "documents").collect()]


def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokens.vocabulary_path())


def test_word_by_word_ids_are_the_tokenizers(spark, folder):
    texts = [t for _, t in texts_of(spark, folder)] + ["a.b, c., Don't 'S ß ẞ İ. x\x1cy 12.5% 日本語。", "\ud800x"[1:]]
    ids, ends = tokens.WordEncoder(cached_words=50).encode(texts)
    got = [ids[a:b].tolist() for a, b in zip([0, *ends[:-1]], ends, strict=True)]
    assert got == [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]


def test_token_files_round_trip(spark, folder):
    rows = LLM_QUERIES["op4_ranked_token_files"](spark, folder).collect()
    expected, start = [], 0
    encoder = tokenizer()
    made = [(i, encoder.encode(t, add_special_tokens=False).ids + [1]) for i, t in texts_of(spark, folder)]
    for doc_id, ids in sorted(made, key=lambda p: (p[0] is not None, p[0] or 0, np.array(p[1], "<u2").tobytes())):
        expected.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, rows), key=lambda r: r[1]) == expected


def test_values_of_all_sizes_round_trip():
    values = np.array([0, 1, 255, 256, 65535, 65536, 2**24 - 1, 2**24, 2**32 - 1], np.uint32)
    for n in range(len(values) + 1):
        assert tokenfiles.decode_values(*tokenfiles.encode_values(values[:n]), n).tolist() == values[:n].tolist()


def test_packing(spark, folder):
    rows = LLM_QUERIES["op5_histogram_packing"](spark, folder).collect()
    encoder = tokenizer()
    expected = []
    for doc_id, text in texts_of(spark, folder):
        ids = np.array(encoder.encode(text, add_special_tokens=False).ids + [0], "<u4")
        for k in range(0, len(ids), 2048):
            piece = ids[k : k + 2048]
            expected.append((doc_id, k // 2048, k, len(piece), zlib.crc32(piece.tobytes())))
    key = lambda r: tuple(-1 if v is None else v for v in r[:5])
    assert sorted((tuple(r[:5]) for r in rows), key=key) == sorted(expected, key=key)
    by_sequence = {}
    for r in rows:
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    total = sum(r.length for r in rows)
    assert len(by_sequence) <= -(-total // 2048) + 1


def test_plan_equals_best_fit_over_documents():
    rng = random.Random(8)
    for _ in range(30):
        lengths = sorted((rng.randint(1, 40) for _ in range(rng.randint(1, 60))), reverse=True)
        rooms = []
        for n in lengths:
            fits = [r for r in rooms if r >= n]
            if fits:
                rooms.remove(min(fits))
                rooms.append(min(fits) - n)
            else:
                rooms.append(40 - n)
        counts = {n: lengths.count(n) for n in set(lengths)}
        used = {}
        for length, lo, hi, first, each, place in packing.plan(counts, 40):
            for rank in range(lo, hi):
                used.setdefault(first + (rank - lo) // each, []).append((place + (rank - lo) % each * length, length))
        assert sum(map(len, used.values())) == len(lengths)
        assert len(used) == len(rooms)
        for pieces in used.values():
            at = 0
            for offset, length in sorted(pieces):
                assert offset == at
                at += length
            assert at <= 40


def test_sequences_hold_the_ids(spark, folder):
    made = packing.sequences(table(spark, folder, "documents")).collect()
    assert all(len(r.ids) == 4 * r.length <= 8192 for r in made)


def test_warc_round_trip(spark, folder):
    pages = table(spark, folder, "pages")
    rows = LLM_QUERIES["op1_seekable_warc"](spark, folder).collect()
    assert len(rows) == pages.count()
    kinds = sorted((r.page_id, r.record_type, r.refers_to) for r in rows if r.page_id is not None)
    assert kinds == [
        (1, "revisit", 2),
        (2, "response", None),
        (2, "response", None),
        (3, "response", None),
        (4, "response", None),
        (5, "response", None),
        (6, "response", None),
        (7, "response", None),
    ]
    assert [r.record_type for r in rows if r.page_id is None] == ["response"] * 2
    place, index = warc.write_archive(pages, frame_bytes=3000, bundle_bytes=1)
    got = {r.page_id: bytes(r.record) for r in warc.fetch(place, index, pages.where("page_id in (3, 7)")).collect()}
    assert got[3].endswith(b"small\r\n\r\n")
    assert got[7].endswith("é".encode() * 9 + b"\r\n\r\n")


def test_decontamination_finds_passages_and_only_these(spark, folder):
    docs = table(spark, folder, "documents")
    found = decontamination.contaminated(docs, table(spark, folder, "benchmark")).collect()
    assert sorted((r.doc_id, r.item_id, r.edits) for r in found) == [(500, 1, 0), (501, 1, 0)]
    clean = decontamination.clean(docs, table(spark, folder, "benchmark"))
    assert clean.count() == docs.count() - 2
    assert clean.columns == docs.columns


def test_edits_within_the_budget_are_found_and_more_are_not():
    rng = random.Random(3)
    item = "".join(rng.choice("abcdefgh ") for _ in range(200)).replace("  ", " ").strip()
    index = decontamination.index([(9, item)])
    spare = decontamination.budget(len(decontamination.normal(item)))
    for edits in (1, spare, 3 * spare):
        text = list(item)
        for at in sorted(rng.sample(range(5, len(text) - 5), edits), reverse=True):
            text[at : at + 1] = rng.choice([["z"], [], [text[at], "z"]])
        got = decontamination.hits(index, "noise " * 20 + "".join(text) + " noise" * 20)
        assert bool(got) == (edits <= spare)
        assert all(hit[3] <= edits for hit in got)


def test_short_items_and_items_without_an_id_are_found(spark):
    items = [(1, "what is the capital of peru"), (2, "Who wrote  it?"), (3, "lima"), (4, "2 + 2"), (None, "q" * 70), (None, "oslo")]
    texts = [
        "so: What is the capital of Peru", "what is the capitol of peru", "they ask who wrote it? now", "in Lima.", "limas",
        "is 2 + 2 four", "is 12 + 2 less", "a " + "q" * 70, "from Oslo", "nothing here", "unwho wrote it", None, "", "what is the peru",
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    benchmark = spark.createDataFrame([*items, (3, "lima"), (5, "")], "item_id long, text string")
    found = sorted((r.doc_id, r.item_id, r.start, r.stop, r.edits) for r in decontamination.contaminated(docs, benchmark).collect())
    assert [f[:2] + f[4:] for f in found] == [(0, 1, 0), (1, 1, 1), (2, 2, 0), (3, 3, 0), (5, 4, 0)]
    assert [texts[f[0]][f[2] : f[3]].lower() for f in found[2:]] == ["who wrote it?", "lima", "2 + 2"]
    assert sorted(r.doc_id for r in decontamination.clean(docs, benchmark).collect()) == [4, 6, 9, 10, 11, 12, 13]


def test_near_duplicates_equal_brute_force(spark, folder):
    docs = table(spark, folder, "documents")
    for size in (2, 5):
        sets = {}
        for doc_id, text in texts_of(spark, folder):
            if doc_id is not None:
                w = re.findall(rb"[^\x20\x09-\x0d]+", text.encode().lower())
                sets[doc_id] = {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} or ({tuple(w)} if w else set())
        root = {i: i for i in sets}
        for a in sorted(sets):
            for b in sorted(sets):
                both = len(sets[a] & sets[b])
                if a < b and both and 100 * both >= 80 * len(sets[a] | sets[b]):
                    low, high = sorted((root[a], root[b]))
                    root = {k: low if v == high else v for k, v in root.items()}
        got = minhash.near_duplicates(docs, words=size).collect()
        assert len(got) == docs.count()
        for r in got:
            if r.doc_id is None:
                assert r.kept and r.component_id is None
            else:
                assert (r.n_shingles, r.component_id) == (len(sets[r.doc_id]), root[r.doc_id])
                assert r.kept == (r.component_id == r.doc_id)


def test_block_comparison_equals_brute_force(spark, monkeypatch):
    rng = random.Random(6)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
    rows = []
    for i in range(120):
        w = list(base)
        for at in rng.sample(range(60), rng.randint(0, 9)):
            w[at] = f"v{rng.randint(0, 10**6)}"
        rows.append((i, " ".join(w)))
    monkeypatch.setattr(minhash, "SMALL_GROUP", 0)
    monkeypatch.setattr(minhash, "BLOCK", 16)
    got = minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=2).collect()
    sets = {i: {tuple(x) for x in zip(t.split(), t.split()[1:], strict=False)} for i, t in rows}
    root = {i: i for i in sets}
    for a in sets:
        for b in sets:
            if a < b and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                low, high = sorted((root[a], root[b]))
                root = {k: low if v == high else v for k, v in root.items()}
    assert {r.doc_id: r.component_id for r in got} == root


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(20)] + [(100, i) for i in range(101, 120)] + [(7, 7)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {**dict.fromkeys(range(21), 0), **dict.fromkeys(range(100, 120), 100)}


def test_neighbours(spark, folder):
    rows = table(spark, folder, "embeddings").collect()
    usable = {r.vec_id: np.array(r.embedding, float) for r in rows if r.vec_id is not None and r.vec_id < 400}
    got = {}
    for r in LLM_QUERIES["op7_projection_forest"](spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert sorted(got) == [i for i in sorted(usable) if i % 20 == 0]
    right = 0
    for q, found in got.items():
        exact = sorted(((-(usable[q] * v).sum(), i) for i, v in usable.items() if i != q))[:20]
        assert len(found) == 20
        assert all(abs(score - (usable[q] * usable[i]).sum()) < 1e-12 for i, score in found)
        assert found == sorted(found, key=lambda p: (-p[1], p[0]))
        right += len({i for _, i in exact} & {i for i, _ in found})
    assert right >= 0.9 * 20 * len(got)


@pytest.mark.parametrize("depth", [0, 1, 4])
def test_leaves_are_visited_in_the_order_of_their_costs(depth):
    """Against the cost of every leaf, summed along its own path."""
    rng = np.random.default_rng(depth)
    rows = rng.normal(size=(400, 6)).astype(np.float32)
    forest = ann.fit(rows, 3, depth)
    for vector in rows[:5]:
        plain = []
        for t in range(3):
            for leaf in range(forest.leaves):
                node, cost = 1, 0.0
                for bit in f"{leaf:0{depth}b}" if depth else "":
                    margin = float(forest.directions[t, node] @ vector - forest.thresholds[t, node])
                    cost += -margin if bit == "1" else margin
                    node = 2 * node + int(bit)
                plain.append(cost)
        for visit in (1, 7, 3 * forest.leaves):
            found = ann.search_leaves(forest, vector, visit)
            assert len(found) == len(set(found)) == min(visit, len(plain))
            assert np.allclose([plain[x] for x in found], sorted(plain)[: len(found)], atol=1e-4)


@pytest.mark.parametrize("rows", [420, 500, 2000, 6000])
def test_recall_on_vectors_without_structure(rows):
    """The share of leaves that a query visits reaches 0.9 on the hardest input there is: random directions."""
    rng = np.random.default_rng(rows)
    vectors = rng.normal(size=(rows, 64))
    vectors = (vectors / np.linalg.norm(vectors, axis=1)[:, None]).astype(np.float32)
    forest = ann.fit(vectors, ann.TREES, ann.depth_for(rows, 20))
    at, right = ann.leaves_of(forest, vectors), 0
    visit = int(np.ceil(ann.LEAF_SHARE * ann.TREES * forest.leaves))
    for query in range(60):
        score = vectors @ vectors[query]
        score[query] = -9
        seen = np.isin(at, ann.search_leaves(forest, vectors[query], visit)).any(axis=1)
        right += seen[np.argsort(-score)[:20]].sum()
    assert right >= 0.9 * 20 * 60


def test_few_vectors_are_all_found(spark):
    rows = [(i, [float(i + 1), 1.0]) for i in range(5)]
    near = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), ann.F.col("id") == 0)
    assert [r.vec_id for r in near.orderBy("rank").collect()] == [4, 3, 2, 1]


def test_leaves_in_blocks_give_the_same_neighbours(spark, monkeypatch):
    """Half of the rows lie close together, so some leaves are far over the bound."""
    rng = np.random.default_rng(8)
    vec = np.concatenate([rng.normal(size=(200, 6)), 3 + 0.01 * rng.normal(size=(200, 6))])
    data = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vec)], "vec_id long, embedding array<double>")

    def found():
        near = ann.nearest(data, ann.F.col("id") % 20 == 0)
        return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in near.collect())

    sizes = []
    monkeypatch.setattr(ann, "depth_for", lambda rows, k: 3)
    whole, dealt = found(), ann._in_blocks

    def bounded(*sides):
        out = dealt(*sides)
        sizes.extend(r["count"] for side in out for r in side.groupBy(*ann.BLOCK).count().collect())
        return out

    monkeypatch.setattr(ann, "LEAF_ROWS", 8)
    monkeypatch.setattr(ann, "_in_blocks", bounded)
    assert len(whole) == 400 and found() == whole
    assert max(sizes) <= 24


@pytest.mark.parametrize("times", [2, 30])
def test_repeated_ids_leave_the_neighbours_whole(spark, times):
    """Query rows that repeat, alone (0) and with another id of the same vector (20, 21), and an id of many vectors (1)."""
    rng = np.random.default_rng(times)
    vec = rng.normal(size=(45, 6))
    vec /= np.linalg.norm(vec, axis=1)[:, None]
    rows = [(i, v) for i, v in enumerate(vec) if i not in (1, 21)] + [(21, vec[20])]
    rows += [(0, vec[0]), (20, vec[20])] * (times - 1)
    rows += [(1, vec[0] * (1 + j / 100)) for j in range(times)]
    data = [(i, v.tolist()) for i, v in rows]
    near = ann.nearest(spark.createDataFrame(data, "vec_id long, embedding array<double>"), ann.F.col("id") % 20 == 0)
    got = {}
    for r in near.collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, round(r.score, 9)))
    assert sorted(got) == [0, 20, 40]
    for q, found in got.items():
        best = {}
        for i, v in rows:
            if i != q:
                best[i] = max(best.get(i, -9.0), float((vec[q] * v).sum()))
        exact = sorted(best.items(), key=lambda p: (-round(p[1], 9), p[0]))[:20]
        each = times if q in (0, 20) else 1
        assert sorted(found) == sorted([(n, i, round(s, 9)) for n, (i, s) in enumerate(exact, 1)] * each)


def test_language_held_out():
    rng = random.Random(1)
    sample = [(words(rng, lang, rng.randint(3, 60)), lang) for lang in LANGUAGES for _ in range(40)]
    model = language.fit(sample)
    predict = language.scorer(model)()
    texts = [words(rng, lang, 8) for lang in LANGUAGES for _ in range(20)]
    names, score, _ = predict([*texts, None, "", "12 !?"])
    assert names.to_pylist()[-3:] == ["und"] * 3
    right = sum(a == b for a, b in zip(names.to_pylist(), [lang for lang in LANGUAGES for _ in range(20)], strict=False))
    assert right >= 57
    assert all(0 <= s <= 1 for s in score.to_pylist())


def test_letters_above_the_basic_plane():
    rng = random.Random(1)
    model = language.fit([(words(rng, lang, 20), lang) for lang in LANGUAGES for _ in range(10)])
    names, score, unsure = language.scorer(model)()(["😀", "😀🎉 🚀", "12 😀 !?", "𝟏𝟐", "𠀀", "😀 the cat"])
    assert names.to_pylist()[:4] == ["und"] * 4 and score.to_pylist()[:4] == [0.0] * 4
    assert unsure.to_pylist()[:4] == [True] * 4
    assert not {"und"} & set(names.to_pylist()[4:])


def test_the_bound_on_the_sample_removes_no_language(spark):
    rng = random.Random(2)
    rows = [(100 * k + i, words(rng, "aa", 9), f"l{k:02}") for k in range(30) for i in range(10 if k < 20 else 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert language.fit_language(docs, per_language=10, rows=60).languages == [f"l{k:02}" for k in range(30)]
    assert language.fair_level([1, 10, 10], 10, 11) == 5
    assert language.fair_level([3, 600, 9000], 500, 4000) == 500


def test_codewords_differ():
    for classes in (2, 3, 4, 6, 9, 20):
        code = language.codewords(classes)
        apart = (code[:, None, :] != code[None]).sum(axis=2) + np.eye(classes) * 99
        assert apart.min() >= (1 if classes == 2 else 2)


def test_toxicity_held_out():
    rng = random.Random(5)

    def text(toxic):
        w = ["".join(rng.choice(["ba", "no", "ti", "re", "lu", "ka"]) for _ in range(rng.randint(1, 4))) for _ in range(150)]
        for at in rng.sample(range(150), 6 * toxic):
            w[at] = rng.choice(["vexgrub", "hatezog", "slurwix"])
        return " ".join(w)

    rows = [(text(y), y) for y in (i % 5 == 0 for i in range(500))]
    model = toxicity.fit([(t, int(y)) for t, y in rows])
    score = toxicity.scorer(model)()([*(text(i < 30) for i in range(130)), None, ""])[0].to_numpy()
    assert (score[:30] >= toxicity.THRESHOLD).mean() > 0.9
    assert (score[30:] < toxicity.THRESHOLD).mean() > 0.95


def test_quality_held_out():
    rng = random.Random(7)
    good = lambda: " ".join(rng.choice(LANGUAGES["aa"]) for _ in range(60)) + "."
    bad = lambda: " ".join(rng.choice(LANGUAGES["aa"]).upper() + "!!" for _ in range(60))
    model = quality.fit([(good() if i % 4 else bad(), int(i % 4 > 0)) for i in range(200)])
    score = quality.scorer(model)()([good() for _ in range(20)] + [bad() for _ in range(20)] + [None, ""])[0].to_numpy()
    assert (score[:20] >= 0.3).all() and (score[20:40] < 0.3).all()


def test_scores_for_every_document(spark, folder):
    for name in ("op3_compression_toxicity", "op6_code_language", "op10_nb_support_vectors"):
        rows = LLM_QUERIES[name](spark, folder).collect()
        assert len(rows) == table(spark, folder, "documents").count()
        assert all(0 <= r.score <= 1 for r in rows)
        parts, rest = {"op3": (4, 2), "op6": (3, 1), "op1": (5, 0)}[name[:3]]
        assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % parts == rest) for r in rows if r.doc_id is not None)


def test_shards(spark, folder):
    rows = LLM_QUERIES["op9_virtual_slots"](spark, folder).collect()
    texts = sorted((i or -1, len(t.encode()) + 16, zlib.crc32(t.encode())) for i, t in texts_of(spark, folder))
    assert sorted((r.doc_id or -1, r["size"], r.text_crc32) for r in rows) == texts
    places = {}
    for r in rows:
        assert 0 <= r.shard < 40 and r.law == "bytes"
        places.setdefault(r.shard, []).append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_rebalancing_moves_little(spark):
    rng = random.Random(9)
    loads = {i: rng.randint(1, 100) for i in range(400)}
    old = sharding.assign(loads, 8)
    loads[3] += 900
    new = sharding.rebalanced(old, loads, 8)
    held = [sum(loads[s] for s in new if new[s] == k) for k in range(8)]
    assert max(held) - min(held) <= max(900, max(loads.values()))
    assert sum(old[s] != new[s] for s in old) < 80
    grown = sharding.rebalanced(old, loads, 9)
    assert {grown[s] for s in grown} == set(range(9))
    folder = new_folder(spark, "maps")
    sharding.store_map(spark, folder, 1, old)
    sharding.store_map(spark, folder, 2, new)
    assert {r.virtual_slot: r.shard for r in sharding.read_map(spark, folder, 1).collect()} == old


def test_sql_is_for_registered_queries():
    assert set(LLM_SQL) <= set(LLM_QUERIES)


def test_stages_take_effect(spark, folder):
    docs = table(spark, folder, "documents")
    counts = [docs.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.written(stage(spark, docs, folder), "test-stage")
        assert docs.columns == table(spark, folder, "documents").columns
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True)
    ids = [r.doc_id for r in docs.collect()]
    assert not {500, 501} & set(ids)
    assert len([i for i in ids if i is not None]) == len({i for i in ids if i is not None})
    assert {r.doc_id for r in corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()} == set(ids)


def test_the_toxicity_stage_drops_what_op3_calls_toxic(spark, folder, monkeypatch):
    score = corpus_pipeline.F.col("doc_id") / 100
    monkeypatch.setattr(toxicity, "fit_toxicity", lambda docs, labels: None)
    monkeypatch.setattr(toxicity, "toxicity", lambda docs, model, keep_text=True, column="score": docs.withColumn(column, score))
    docs = spark.createDataFrame([(i, "x") for i in (0, 29, 30, 45, 50, 90)], "doc_id long, text string")
    assert sorted(r.doc_id for r in corpus_pipeline.keep_ordinary(spark, docs, folder).collect()) == [0, 29]


def test_pipeline_of_empty_tables(spark, empty):
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_stages_leave_columns_alone_whatever_their_names(spark, folder):
    """Columns named like those the stages add, and a map besides an id that repeats."""
    docs = table(spark, folder, "documents").drop("score", "node", "rank")
    docs = docs.selectExpr(
        "*", "doc_id as __toxicity", "text as __language_ambiguous", "doc_id as __place", "map('k', doc_id) as tags"
    )
    docs = shared.written(docs, "test-clash")
    for name, stage in corpus_pipeline.STAGES[:3]:
        kept = shared.written(stage(spark, docs, folder), "test-clash")
        assert kept.columns == docs.columns and kept.count() > 0, name
        wrong = "not (doc_id <=> __toxicity and text <=> __language_ambiguous and doc_id <=> __place and doc_id <=> tags['k'])"
        assert kept.where(wrong).isEmpty(), name
        docs = kept
    assert docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()


def test_near_duplicates_of_ids_with_an_empty_row(spark):
    """A repeated id with a null or empty text beside a text that has a near copy."""
    words = [f"w{i}" for i in range(200)]
    near = " ".join([*words[:-1], "other"])
    rows = [(1, " ".join(words)), (1, None), (2, near), (2, ""), (3, "alone here with five words")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id, r.n_shingles > 0, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect())
    assert got == [(1, False, 1, True), (1, True, 1, True), (2, False, 1, False), (2, True, 1, False), (3, True, 3, True)]


def test_labels_that_fit_no_document_take_no_place(spark):
    """A hundred labels for each document: the bound counts labelled documents, and all of them are found."""
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(50)] + [(3, "again"), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(5000)], "doc_id long, quality int")
    got = shared.labelled_sample(docs, labels, "quality", rows=60)
    assert sorted(got) == sorted([(f"text {i}", i % 2) for i in range(50)] + [("again", 1)])
    assert len(shared.labelled_sample(docs, labels, "quality", rows=20)) == 20


def test_long_texts_take_part_in_training(spark):
    texts = [("é" if i % 2 else "o") * 600 + f" {'bad' if i % 2 else 'good'} " * 300 for i in range(20)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("lang", ann.F.lit("aa"))
    labels = spark.createDataFrame([(i, i % 2) for i in range(20)], "doc_id long, quality int")
    got = shared.labelled_sample(docs, labels, "quality", rows=50, max_bytes=800)
    assert len(got) == 20
    assert all(len(text.encode()) <= 800 and ("bad" if label else "good") in text for text, label in got)
    assert language.fit_language(docs).languages == ["aa"]


def test_import_errors_of_the_operators_leave_the_other_queries(monkeypatch):
    import sys

    import __spark_entry__ as entry

    both = set(entry.queries())
    monkeypatch.setitem(sys.modules, "ledgersieve.llm.registered", None)
    assert set(entry.queries()) == both - set(LLM_QUERIES) - {"pipeline"}
    assert not set(entry.oracle_sql()) & set(LLM_QUERIES)


def test_sets_are_compared_in_slices(monkeypatch):
    rng = np.random.default_rng(4)
    pool = np.sort(rng.integers(0, 2**64, 300, dtype=np.uint64))
    a, b = ([np.sort(rng.choice(pool, n, replace=False)) for n in rng.integers(1, 200, 30)] for _ in range(2))
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 500)
    exact = np.array([[len(np.intersect1d(x, y)) for y in b] for x in a])
    assert (minhash.shared_in_slices(a, b) == exact).all()


def test_blocks_are_bounded_by_shingles_too(spark, monkeypatch):
    rng = random.Random(8)
    base = [f"w{rng.randint(0, 10**6)}" for _ in range(60)]
    rows = [(i, " ".join(base[: 50 + i % 10] + [f"v{i}"] * (i % 7 == 0))) for i in range(90)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    whole = {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()}
    monkeypatch.setattr(minhash, "SMALL_GROUP", 0)
    monkeypatch.setattr(minhash, "BLOCK_SHINGLES", 400)
    assert {r.doc_id: r.component_id for r in minhash.near_duplicates(docs, words=2).collect()} == whole


def test_rows_with_one_id_are_dealt_to_several_token_files(spark, monkeypatch):
    docs = spark.range(400).select(ann.F.lit(None).cast("long").alias("doc_id"), ann.F.lit("one two three").alias("text"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        folder, files, by_rank = tokenfiles.write_token_files(docs)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert files.count() == 2  # the session's partitions
    rows = tokenfiles.read_token_files(folder, files, by_rank).collect()
    width = rows[0].n_tokens
    assert sorted(r.start for r in rows) == [width * i for i in range(400)]


def least_edits(pattern, text):
    """Plain edit distance of a pattern to its best place in a text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(pattern, 1):
        last, row = row, [i]
        for j, d in enumerate(text, 1):
            row.append(min(last[j - 1] + (c != d), last[j] + 1, row[-1] + 1))
    return min(row)


def test_banded_alignment_equals_the_whole_matrix():
    rng = random.Random(12)
    for _ in range(300):
        pattern = "".join(rng.choice("ab") for _ in range(rng.randint(1, 12)))
        text = "".join(rng.choice("ab") for _ in range(rng.randint(0, 16)))
        most = rng.randint(0, 4)
        got = decontamination.banded(
            decontamination.points(pattern), decontamination.points(text), most, -len(pattern) - 1, len(text) + 1
        )
        best = least_edits(pattern, text)
        assert (got is None) == (best > most)
        if got:
            assert got[0] == best == least_edits(pattern, text[got[1] : got[2]])


def test_decontamination_equals_plain_edit_distance_of_all_pairs(spark):
    """Every document against every item, with passages edited by less and by more than the budget."""
    rng = random.Random(21)
    items = [(i, "".join(rng.choice("abcdef ") for _ in range(rng.randint(60, 130))).strip()) for i in range(8)]
    docs = []
    for i in range(40):
        text = "".join(rng.choice("ghij ") for _ in range(rng.randint(0, 80)))
        for _ in range(rng.randint(0, 2)):
            passage = list(rng.choice(items)[1])
            for at in sorted(rng.sample(range(len(passage)), rng.randint(0, 9)), reverse=True):
                passage[at : at + 1] = rng.choice([["z"], [], [passage[at], "y"]])
            text += "".join(passage) + "".join(rng.choice("ghij ") for _ in range(rng.randint(0, 40)))
        docs.append((i, text))
    found = decontamination.contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    expected = set()
    for doc_id, text in docs:
        for item_id, item in items:
            (pattern,) = decontamination.patterns(item)
            if least_edits(pattern, decontamination.normal(text)) <= decontamination.budget(len(pattern)):
                expected.add((doc_id, item_id))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == expected
    assert 10 < len(expected) < 60


def test_shards_have_nearly_equal_bytes(spark, folder):
    """The law of bytes: no shard is over another by more than the largest virtual slot."""
    rows = LLM_QUERIES["op9_virtual_slots"](spark, folder).collect()
    shards, slots = {k: 0 for k in range(40)}, {}
    for r in rows:
        shards[r.shard] += r["size"]
        slots[r.virtual_slot] = slots.get(r.virtual_slot, 0) + r["size"]
    assert {r.virtual_slot: r.shard for r in rows} and len({(r.virtual_slot, r.shard) for r in rows}) == len(slots)
    assert max(shards.values()) - min(shards.values()) <= max(slots.values())


def test_an_archive_is_read_by_several_tasks(spark):
    pages = spark.range(300).selectExpr("id as page_id", "cast(null as string) as url", "repeat('x', cast(900 + id as int)) as html")
    place, index = warc.write_archive(pages.coalesce(1), frame_bytes=2000)
    assert index.select("bundle").distinct().count() == 1
    read = warc.read_archive(place, index, frames=10)
    assert read.rdd.getNumPartitions() > 5
    assert sorted(r.page_id for r in read.collect()) == list(range(300))


def test_small_equal_pages_are_spread(spark):
    pages = spark.range(0, 800, 1, 4).selectExpr("cast(null as long) as page_id", "cast(null as string) as url", "'' as html")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = warc.with_types(pages).withColumn("p", ann.F.spark_partition_id()).collect()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len({r.p for r in rows}) > 1
    assert len(rows) == 800 and {r.record_type for r in rows} == {"response"}


def test_marks_miss_no_key_and_clear_most_other_rows(spark):
    rows = spark.range(20_000).selectExpr("if(id = 7, null, id) as doc_id", "id as __place", "id as may_be")
    keys = spark.range(0, 20_000, 100).selectExpr("id as doc_id")
    found = shared.possibly_in(rows, "doc_id", keys)
    assert found.columns == rows.columns
    got = {r.doc_id for r in found.collect()}
    assert got >= set(range(0, 20_000, 100)) and len(got) < 3_000
    assert shared.possibly_in(rows, "doc_id", keys.where("false")).isEmpty()
    assert shared.marked(rows, "doc_id", keys, "__bucket").count() == 20_000


def shuffled_texts(spark, frame):
    """Whether a plan joins ids with texts that no bitmap has been asked about."""
    plan = frame._jdf.queryExecution().optimizedPlan().toString()
    return re.search(r"Join LeftSemi|Join LeftAnti", plan) and "__place" not in plan


def test_texts_meet_a_bitmap_before_they_are_shuffled(spark, folder):
    docs = table(spark, folder, "documents")
    nodes = shared.written(docs.where("doc_id % 50 = 0").selectExpr("doc_id as node").distinct(), "test-nodes")
    assert not shuffled_texts(spark, minhash.whole_sets(docs, nodes, 5))
    assert not shuffled_texts(spark, corpus_pipeline.keep_one_of_each_group(spark, docs.where("doc_id < 100").dropDuplicates(["doc_id"]), folder))


def test_fitting_languages_holds_no_dense_matrix():
    import tracemalloc

    rng = random.Random(5)
    sample = [(words(rng, lang, 60), lang) for lang in LANGUAGES for _ in range(500)]
    tracemalloc.start()
    try:
        model = language.fit(sample, steps=3)
        assert tracemalloc.get_traced_memory()[1] < 70_000_000  # 4,500 rows of 8,192 floats are 147 MB
    finally:
        tracemalloc.stop()
    assert model.languages == sorted(LANGUAGES)


def test_equal_words_of_the_toxicity_sample_are_one_object():
    (first, _), (second, _) = toxicity.one_of_each_family([("one two three four", 0), ("four zzz three yyy", 1)])
    assert first & second == {b"three", b"four"}
    assert {id(w) for w in first if w in second} == {id(w) for w in second if w in first}
