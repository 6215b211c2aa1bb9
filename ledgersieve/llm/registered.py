"""The registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgersieve.llm import (
    ann,
    decontamination,
    infill,
    language,
    merkle,
    minhash,
    packing,
    quality,
    sharding,
    suffixtrees,
    tokenfiles,
    toxicity,
    warc,
)
from ledgersieve.llm.shared import held_out_is, new_folder


ROOT = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table of the folder. Python workers of a local session find this package whatever folder they start in."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_seekable_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.read_archive(*warc.write_archive(table(spark, sf_dir, "pages")))


def op2_qgram_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op7_projection_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ann.nearest(table(spark, sf_dir, "embeddings"), F.col("id") % 20 == 0, k=20)


def _judged(scores: DataFrame, held_out: Column, threshold: float) -> DataFrame:
    return scores.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def op3_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents").select("doc_id", "text"), held_out_is("doc_id", 4, 2)
    model = toxicity.fit_toxicity(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return _judged(toxicity.toxicity(docs, model, keep_text=False), held_out, toxicity.THRESHOLD)


def op6_code_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents"), held_out_is("doc_id", 3, 1)
    model = language.fit_language(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model, keep_text=False)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "ambiguous")


def op10_nb_support_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, held_out = table(spark, sf_dir, "documents").select("doc_id", "text"), held_out_is("doc_id", 5, 0)
    model = quality.fit_quality(docs.where(~held_out), table(spark, sf_dir, "labels"))
    return _judged(quality.quality(docs, model, keep_text=False), held_out, quality.THRESHOLD)


def op4_ranked_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.read_token_files(*tokenfiles.write_token_files(table(spark, sf_dir, "documents")))


def op5_histogram_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op8_hyperminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op9_virtual_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = new_folder(spark, "slot-map")
    rows = sharding.shard_documents(table(spark, sf_dir, "documents"), folder, shards=40)
    return rows.select(
        "doc_id",
        "size",
        "text_crc32",
        sharding.law().alias("law"),
        "shard",
        F.col("place").cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "virtual_slot",
    )


def op11_rotated_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    return infill.digest_rows(table(spark, sf_dir, "documents"))


def op12_suffix_tree_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cut = suffixtrees.without_repeats(docs, window=35, keep_text=False)
    return cut.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.tamper_proofs(table(spark, sf_dir, "documents"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_seekable_warc": op1_seekable_warc,
    "op2_qgram_decontamination": op2_qgram_decontamination,
    "op3_compression_toxicity": op3_compression_toxicity,
    "op4_ranked_token_files": op4_ranked_token_files,
    "op5_histogram_packing": op5_histogram_packing,
    "op6_code_language": op6_code_language,
    "op7_projection_forest": op7_projection_forest,
    "op8_hyperminhash": op8_hyperminhash,
    "op9_virtual_slots": op9_virtual_slots,
    "op10_nb_support_vectors": op10_nb_support_vectors,
    "op11_rotated_infill": op11_rotated_infill,
    "op12_suffix_tree_repeats": op12_suffix_tree_repeats,
    "op13_merkle_manifest": op13_merkle_manifest,
}



def _merkle_sql(levels: int = 5) -> str:
    """The trees level by level: ``levels`` of them do for 16**levels leaves a source and as many sources."""
    field = "coalesce(strlen({0}::VARCHAR) || ':' || {0}::VARCHAR, '-')"
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field.format(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"

    # The crc32 of the id's digits, bit by bit: a digit is folded in, then eight steps of one bit each.
    bits = "flatten(list_transform(string_split(doc_id::VARCHAR, ''), lambda d: [ascii(d), -1, -1, -1, -1, -1, -1, -1, -1]))"
    step = "CASE WHEN s >= 0 THEN xor(c, s) ELSE xor(c >> 1, 3988292384 * (c & 1)) END"
    crc = f"xor(list_reduce(list_prepend(4294967295::BIGINT, {bits}::BIGINT[]), lambda c, s: {step}), 4294967295)"
    parts = [
        f"""rows_ AS (
            SELECT doc_id, coalesce('=' || source, '') AS g, {leaf("text")} AS leaf,
                   CASE WHEN {crc} % 5 = 0 THEN {leaf(lowered)} END AS claimed
            FROM documents
        )""",
        """l0 AS (
            SELECT doc_id, g, leaf, coalesce(claimed, leaf) AS x, '' AS proof,
                   row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p
            FROM rows_
        )""",
        "n0 AS (SELECT g, p AS pos, leaf AS h, count(*) OVER (PARTITION BY g) AS n FROM l0)",
    ]

    def climb(begin: int, end: int) -> None:
        for k in range(begin, end):
            parts.append(f"""r{k} AS (
                SELECT g, pos // 16 AS r, list(h ORDER BY pos) AS hs, any_value(n) AS n FROM n{k} GROUP BY ALL
            )""")
            parts.append(f"""n{k + 1} AS (
                SELECT g, r AS pos, CASE WHEN n > 1 THEN sha256(array_to_string(hs, '')) ELSE hs[1] END AS h,
                       (n + 15) // 16 AS n
                FROM r{k}
            )""")
            parts.append(f"""m{k} AS (
                SELECT l.*, r{k}.n, array_to_string(hs[:p % 16], '') AS a, array_to_string(hs[p % 16 + 2:], '') AS b
                FROM l{k} l JOIN r{k} ON l.g = r{k}.g AND l.p // 16 = r{k}.r
            )""")
            kept = "doc_id, g, leaf" + (", subroot" if begin else "")
            parts.append(f"""l{k + 1} AS (
                SELECT {kept}, CASE WHEN n > 1 THEN sha256(a || x || b) ELSE x END AS x,
                       CASE WHEN n > 1 THEN proof || a || b ELSE proof END AS proof, p // 16 AS p
                FROM m{k}
            )""")

    climb(0, levels)
    parts.append(f"s AS (SELECT g, h, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM n{levels})")
    parts.append(f"n{levels + 1} AS (SELECT '' AS g, pos, h, n FROM s)")
    parts.append(f"""l{levels + 1} AS (
        SELECT l.doc_id, '' AS g, l.leaf, s.h AS subroot, l.x, l.proof, s.pos AS p FROM l{levels} l JOIN s ON l.g = s.g
    )""")
    climb(levels + 1, 2 * levels + 1)
    last = 2 * levels + 1
    return f"""
        WITH {", ".join(parts)}
        SELECT l.doc_id, l.leaf, l.subroot, t.h AS root, sha256(l.proof) AS proof_sha256, l.x AS folded_root,
               l.x = t.h AS verified
        FROM l{last} l CROSS JOIN n{last} t
    """


#: SQL for the queries that it can express.
LLM_SQL: dict[str, str] = {
    "op1_seekable_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS payload FROM pages
        ), d AS (
            SELECT page_id, strlen(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p
        ), g AS (
            SELECT payload_digest, max(page_id) AS newest FROM d WHERE payload_bytes >= 1000 GROUP BY 1
        )
        SELECT d.page_id, d.payload_bytes, d.payload_digest,
               CASE WHEN g.newest IS NOT NULL AND d.page_id IS DISTINCT FROM g.newest
                    THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN d.page_id IS DISTINCT FROM g.newest THEN g.newest END AS refers_to
        FROM d LEFT JOIN g ON d.payload_digest = g.payload_digest AND d.payload_bytes >= 1000
    """,
    "op8_hyperminhash": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), s AS (
            SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN [w[1]]
                ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS g
            FROM d
        ), n AS (
            SELECT doc_id, count(*) AS n FROM s GROUP BY 1
        ), p AS (
            SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
        ), e AS (
            SELECT u, v FROM p JOIN n x ON x.doc_id = u JOIN n y ON y.doc_id = v WHERE 100 * shared >= 80 * (x.n + y.n - shared)
        ), links AS (
            SELECT u, v FROM e UNION ALL SELECT v, u FROM e
        ), reach AS (
            WITH RECURSIVE r AS (
                SELECT u, v FROM links UNION SELECT r.u, l.v FROM r JOIN links l ON l.u = r.v
            ) SELECT u, min(v) AS least FROM r GROUP BY 1
        )
        SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(reach.least, d.doc_id)) AS component_id,
               d.doc_id = least(d.doc_id, coalesce(reach.least, d.doc_id)) AS kept
        FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN reach ON reach.u = d.doc_id
    """,
    "op11_rotated_infill": """
        WITH d AS (
            SELECT doc_id, coalesce(text, '') AS t, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h FROM documents
        ), u AS (
            SELECT doc_id, t, length(t) AS n, ('0x' || h[1:8])::BIGINT % (length(t) + 1) AS c1,
                   ('0x' || h[9:16])::BIGINT % (length(t) + 1) AS c2, ('0x' || h[17:24])::BIGINT AS h3,
                   ('0x' || h[25:32])::BIGINT AS h4
            FROM d
        ), f AS (
            SELECT *, least(c1, c2) AS lo, greatest(c1, c2) AS hi,
                   CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90
                        THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
            FROM u
        ), o AS (
            SELECT *, substr(t, 1, lo) AS prefix, substr(t, lo + 1, hi - lo) AS middle, substr(t, hi + 1) AS suffix FROM f
        )
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN lo END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN hi - lo END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t
                                WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                                ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM o
    """,
    "op12_suffix_tree_repeats": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
            FROM documents
        ), p AS (
            SELECT r, unnest(range(1, len(w) - 33)) AS i FROM d
        ), s AS (
            SELECT p.r, p.i, sha256(array_to_string(d.w[p.i:p.i + 34], ' ')) AS path FROM p JOIN d ON p.r = d.r
        ), c AS (
            SELECT r, i, count(*) OVER (PARTITION BY path) AS n FROM s
        ), k AS (
            SELECT r, list(i) AS starts FROM c WHERE n > 1 GROUP BY r
        ), v AS (
            SELECT d.r, list_distinct(flatten(list_transform(k.starts, lambda i: range(i, i + 35)))) AS gone
            FROM d JOIN k ON d.r = k.r
        ), m AS (
            SELECT r, unnest(gone) AS i FROM v
        ), a AS (
            SELECT r, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d
        ), kept AS (
            SELECT a.r, string_agg(a.word, ' ' ORDER BY a.i) AS t FROM a ANTI JOIN m ON a.r = m.r AND a.i = m.i GROUP BY a.r
        )
        SELECT d.doc_id, len(d.w) AS n_words, coalesce(len(v.gone), 0) AS n_removed,
               sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM d LEFT JOIN v ON d.r = v.r LEFT JOIN kept ON d.r = kept.r
    """,
    "op13_merkle_manifest": _merkle_sql(),
}
