"""From raw documents to packed training sequences, stage by stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgersieve.llm import decontamination, language, minhash, packing, toxicity
from ledgersieve.llm.registered import table
from ledgersieve.llm.shared import held_out_is, marked, written


def _free(docs: DataFrame, name: str) -> str:
    """A name that no column of the documents begins with."""
    while any(c.lower().startswith(name) for c in docs.columns):
        name = f"_{name}"
    return name


def _all(docs: DataFrame) -> list[Column]:
    return [F.col(f"`{c}`") for c in docs.columns]


def keep_ordinary(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that op3 calls toxic. Null and empty texts stay unless no evidence alone reaches that cut."""
    model = toxicity.fit_toxicity(docs.where(~held_out_is("doc_id", 4, 2)), table(spark, sf_dir, "labels"))
    score = _free(docs, "__toxicity")
    found = toxicity.toxicity(docs, model, column=score)
    return found.where(F.col(score) < toxicity.THRESHOLD).select(_all(docs))


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter (null and empty texts too) and those whose language is ambiguous."""
    model = language.fit_language(docs.where(~held_out_is("doc_id", 3, 1)))
    if not model.languages:
        return docs
    prefix = _free(docs, "__language_")
    found = language.identify(docs, model, prefix=prefix)
    sure = (F.col(f"{prefix}lang_pred") != language.UNDETERMINED) & ~F.col(f"{prefix}ambiguous")
    return found.where(sure).select(_all(docs))


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the least doc_id of each group of near-duplicates (five words, 0.8 and more).

    Of rows that repeat an id one stays: that with the least text, then with the least other columns as JSON text (which
    orders maps too). Rows without an id stay. Texts without words are linked with nothing.
    """
    found = written(minhash.near_duplicates(docs, words=5, percent=80), "pipeline-near")
    gone = written(found.where("not kept").select("doc_id").distinct(), "pipeline-gone")
    mark = _free(docs, "__maybe_gone")
    known = marked(docs, "doc_id", gone, mark)
    # Only documents that a bitmap of the dropped ids doesn't clear are shuffled to meet them.
    asked = known.where(F.col(mark)).join(gone, "doc_id", "left_anti").select(_all(docs))
    rest = known.where(~F.col(mark)).select(_all(docs)).unionByName(asked)
    again = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("doc_id is not null and n > 1").select("doc_id")
    if again.isEmpty():
        return rest
    place = _free(docs, "__place")
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")]
    order = ["text", F.to_json(F.struct(*others))] if others else ["text"]
    repeated = rest.join(again, "doc_id", "left_semi").withColumn(place, F.row_number().over(Window.partitionBy("doc_id").orderBy(*order)))
    one = repeated.where(F.col(place) == 1).select(_all(docs))
    return rest.join(again, "doc_id", "left_anti").select(_all(docs)).unionByName(one)


def keep_unseen(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a passage of the benchmark."""
    return decontamination.clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack what is left into sequences of 2,048 tokens."""
    return packing.pack_documents(docs)


Stage = Callable[[SparkSession, DataFrame, str], DataFrame]
STAGES: list[tuple[str, Stage]] = [
    ("toxicity", keep_ordinary),
    ("language", keep_identified),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_unseen),
    ("packing", pack),
]

#: Trained models, tokenizers and edit distances are not SQL.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
