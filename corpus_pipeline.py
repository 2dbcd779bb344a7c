"""The corpus pipeline: five stages from raw documents to token ids.

Each stage takes (spark, docs, sf_dir), docs being what its predecessor kept, and returns
a DataFrame that ``run`` writes as Parquet and rereads for the next one:

1. quality classifier: documents it rejects go;
2. near-duplicates (five words, similarity 0.8): one document of each group stays;
3. secret scan: secrets are replaced in the texts, documents stay;
4. mixing: documents are repeated so that the languages' words match the target weights; every
   document stays at least once;
5. SentencePiece: texts become ids.

Special cases: an empty table passes every stage and ends in an empty result with all columns; a
null or empty text is scored like a text without words, is a near-duplicate of nothing, holds no
secret, weighs nothing in the mixing and has null or no ids; rows that repeat an id become one in
the second stage, rows without id are one per text; null languages and sources, ties and columns
beyond those of documents, also ones named like an operator's own, are carried as they are.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rawstrata.llm import (
    op1_mixing,
    op4_near_dedup,
    op6_quality_classifier,
    op7_sentencepiece,
    op9_secret_scan,
)
from rawstrata.llm.common import Workspace, apart, table

# Keeps rates near 1 where targets cannot be met, so that no document is repeated very often.
MIXING_RIDGE = 1e-3

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score reaches the classifier's threshold. One pass scores and carries
    whole rows, so nothing is joined back."""
    model = op6_quality_classifier.fit(docs, table(spark, sf_dir, "labels"))
    return op6_quality_classifier.keep(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of the document with the smallest id of each group. Rows without an id are one
    per text and take part under made-up ids above all others, so that of each group a row with
    an id stays where there is one. (Where no larger id is left, this fails.)"""
    work = Workspace(spark, "pipeline_near_duplicates")
    with_id = docs.filter("doc_id IS NOT NULL")
    largest = docs.agg(F.max(F.col("doc_id").cast("long"))).first()[0]
    made_up = F.monotonically_increasing_id() + F.lit(0 if largest is None else largest + 1)
    without_id = work.write(
        docs.filter("doc_id IS NULL")
        .dropDuplicates(["text"])
        .select(F.struct("*").alias("row"), made_up.alias("made_up")),
        "without_id",
    )
    named = with_id.select(F.col("doc_id").cast("long"), "text").unionByName(
        without_id.select(F.col("made_up").alias("doc_id"), "row.text")
    )
    found = work.write(op4_near_dedup.near_duplicates(named).select("doc_id", "kept"), "found")
    per_id = found.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    # Most documents stay and occur once: they are passed on and take part in no join.
    concerned = work.write(per_id.filter("NOT kept OR n > 1"), "concerned")
    maybe, others = apart(with_id, concerned)
    gone = concerned.filter("NOT kept").select("doc_id")
    kept = maybe.join(gone, "doc_id", "left_anti").dropDuplicates(["doc_id"])
    kept_without_id = without_id.join(gone, F.col("made_up") == gone.doc_id, "left_anti")
    return (
        kept.select(*docs.columns)
        .unionByName(others)
        .unionByName(kept_without_id.select("row.*"))
    )


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, with the secrets in its text replaced by a mark and ``n_chars`` following
    it. Rows without id are treated by their text like others; a null text stays null."""
    return op9_secret_scan.redact(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A rate of 2.3 gives a document two rows and, with a chance of 0.3 decided by a hash of
    its id, a third one. No rate is below 1."""
    labels = table(spark, sf_dir, "labels")
    name = "rate"
    while name in docs.columns:
        name += "_"
    rated = op1_mixing.with_rates(
        docs,
        op1_mixing.labelled_languages(docs, labels),
        name,
        least_rate=1.0,
        no_less=True,
        ridge=MIXING_RIDGE,
    )
    rate = F.col(name)
    chance = F.pmod(F.xxhash64("doc_id", F.lit("mixing")), F.lit(1 << 20)) / float(1 << 20)
    copies = F.floor(rate) + (chance < rate - F.floor(rate)).cast("long")
    each = F.sequence(F.lit(1).cast("long"), copies)
    return rated.withColumn(name, F.explode(each)).select(*docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, ids and restored (whether the ids give the text back) of every row. A
    null text has null ids, an empty one none."""
    return op7_sentencepiece.encode(docs)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality),
    ("near_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("mixing", mixing),
    ("sentencepiece", sentencepiece),
]

#: The classifiers and the segmentation are not expressible in SQL; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written to the shared folder and read again."""
    work = Workspace(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        held = work.write(stage(spark, docs, sf_dir), name)
        work.drop(docs)
        docs = held
    return docs
