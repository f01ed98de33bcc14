"""A corpus pipeline of five operators: language, repeated lines, near copies, source weights, pieces."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tokenloom.llm import language, linetemplates, mixing, pieces
from tokenloom.llm.neardup import near_duplicates, words_digest
from tokenloom.llm.words import unused
from tokenloom.session import staged

WIDTH, PERCENT = 5, 80
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def own(docs: DataFrame) -> list[Column]:
    """The columns of the documents, whatever their names."""
    return [F.col(f"`{name}`") for name in docs.columns]


def known_language(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents whose language can be told; without any letter they are rejected. ``lang`` is the predicted one."""
    model = language.learn(docs)
    told, = unused(docs.columns, "_lang")
    found = language.predict_onto(docs, model, text="text", column=told)
    return found.where(F.col(told) != language.UNKNOWN).withColumn("lang", F.col(told)).select(*own(docs))


def new_lines(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Texts without lines of recurring templates; documents that lose every line with text go."""
    kept = linetemplates.without_repeated_lines(docs, **linetemplates.EVERY_LINE)
    emptied = (F.col("n_dropped") > 0) & (F.trim(F.regexp_replace("text", r"\s+", " ")) == "")
    return kept.where(~F.coalesce(emptied, F.lit(False))).withColumn("n_chars", F.length("text").cast("bigint")).select(*own(docs))


def one_of_each_group(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One text of each group of near copies: that of the smallest id. Texts that share an id are judged each by itself."""
    words, gone_id, gone_words = unused(docs.columns, "_words", "_gone_id", "_gone_words")
    gone = near_duplicates(docs, width=WIDTH, percent=PERCENT).where("not stays").select(
        F.col("doc_id").alias(gone_id), F.col("digest").alias(gone_words)).distinct()
    told_apart = docs.withColumn(words, words_digest(F.col("text")))
    same = (F.col("doc_id") == F.col(gone_id)) & (F.col(words) == F.col(gone_words))
    return told_apart.join(gone.hint("merge"), same, "left_anti").select(*own(docs))


def mixed(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """The stream of documents at tempered source weights; documents of small sources come several times.

    Rows lie in stream order: the files of the stage, by name, are the stream.
    """
    stream = mixing.mix(docs)
    order = ["place", "epoch", "doc_id"]
    return stream.repartitionByRange(*order).sortWithinPartitions(*order).select(*own(docs))


def encoded(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Piece ids of each text, with the number of pieces and whether they decode to the text."""
    return pieces.encode_checked(docs.select("doc_id", "lang", "source", "text"), PIECES).drop("text")


STAGES = [
    ("language", known_language),
    ("line dedup", new_lines),
    ("near duplicates", one_of_each_group),
    ("source mixing", mixed),
    ("pieces", encoded),
]
ORACLE_SQL = None  # suffix automata, templates, minima and Viterbi paths have no SQL form


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's rows are written before the next reads them."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
