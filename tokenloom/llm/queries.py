"""The registered queries of the subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import language, lexical, lexical_sql, linetemplates, mixing, mixing_sql, pieces, pitmanyor, quality, spelling, spelling_sql, tokenbin
from .exact import exact_groups
from .neardup import near_duplicates
from .neighbours import nearest_neighbours
from .passages import without_repeats

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def add(plan):
        QUERIES[name] = plan
        if oracle:
            ORACLES[name] = oracle
        return plan

    return add


def documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet")


@query("op1_exact_dedup", """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
)
SELECT doc_id, max(doc_id) OVER (PARTITION BY norm) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept, sha256(norm) AS text_sha256
FROM d""")
def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = exact_groups(documents(spark, folder))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query("op10_minhash_near_dedup")
def op10_minhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(documents(spark, folder), width=4, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query("op9_substring_dedup")
def op9_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    report, _ = without_repeats(documents(spark, folder))
    return report.select("doc_id", "n_words", "n_removed", F.lower(F.hex("kept_digest")).alias("kept_sha256"))


@query("op5_language_id")
def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = language.fold("doc_id", 3) == 1
    model = language.learn(docs.where(~F.coalesce(held_out, F.lit(True))))
    return language.predict(docs, model).select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score")


@query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = documents(spark, folder)
    held_out = language.fold("doc_id", 5) == 0
    labels = spark.read.parquet(f"{folder}/labels.parquet").where(~F.coalesce(held_out, F.lit(True)))
    return quality.score(docs, quality.learn(docs, labels)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


@query("op2_token_ids")
def op2_token_ids(spark: SparkSession, folder: str) -> DataFrame:
    parts, place, kind = tokenbin.write_tokens(documents(spark, folder), public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return tokenbin.read_tokens(parts, place, kind).withColumnRenamed("key", "doc_id")


@query("op4_nearest_neighbours")
def op4_nearest_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    rows = spark.read.parquet(f"{folder}/embeddings.parquet")
    return nearest_neighbours(rows, rows.where("vec_id % 20 = 0"), k=20)


@query("op3_sentencepiece")
def op3_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.report(documents(spark, folder), public_tokenizers.path("piece_bpe_32k.model"))


@query("op6_line_dedup")
def op6_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    kept = linetemplates.without_repeated_lines(documents(spark, folder), **linetemplates.EVERY_LINE)
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query("op8_mix_sources", mixing_sql.MIX)
def op8_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(documents(spark, folder).select("doc_id", "source", "text")).select(
        "doc_id", "source", "epoch", F.round("place", 6).alias("place"))


@query("op11_lexical_search", lexical_sql.SEARCH)
def op11_lexical_search(spark: SparkSession, folder: str) -> DataFrame:
    return lexical.ranked(documents(spark, folder), spark.read.parquet(f"{folder}/benchmark.parquet"), k=20)


@query("op12_spelling_variants", spelling_sql.VARIANTS)
def op12_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(documents(spark, folder)))


@query("op13_lm_scoring")
def op13_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return pitmanyor.scored(documents(spark, folder), language.fold("doc_id", 7) == 2)


@query("pipeline")
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
