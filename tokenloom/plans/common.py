"""Frames and SQL fragments shared by several groups of queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import tokens as K
from ..operators import pairing, vocab
from ..session import table
from . import sql as S

PAIRS_SQL = """(SELECT u.conv_id, u.turn, u.text AS src, a.text AS tgt FROM conversations u
  JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant')"""

DOC_TOKENS_SQL = f"(SELECT doc_id, unnest({S.words('text')}) AS token FROM documents)"
DOC_COUNTS_SQL = f"(SELECT token, count(*) AS n FROM {DOC_TOKENS_SQL} GROUP BY token)"


def vocab_sql(first_id: int, most: int | None = None, counts: str = DOC_COUNTS_SQL) -> str:
    cut = f"WHERE id < {first_id + most}" if most else ""
    return (f"(SELECT * FROM (SELECT token, n::BIGINT AS n, row_number() OVER (ORDER BY n DESC, token) - 1 + {first_id} AS id "
            f"FROM {counts}) {cut})")


def docs(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def turns(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "conversations")


def pairs(spark: SparkSession, folder: str) -> DataFrame:
    return pairing.next_turn_pairs(turns(spark, folder))


def doc_words(spark: SparkSession, folder: str, *extra: str) -> DataFrame:
    return docs(spark, folder).select("doc_id", *extra, K.words(F.col("text")).alias("tokens"))


def doc_counts(spark: SparkSession, folder: str) -> DataFrame:
    return vocab.corpus_counts(docs(spark, folder), K.words(F.col("text")))


def as_long(name: str):
    return F.col(name).cast("long").alias(name)
