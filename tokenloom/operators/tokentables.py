"""Token-level tables: one row per token, per distinct token, or per span."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window as W, functions as F
from pyspark.sql.types import StringType

from ..functions.tokens import WORD_SYMBOL_OR_GAP
from ..session import placed_by


def one_row_each(df: DataFrame, keep: list[str], items: str, name: str, pos: str | None = None) -> DataFrame:
    """One row per array element.

    An inner explode of a computed array column makes the optimiser test the
    array's size in a pushed-down filter, so the array would be built twice.
    The outer form with a null test afterwards builds it once.
    """
    element = F.posexplode_outer(items).alias(pos, name) if pos else F.explode_outer(items).alias(name)
    return df.select(*keep, element).where(F.col(pos or name).isNotNull())


def token_counts(df: DataFrame, tokens: str = "tokens") -> DataFrame:
    """Occurrences of each token; map-side partial sums keep frequent tokens cheap."""
    return one_row_each(df, [], tokens, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def words_with_offsets(df: DataFrame, key: str, text: str) -> DataFrame:
    """Words and symbols with their character offsets.

    Texts, not tokens, are shuffled: the window by ``key`` reuses that
    partitioning, and each window holds a single text.
    """
    pieces = (
        placed_by(df.select(key, text), key)
        .select(key, F.posexplode(F.regexp_extract_all(F.col(text), F.lit(WORD_SYMBOL_OR_GAP), 1)).alias("pos", "token"))
    )
    up_to_here = W.partitionBy(key).orderBy("pos").rowsBetween(W.unboundedPreceding, 0)
    return (
        pieces.withColumn("stop", F.sum(F.length("token")).over(up_to_here))
        .where(~F.col("token").rlike(r"^[\p{Z}\p{C}]"))
        .select(key, "token", (F.col("stop") - F.length("token")).alias("start"), "stop")
    )


@F.pandas_udf(StringType())
def _nfd(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for tokens in batches:
        yield tokens.map(lambda t: unicodedata.normalize("NFD", t), na_action="ignore")


def normalise_nfd(df: DataFrame, token: str = "token") -> DataFrame:
    """Canonical decomposition; meant for distinct-token tables, where it runs once per word."""
    return df.withColumn(token, _nfd(F.col(token)))
