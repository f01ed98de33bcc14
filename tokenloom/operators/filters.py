"""Row filters. Sizes and classes are Column arguments, so predicates stay in one scan."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as T
from ..functions.tokens import words


def corpus_files(files: DataFrame, binary: Column, path: Column, suffix: str) -> DataFrame:
    return files.where(~binary & path.endswith(suffix))


def min_distinct(df: DataFrame, names: Column, least: int = 2) -> DataFrame:
    return df.where(F.size(F.array_distinct(names)) >= least)


def longer_than(df: DataFrame, text: Column, chars: int = 3) -> DataFrame:
    return df.where(F.length(text) > chars)


def not_blank(df: DataFrame, text: Column) -> DataFrame:
    return df.where(text.isNotNull() & (F.length(text) > 0))


def quarantine(df: DataFrame, failed: Column) -> tuple[DataFrame, DataFrame]:
    """(good rows, failed rows); a null verdict counts as failed."""
    bad = F.coalesce(failed, F.lit(True))
    return df.where(~bad), df.where(bad)


def same_length(df: DataFrame, left: Column, right: Column) -> DataFrame:
    return df.where(F.size(left) == F.size(right))


def drop_empty(df: DataFrame, *sequences: Column) -> DataFrame:
    return df.where(reduce(lambda a, b: a & b, [F.size(s) > 0 for s in sequences]))


def drop_long(df: DataFrame, max_len: int, *sequences: Column) -> DataFrame:
    """Keeps rows whose sequences all have at most ``max_len`` items; 0 keeps everything."""
    if max_len < 0:
        raise ValueError("max_len must not be negative")
    if max_len == 0:
        return df
    return df.where(reduce(lambda a, b: a & b, [F.size(s) <= max_len for s in sequences]))


def within(sizes: list[Column], limits: list[int | None]) -> Column:
    """All sizes at most their limit; a missing size or limit passes."""
    checks = [F.coalesce(s <= F.lit(m), F.lit(True)) for s, m in zip(sizes, limits) if m is not None]
    return reduce(lambda a, b: a & b, checks, F.lit(True))


def class_and_size(df: DataFrame, label: Column, excluded: int, sizes: list[Column],
                   limits: list[int | None]) -> DataFrame:
    return df.where((label != excluded) & within(sizes, limits))


def modern_python(df: DataFrame, code: Column) -> DataFrame:
    """Drops code with any mark of the older dialect."""
    old = [code.rlike(p) for p in T.PYTHON2_PATTERNS] + [F.contains(code, F.lit(p)) for p in T.PYTHON2_PHRASES]
    return df.where(~reduce(lambda a, b: a | b, old))


def enough_words(df: DataFrame, text: Column, least: int) -> DataFrame:
    return df.where(T.word_chars(text) >= least)


def at_most_sentences(df: DataFrame, text: Column, separator: str, most: int) -> DataFrame:
    return df.where(F.size(F.split(text, separator)) <= most)


def without_specials(ids: Column, unknown: int, reserved: int) -> Column:
    """Drops reserved ids other than the unknown id from a sequence."""
    return F.filter(ids, lambda i: (i >= reserved) | (i == unknown))


def nonempty_tokens(df: DataFrame, text: Column) -> DataFrame:
    return df.where(F.size(words(text)) > 0)
