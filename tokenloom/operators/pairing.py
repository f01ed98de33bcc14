"""Joins that line up parallel material."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .ranking import with_global_position


def next_turn_pairs(turns: DataFrame, first_role: str = "user", second_role: str = "assistant") -> DataFrame:
    """Turn and the turn right after it, as (conv_id, turn, src, tgt).

    An equi-join on (conversation, turn): unlike a window it does not put one
    long conversation into a single task.
    """
    first = turns.where(F.col("role") == first_role).select("conv_id", "turn", F.col("text").alias("src"))
    second = turns.where(F.col("role") == second_role).select(
        "conv_id", (F.col("turn") - 1).alias("turn"), F.col("text").alias("tgt"))
    return first.join(second, ["conv_id", "turn"])


def zip_lines(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Positional zip of two line tables on their keys and line number."""
    return left.join(right, [*keys, "line_no"], how)


def key_mismatches(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys present on one side only, with the side that has them."""
    only_left = left.select(key).join(right.select(key), key, "left_anti").withColumn("side", F.lit("left"))
    only_right = right.select(key).join(left.select(key), key, "left_anti").withColumn("side", F.lit("right"))
    return only_left.unionByName(only_right)


def replace_mismatches(rows: DataFrame, mismatch: Column, order: list, replacements: DataFrame,
                       replacement_order: list) -> DataFrame:
    """The n-th mismatching row gets the n-th replacement row's columns."""
    bad = with_global_position(rows.where(mismatch), order, "nth")
    spare = with_global_position(replacements, replacement_order, "nth")
    return bad.join(spare, "nth", "left")


def dictionary_differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows whose token or count differ between two (token, n, id) dictionaries."""
    a, b = left.alias("a"), right.alias("b")
    same = F.col("a.token").eqNullSafe(F.col("b.token")) & F.col("a.n").eqNullSafe(F.col("b.n"))
    return (
        a.join(b, F.col("a.id") == F.col("b.id"), "full").where(~same)
        .select(F.coalesce("a.id", "b.id").alias("id"), F.col("a.token").alias("left_token"),
                F.col("b.token").alias("right_token"))
    )
