"""Vocabularies: counting, id assignment, lookup, pruning and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import placed_by, staged
from .ranking import with_global_position
from .tokentables import token_counts

FEW = 10_000  # longer top lists are cut by count before they are sorted
RANKED_AT_ONCE = 200_000  # a list that the caller cuts to at most this many rows is numbered by one window
FILTER_BITS, PROBES = 1 << 22, 3  # of the membership filter: half a megabyte whatever the vocabulary's size


def _by_count():
    return [F.col("n").desc(), F.col("token").asc()]


def top_tokens(counts: DataFrame, most: int) -> DataFrame:
    """The ``most`` most frequent tokens, ties by token.

    Every task offers up to ``most`` rows to the final cut. For a long list the
    counts are first reduced to those at or above the count of the last row,
    found from the histogram of counts, so the offers add up to little more
    than ``most`` rows.
    """
    if most > FEW:
        rows = F.sum("k").over(W.orderBy(F.col("n").desc()))  # one row per distinct count
        histogram = counts.groupBy("n").agg(F.count(F.lit(1)).alias("k")).withColumn("upto", rows)
        reached = histogram.where(F.col("upto") >= most).agg(F.max("n")).scalar()
        counts = counts.where(F.col("n") >= F.coalesce(reached, F.lit(0)))
    return counts.orderBy(*_by_count()).limit(most)


def assign_ids(counts: DataFrame, first_id: int, most: int | None = None) -> DataFrame:
    """Ids by falling count (ties by token) from ``first_id``; columns token, n, id."""
    if most is not None and most <= RANKED_AT_ONCE:
        rank = F.row_number().over(W.orderBy(*_by_count()))  # over at most `most` rows
        return top_tokens(counts, most).withColumn("id", rank.cast("long") - 1 + first_id)
    ranked = with_global_position(counts, _by_count(), "id")
    if most is not None:
        ranked = ranked.where(F.col("id") < most)
    return ranked.withColumn("id", F.col("id") + first_id)


def _places(value: Column, bits) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), value), bits) for i in range(PROBES)]


def membership_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> DataFrame:
    """One row: ``words``, the 64-bit words of a Bloom filter of the key column, built by aggregation."""
    places = keys.select(F.explode(F.array(*_places(F.col(key), F.lit(bits)))).alias("at"))
    marks = places.groupBy(F.shiftright("at", 6).alias("id")).agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("word"))
    every = keys.sparkSession.range(bits // 64).join(marks, "id", "left")
    return every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("word", F.lit(0)).alias("word")))).alias("e")).select(
        F.col("e.word").alias("words"))


def may_hold(keys_filter: DataFrame, value: Column, bits: int = FILTER_BITS) -> Column:
    """False only for values that are certainly no key; tested where the values are, as the filter comes with the task."""
    words = keys_filter.scalar()
    hits = [F.getbit(F.get(words, F.shiftright(at, 6).cast("int")), at.bitwiseAND(F.lit(63)).cast("int")) == 1
            for at in _places(value, F.lit(bits))]
    return hits[0] & hits[1] & hits[2]


def index(df: DataFrame, key: str, tokens: Column, vocab: DataFrame, unknown: int) -> DataFrame:
    """One row per ``key`` with the token ids in order; tokens outside the vocabulary become ``unknown``.

    The vocabulary has token, n and id. Rows are placed by key before they are
    taken apart, so with a broadcast vocabulary no token is shuffled.
    """
    exploded = placed_by(df, key).select(key, F.posexplode_outer(tokens).alias("pos", "token"))
    found = skewed_lookup(exploded, vocab.select("token", "n", "id"), "token", "n", "left")
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", F.coalesce("id", F.lit(unknown)).alias("id")))
    return found.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("e")).select(key, F.col("e.id").alias("ids"))


def ids_to_text(df: DataFrame, key: str, ids: Column, vocab: DataFrame, size: Column,
                own_vocab: str | None = None, begin: int = 2, end: int = 3, empty: str = "1") -> DataFrame:
    """Text of id sequences: begin marks skipped, stop at the first end mark.

    Ids from ``size`` on refer to the row's own vocabulary array, when given;
    other ids without a word stay as digits; an empty sequence gives ``empty``.
    """
    from ..functions.arrays import cut_at

    kept = F.filter(cut_at(ids, end), lambda i: i != begin)
    columns = [key] + ([own_vocab] if own_vocab else [])
    exploded = df.select(*columns, F.posexplode_outer(kept).alias("pos", "id"))
    found = skewed_lookup(exploded, vocab.select("id", "n", "token"), "id", "n", "left")
    own = F.get(F.col(own_vocab), (F.col("id") - size).cast("int")) if own_vocab else F.lit(None)
    word = F.coalesce("token", F.when(F.col("id") >= size, own), F.col("id").cast("string"))
    entry = F.when(F.col("pos").isNotNull(), F.struct("pos", word.alias("word")))
    joined = F.array_join(F.col("e.word"), " ")
    return (
        found.groupBy(key).agg(F.sort_array(F.collect_list(entry)).alias("e"))
        .select(key, F.when(F.size("e") > 0, joined).otherwise(F.lit(empty)).alias("text"))
    )


def finalise(counts: DataFrame, threshold: int, most: int, factor: int, filler: str = "madeupword{:04d}") -> DataFrame:
    """Frequent tokens only, at most ``most``, padded with filler rows to a multiple of ``factor``."""
    kept = assign_ids(counts.where(F.col("n") >= threshold), 0, most)
    total = kept.agg(F.count(F.lit(1)).alias("total"))
    missing = (factor - F.col("total") % factor) % factor
    names = F.array(*[F.lit(filler.format(i)) for i in range(max(factor - 1, 1))])
    fill = (
        total.select("total", F.posexplode(F.slice(names, 1, missing.cast("int"))).alias("i", "token"))
        .select("token", F.lit(0).cast("long").alias("n"), (F.col("total") + F.col("i")).alias("id"))
    )
    return kept.unionByName(fill)


def skewed_lookup(facts: DataFrame, lookup: DataFrame, key: str, weight: str, how: str = "inner",
                  hot: int = 1000) -> DataFrame:
    """Inner or left join on a key whose most frequent values repeat in a large part of the facts.

    The ``hot`` heaviest keys are looked up in a broadcast table of ``hot``
    rows, and a membership filter of fixed size finds most facts without any
    match. Both then carry a spread-out stand-in key that matches nothing, so
    the second lookup, by shuffle unless the table is small, has no heavy key
    left. The facts are read once; ``lookup`` must hold each key once. It is
    written first: three steps read it, and Spark plans the last by its bytes.
    """
    lookup = staged(lookup, "lookup")
    values = [c for c in lookup.columns if c != key]
    heavy = lookup.orderBy(F.col(weight).desc(), F.col(key)).limit(hot).select(
        F.col(key).alias("_hot_key"), F.struct(*values).alias("_hot"))
    first = facts.join(F.broadcast(heavy), F.col(key) == F.col("_hot_key"), "left")
    spread_over = F.pmod(F.xxhash64(*facts.columns), F.lit(65536))
    stand_in = F.concat(F.lit("\u0000"), spread_over.cast("string"))
    open_key = F.col("_hot_key").isNull() & may_hold(membership_filter(lookup, key), F.col(key).cast(lookup.schema[key].dataType))
    spread = first.withColumn("_key", F.when(open_key, F.col(key).cast("string")).otherwise(stand_in))
    rest = lookup.select(F.col(key).cast("string").alias("_cold_key"), F.struct(*values).alias("_cold"))
    joined = spread.join(rest, F.col("_key") == F.col("_cold_key"), "left").withColumn("_v", F.coalesce("_hot", "_cold"))
    if how == "inner":
        joined = joined.where(F.col("_hot_key").isNotNull() | F.col("_cold_key").isNotNull())
    elif how != "left":
        raise ValueError("how must be inner or left")
    return joined.select(*facts.columns, *[F.col(f"_v.{v}").alias(v) for v in values])


def corpus_counts(df: DataFrame, tokens: Column) -> DataFrame:
    return token_counts(df.select(tokens.alias("tokens")))
