"""Corpus statistics. Tokens are counted per (group, token) first, so neither a
frequent token nor a large group puts more than partial sums into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import staged
from .tokentables import one_row_each


def two_digits(value: Column) -> Column:
    """Two decimals, rounding the exact binary value half to even, as the reported figures are."""
    return F.replace(F.format_number(value, 2), F.lit(","), F.lit("")).cast("double")


def corpus_statistics(df: DataFrame, group: str, tokens: Column) -> DataFrame:
    """Records, tokens, unique tokens and mean length per group and for the full set.

    ``unique_tokens`` of the full set is the sum over groups (the reported
    figure); ``unique_union`` counts each token once.
    """
    sized = df.select(group, tokens.alias("t"))
    records = sized.groupBy(group).agg(F.count(F.lit(1)).alias("records"))
    # written once: the texts are tokenised a single time for all figures below
    per_token = staged(
        one_row_each(sized, [group], "t", "token").groupBy(group, "token").agg(F.count(F.lit(1)).alias("n")), "corpus-tokens")
    tokens_by_group = per_token.groupBy(group).agg(F.sum("n").alias("tokens"), F.count(F.lit(1)).alias("unique_tokens"))
    rows = (
        records.join(tokens_by_group, group, "left")
        .select(group, "records", F.coalesce("tokens", F.lit(0)).alias("tokens"),
                F.coalesce("unique_tokens", F.lit(0)).alias("unique_tokens"))
        .withColumn("unique_union", F.col("unique_tokens"))
    )
    union_size = per_token.select("token").distinct().agg(F.count(F.lit(1)).alias("u")).scalar()
    full = rows.agg(
        F.lit("Fullset").alias(group), F.sum("records").alias("records"), F.sum("tokens").alias("tokens"),
        F.sum("unique_tokens").alias("unique_tokens"),
    ).withColumn("unique_union", union_size)
    return rows.unionByName(full).withColumn("mean_length", two_digits(F.col("tokens") / F.col("records")))


def document_frequency(df: DataFrame, key: str, tokens: Column, min_df: int, stop_words: list[str]) -> DataFrame:
    """(token, df, n) of tokens in at least ``min_df`` texts, stop words left out; one row per ``key``.

    A text's tokens are sorted inside its row, where the first of each run counts for ``df``, so that the only
    shuffle is that of sums per token.
    """
    in_order = df.select(key, F.sort_array(tokens).alias("_sorted"))
    flagged = in_order.select(F.explode_outer(F.transform("_sorted", lambda t, i: F.struct(
        t.alias("token"), (~t.eqNullSafe(F.get("_sorted", i - 1))).cast("long").alias("first")))).alias("_t"))
    return (
        flagged.select("_t.*").where(~F.col("token").isin(stop_words))
        .groupBy("token").agg(F.sum("first").alias("df"), F.count(F.lit(1)).alias("n"))
        .where(F.col("df") >= min_df)
    )


def relative_weights(counts: DataFrame, most: int) -> DataFrame:
    """The most frequent terms with their count relative to the largest."""
    top = counts.orderBy(F.col("n").desc(), F.col("token")).limit(most)
    return top.withColumn("weight", F.col("n") / counts.agg(F.max("n")).scalar())


def length_histogram(df: DataFrame, group: str, length: Column, width: int) -> DataFrame:
    """Rows per (group, bin) and the bin's share of its group."""
    bins = df.groupBy(group, F.floor(length / width).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(W.partitionBy(group))  # bins of one group, not its rows
    return bins.withColumn("share", share)


def length_sketches(df: DataFrame, group: str, length: Column, k: int = 400) -> DataFrame:
    """(group, n, sketch): a mergeable quantile sketch of the lengths of each group.

    A KLL sketch of parameter ``k`` has a fixed size; ranks are off by about
    1.7 / k of the rows at 99 % confidence, and exact up to ``k`` rows.
    Sketches of parts merge (``F.kll_merge_agg_bigint``), so a group is never
    sorted and days can be added to a running total.
    """
    rows = df.select(group, length.cast("long").alias("_l")).where(F.col("_l").isNotNull())
    return rows.groupBy(group).agg(F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_bigint("_l", k).alias("sketch"))


def quantile_edges(sketches: DataFrame, bins: int) -> DataFrame:
    """One row: ``edges`` of bins that hold about equal shares of all groups together."""
    whole = sketches.agg(F.kll_merge_agg_bigint("sketch").alias("sketch"))
    quantiles = F.array(*[F.kll_sketch_get_quantile_bigint("sketch", F.lit(i / bins)) for i in range(bins + 1)])
    return whole.select(F.array_sort(F.array_distinct(quantiles)).alias("edges"))


def length_density(df: DataFrame, group: str, length: Column, edges: DataFrame) -> DataFrame:
    """(group, low, high, n, density) over bins ``low <= length < high`` (the last one closed) of one row of edges.

    The density times the bin's width is the bin's share of its group, so bins of
    different widths and groups of different sizes compare. Lengths outside the
    edges count in the first or last bin.
    """
    cuts = edges.scalar()
    rows = df.select(group, length.cast("long").alias("_l"), cuts.alias("_e")).where(F.col("_l").isNotNull())
    above = F.size(F.filter("_e", lambda e: e <= F.col("_l")))
    at = F.greatest(F.lit(1), F.least(above, F.size("_e") - 1))
    placed = rows.select(group, F.get("_e", at - 1).alias("low"), F.coalesce(F.get("_e", at), F.get("_e", at - 1)).alias("high"))
    bins = placed.groupBy(group, "low", "high").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(W.partitionBy(group))  # bins of one group, not its rows
    return bins.withColumn("density", share / F.greatest(F.col("high") - F.col("low"), F.lit(1)))


def weighted_mean(df: DataFrame, group: list[str], value: Column, weight: Column) -> DataFrame:
    return df.groupBy(*group).agg((F.sum(value * weight) / F.sum(weight)).alias("mean"))


def sampling_weights(df: DataFrame, group: str, factor: float) -> DataFrame:
    """Share of each group raised to ``factor`` and normalised again."""
    counts = df.groupBy(group).agg(F.count(F.lit(1)).alias("n"))
    share = counts.withColumn("p", F.col("n") / counts.agg(F.sum("n")).scalar())
    raised = share.withColumn("raised", F.pow("p", F.lit(factor)))
    return raised.withColumn("weight", F.col("raised") / raised.agg(F.sum("raised")).scalar())


def attempt_tally(attempts: DataFrame, key: str, order: list[str], status: str, success: str) -> tuple[DataFrame, DataFrame]:
    """(result per key, successes per attempt number).

    The result is the first success, else the status of the first attempt. The
    number of the deciding attempt is a count of earlier attempts, so a key
    with very many attempts needs no window.
    """
    failed = F.when(F.col(status) == success, 0).otherwise(1)
    moment = F.struct(*order)
    results = attempts.groupBy(key).agg(
        F.min_by(status, F.struct(failed, moment)).alias("result"),
        F.min(F.when(F.col(status) == success, moment)).alias("first_success"),
    )
    winners = results.where(F.col("first_success").isNotNull()).select(key, "first_success")
    earlier = (
        attempts.select(key, moment.alias("at")).join(winners, key)
        .where(F.col("at") < F.col("first_success")).groupBy(key).agg(F.count(F.lit(1)).alias("tries_before"))
    )
    beams = (
        winners.join(earlier, key, "left")
        .groupBy(F.coalesce("tries_before", F.lit(0)).alias("attempt")).agg(F.count(F.lit(1)).alias("successes"))
    )
    return results.select(key, "result"), beams


def tally(results: DataFrame, statuses: list[str], success: str, missing: str) -> DataFrame:
    """One row: results per status, total, evaluated total, and accuracy."""
    counts = [F.count_if(F.col("result") == s).alias(s) for s in statuses]
    evaluated = F.count_if(F.col("result") != missing)
    return results.agg(
        *counts, F.count(F.lit(1)).alias("total"), evaluated.alias("total_evaluated"),
        (F.count_if(F.col("result") == success) / F.greatest(evaluated, F.lit(1))).alias("accuracy"),
    )


def uneven_parameters(params: DataFrame, model: str, name: str) -> DataFrame:
    """(name, models): parameters that some models hold and others do not; empty if the models can be averaged."""
    pairs = params.select(F.col(model).alias("model"), F.col(name).alias("name")).distinct()
    models = pairs.agg(F.count_distinct("model")).scalar()
    return pairs.groupBy("name").agg(F.count(F.lit(1)).alias("models")).where(F.col("models") < models)


def parameter_mean(params: DataFrame, name: str, values: str) -> DataFrame:
    """Element-wise mean of the parameter arrays that share a name."""
    cells = params.select(name, F.posexplode(values).alias("pos", "value"))
    return cells.groupBy(name, "pos").agg(F.avg(F.col("value").cast("double")).alias("value"))


def parameter_moving_mean(params: DataFrame, name: str, order: str, values: str, decay: float) -> DataFrame:
    """Exponential moving average per name, oldest first, newest weighing most.

    The recurrence y = x*decay + y*(1-decay) unrolls to fixed weights
    decay*(1-decay)^k with k = 0 for the newest; the oldest has no leading decay.
    """
    from .ranking import with_group_position

    ages = with_group_position(params.select(name, order), name, [F.col(order).desc()], "age")
    oldest = ages.groupBy(name).agg(F.max("age").alias("last"))
    weight = F.pow(F.lit(1.0 - decay), F.col("age").cast("double")) * F.when(F.col("age") == F.col("last"), 1.0).otherwise(decay)
    weights = ages.join(oldest, name).select(order, weight.alias("weight"))
    cells = params.join(weights, order).select(name, "weight", F.posexplode(values).alias("pos", "value"))
    return cells.groupBy(name, "pos").agg(F.sum(F.col("value").cast("double") * F.col("weight")).alias("value"))
