"""Splits, shards, quotas and batches.

Everything that depends on a global order works on narrow (key, size) frames
through the helpers in ``ranking``; texts are joined back by key afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.hashing import key_hash, permuted, uniform
from ..session import durable
from .ranking import with_global_position, with_group_position, with_group_running_sum, with_running_sum


def keyed_split(df: DataFrame, key: Column, seed: str, test_share: float) -> DataFrame:
    """Adds ``split`` by key hash, so all columns of a row land on the same side."""
    return df.withColumn("split", F.when(uniform(seed, key) < test_share, "test").otherwise("train"))


def shuffled(df: DataFrame, key: str, seed: str) -> DataFrame:
    """Keys with their place in a reproducible shuffle."""
    hashed = df.select(key, key_hash(seed, F.col(key)).alias("_h"))
    return with_global_position(hashed, ["_h", key], "place").drop("_h")


def train_valid_test(df: DataFrame, key: str, seed: str, held_out: int, shards: int = 8, exact: bool = False) -> DataFrame:
    """(key, split, shard): ``held_out`` rows each for valid and test, the rest in train shards of equal size.

    Rows beyond the last full shard go to the last one; ``exact`` leaves them
    out instead, as in the known files.
    """
    placed = shuffled(df, key, seed)
    size = F.greatest(F.lit(1), F.floor((df.agg(F.count(F.lit(1))).scalar() - 2 * held_out) / shards))
    shard = F.floor((F.col("place") - 2 * held_out) / size)
    split = F.when(F.col("place") < held_out, "valid").when(F.col("place") < 2 * held_out, "test").otherwise("train")
    cut = placed.withColumn("split", split).withColumn(
        "shard", F.when(F.col("split") == "train", shard if exact else F.least(shard, F.lit(shards - 1))))
    return cut.where((F.col("split") != "train") | (F.col("shard") < shards)).drop("place")


def line_quota(files: DataFrame, group: str, order: str, lines: str, quota: int) -> DataFrame:
    """Lines taken from each file when files are read in order until the group has ``quota`` lines."""
    summed = with_group_running_sum(files.select(group, order, lines), group, [order], lines, "_upto")
    before = F.col("_upto") - F.col(lines)
    taken = F.least(F.col(lines), F.lit(quota) - before)
    return summed.withColumn("taken", taken).where((before < quota)).drop("_upto")


def smallest_group_cut(df: DataFrame, group: str, order: str) -> DataFrame:
    """The first rows of each group, as many as the smallest group has."""
    placed = with_group_position(df.select(group, order), group, [order], "place")
    smallest = placed.groupBy(group).agg(F.count(F.lit(1)).alias("n")).agg(F.min("n")).scalar()
    return placed.where(F.col("place") < smallest)


def token_batches(df: DataFrame, key: str, length: str, budget: int) -> DataFrame:
    """(key, batch): rows by length, a new batch whenever the running length passes a budget multiple.

    Batch numbers that would be skipped are closed up. A batch holds about
    ``budget`` tokens, so the join on the batch number is even.
    """
    summed = with_running_sum(df.select(key, length), [length, key], length, "_sum")
    cut = summed.withColumn("_batch", F.floor(F.col("_sum") / budget))
    numbered = with_global_position(cut.select("_batch").distinct(), ["_batch"], "batch")
    return cut.join(numbered, "_batch").drop("_batch", "_sum")


def even_batches(df: DataFrame, key: str, order: list, size: int) -> DataFrame:
    """(key, batch): ceil(n/size) batches in order, sizes differing by at most one, larger ones first."""
    placed = with_global_position(df, order, "_place")
    n = df.agg(F.count(F.lit(1))).scalar()
    batches = F.ceil(n / size)
    small, larger = F.floor(n / batches), n % batches
    edge = larger * (small + 1)
    batch = F.when(F.col("_place") < edge, F.floor(F.col("_place") / (small + 1))).otherwise(
        larger + F.floor((F.col("_place") - edge) / F.greatest(small, F.lit(1))))
    return placed.withColumn("batch", batch.cast("long")).drop("_place")


def sorted_batches(df: DataFrame, order: list, size: int, seed: str) -> DataFrame:
    """Batches of ``size`` rows in sort order, and the batches' places in a shuffle of batches."""
    placed = with_global_position(df, order, "_place").withColumn("batch", F.floor(F.col("_place") / size))
    return placed.drop("_place").join(shuffled(placed.select("batch").distinct(), "batch", seed), "batch")


def cap_batches(batched: DataFrame, batch: str, key: str, seed: str, cap: int) -> DataFrame:
    """At most ``cap`` random rows of each batch; batches are bounded, so the window is too."""
    rank = F.row_number().over(W.partitionBy(batch).orderBy(key_hash(seed, F.col(key)), key))
    return batched.withColumn("_rank", rank).where(F.col("_rank") <= cap).drop("_rank")


def worker_ranges(df: DataFrame, key: str, workers: int, exact: bool = False) -> DataFrame:
    """(key, worker): contiguous ranges in key order whose sizes differ by at most one, the larger ones first.

    With ``exact`` all ranges are equal and the remainder is left out.
    """
    placed = with_global_position(df.select(key), [key], "_place")
    count = df.agg(F.count(F.lit(1))).scalar()
    size = F.greatest(F.lit(1), F.floor(count / workers))
    if exact:
        return placed.withColumn("worker", F.floor(F.col("_place") / size)).where(F.col("worker") < workers).drop("_place")
    larger = F.pmod(count, F.lit(workers))
    first = larger * (F.floor(count / workers) + 1)
    worker = F.when(F.col("_place") < first, F.floor(F.col("_place") / (F.floor(count / workers) + 1))).otherwise(
        larger + F.floor((F.col("_place") - first) / size))
    return placed.withColumn("worker", worker).drop("_place")


def stream_batches(df: DataFrame, key: str, tokens: str, streams: int, steps: int, end: str = "</s>", subsample: int = 1,
                   seed: str | None = None) -> DataFrame:
    """(batch, stream, tokens) of the corpus laid out as parallel token streams.

    With ``subsample`` k only the first n/k of the n batches are made, for
    evaluation. A ``seed`` adds ``place``: when each of them is served.

    All texts, each closed by an end mark, form one stream that is padded in
    front and cut into ``streams`` columns. A batch is ``steps`` rows of all
    columns; each column starts with one end mark and loses its last token.
    Text offsets come from a running sum over texts, and every text is cut into
    its pieces of a (batch, stream) cell at once, so pieces are shuffled, not
    tokens, and a cell collects at most ``steps`` tokens.
    """
    closed = df.select(key, F.array_append(F.col(tokens), F.lit(end)).alias("_t")).withColumn("_n", F.size("_t").cast("long"))
    sizes = durable(closed.select(key, "_n"))
    summed = with_running_sum(sizes, [key], "_n", "_upto", costly=False).select(key, (F.col("_upto") - F.col("_n")).alias("_start"))
    total = sizes.agg(F.sum("_n")).scalar()
    batches = F.ceil(total / (streams * steps))
    front = batches * steps * streams - total  # fewer than streams * steps end marks
    placed = closed.join(summed, key).select((F.col("_start") + front).alias("_start"), "_t", "_n")
    padding = df.sparkSession.range(1).select(
        F.lit(0).cast("long").alias("_start"), F.array_repeat(F.lit(end), front.cast("int")).alias("_t"), front.alias("_n"))
    # one place is lost to the leading end mark, so token i of the padded stream is at place i + 1;
    # the place at which a column starts belongs to that mark
    runs = placed.unionByName(padding.where(F.col("_n") > 0)).withColumn("_batches", batches)

    def piece(cell: Column) -> Column:
        taken = (cell % F.col("_batches") == 0) & (F.col("_start") + 1 <= cell * steps)
        first = F.greatest(F.col("_start") + 1, cell * steps) + F.when(taken, 1).otherwise(0)
        last = F.least(F.col("_start") + F.col("_n"), (cell + 1) * steps - 1)
        length = F.greatest(last - first + 1, F.lit(0)).cast("int")
        return F.struct(cell.alias("cell"), (first % steps).alias("step"),
                        F.slice("_t", (first - F.col("_start")).cast("int"), length).alias("tokens"))

    cells = F.sequence(F.floor((F.col("_start") + 1) / steps), F.floor((F.col("_start") + F.col("_n")) / steps))
    pieces = runs.select("_batches", F.explode(F.transform(cells, piece)).alias("p")).select(
        (F.col("p.cell") % F.col("_batches")).alias("batch"), F.floor(F.col("p.cell") / F.col("_batches")).alias("stream"),
        "p.step", "p.tokens").where(F.col("stream") < streams)
    served = F.floor(batches / subsample)
    heads = df.sparkSession.range(streams).select(
        F.lit(0).cast("long").alias("batch"), F.col("id").alias("stream"), F.lit(0).cast("long").alias("step"), F.array(F.lit(end)).alias("tokens"))
    gathered = F.sort_array(F.collect_list(F.struct("step", "tokens")))
    cells = pieces.where(F.size("tokens") > 0).unionByName(heads)
    if subsample > 1:
        cells = cells.where(F.col("batch") < served)
    laid = cells.groupBy("batch", "stream").agg(gathered.alias("g")).select("batch", "stream", F.flatten("g.tokens").alias("tokens"))
    if seed is None:
        return laid
    return laid.withColumn("_served", served).withColumn("place", permuted(F.col("batch"), F.col("_served"), seed)).drop("_served")


def last_numbered(names: DataFrame, name: str, pattern: str, n: int, upper: int | None = None) -> DataFrame:
    """The ``n`` names with the largest number; fails when fewer match."""
    numbered = names.select(name, F.regexp_extract(name, f"^{pattern}$", 1).alias("_d")).where(F.col("_d") != "")
    numbered = numbered.select(name, F.col("_d").cast("long").alias("number"))
    if upper is not None:
        numbered = numbered.where(F.col("number") <= upper)
    found = numbered.orderBy(F.col("number").desc(), name).limit(n)
    enough = found.agg(F.count(F.lit(1))).scalar() >= n
    message = F.lit(f"fewer than {n} names match {pattern}")
    return found.withColumn("number", F.when(enough, F.col("number")).otherwise(F.raise_error(message).cast("long")))


def weighted_draws(weights: DataFrame, name: str, weight: str, draws: int, seed: str) -> DataFrame:
    """(draw, name): ``draws`` names drawn with replacement in proportion to their weight.

    The upper bounds, one per name, are one array; each draw takes the first
    bound above it, so draws are worked on wherever they are.
    """
    share = F.col(weight) / weights.agg(F.sum(weight)).scalar()
    upto = F.sum(share).over(W.orderBy(name).rowsBetween(W.unboundedPreceding, 0))
    listed = weights.select(F.struct(upto.alias("upto"), F.col(name).alias("name")).alias("b"))
    bounds = listed.agg(F.sort_array(F.collect_list("b")).alias("_bounds")).scalar()
    drawn = weights.sparkSession.range(draws).select(F.col("id").alias("draw"), uniform(seed, F.col("id")).alias("_at"), bounds.alias("_bounds"))
    above = F.filter("_bounds", lambda b: b["upto"] > F.col("_at"))
    picked = F.coalesce(F.get(above, F.lit(0))["name"], F.element_at("_bounds", -1)["name"])  # rounding may leave the last bound below 1
    return drawn.select("draw", picked.alias(name))
