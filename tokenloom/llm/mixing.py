"""Mixing sources to target weights by temperature, realised as budgeted block permutations.

Source weights are token shares to the power of an exponent between 0 (all
sources alike) and 1 (as they are). The exponent is the smallest that leaves the
entropy at or below a share of its maximum, and repeats no source more often
than a limit; both fall as it rises, so it is found by nested intervals. One pass
over the source totals tries ``GRID`` exponents at once; the driver sees their
sums only.

A source with weight w gets floor(w * budget) tokens: whole passes over its
documents, then the start of one more pass. Each pass is a permutation of its
own, by a hash of seed, pass and document. To cut the last pass at its budget,
documents lie in blocks of equal hash ranges; blocks before the cut go whole, and
only the block that the cut falls into is summed document by document. So no
source, however large, is sorted in one place. ``place`` (0 to 1) orders the
mixed stream: every stretch of it has the target weights.

Defined results: a null source is a source of its own. Null and blank texts hold
no tokens; they go with the block or the documents before them. A source without
tokens has weight 0 and no rows. Rows without key, or that repeat a key, are
taken as documents of their own; equal hashes are cut together. Other columns
are carried along whatever their names; only ``epoch`` and ``place`` are replaced.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import discard, staged

GRID, ROUNDS, DIGITS = 32, 6, 7  # 33**6 intervals, far finer than the digits kept
BLOCK_DOCS = 50_000
HASH_RANGE = 1 << 60
WORD = r"[^\x20\x09-\x0D]+"


def hashed(seed: int, turn: Column, key: Column) -> Column:
    """60 bits of the MD5 of seed, pass and key."""
    text = F.concat_ws(":", F.lit(str(seed)), turn.cast("string"), F.coalesce(key.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text.cast("binary")), 1, 15), 16, 10).cast("bigint")


def exponent(totals: DataFrame, entropy_share: float, repeats: float, budget: float | None = None) -> float:
    """Smallest exponent in [0, 1] that meets both limits; 1 if none does. ``totals`` has one row per source: tokens."""
    low, high = 0.0, 1.0
    facts = totals.agg(F.sum("tokens"), F.count(F.lit(1))).first()
    corpus, sources = float(facts[0] or 0), facts[1]
    if sources < 2:
        return 1.0
    budget = budget or corpus
    limit = entropy_share * math.log(sources)
    for _ in range(ROUNDS):
        tried = [low + (high - low) * i / GRID for i in range(GRID + 1)]
        share = F.col("tokens") / corpus
        sums = totals.agg(*[F.sum(F.pow(share, F.lit(a))).alias(f"z{i}") for i, a in enumerate(tried)],
                          *[F.sum(F.pow(share, F.lit(a)) * F.log(share) * a).alias(f"l{i}") for i, a in enumerate(tried)],
                          *[F.max(F.pow(share, F.lit(a - 1))).alias(f"r{i}") for i, a in enumerate(tried)]).first()
        meets = [math.log(sums[f"z{i}"]) - sums[f"l{i}"] / sums[f"z{i}"] <= limit
                 and sums[f"r{i}"] / sums[f"z{i}"] * budget / corpus <= repeats for i in range(GRID + 1)]
        first = meets.index(True) if True in meets else GRID
        if first == 0:
            return tried[0]
        low, high = tried[first - 1], tried[first]
    return round(high, DIGITS)


def mix(docs: DataFrame, entropy_share: float = 0.97, repeats: float = 2.0, budget: int | None = None, seed: int = 17,
        key: str = "doc_id", source: str = "source", text: str = "text") -> DataFrame:
    """The rows of the mixed stream: the documents' columns, epoch (0 for the first pass) and place."""
    tokens = F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("tokens")
    rows = staged(docs.select(F.col(key).alias("_key"), F.col(source).alias("_source"), tokens), "mixing-sizes")
    totals = staged(rows.groupBy("_source").agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("docs"))
                    .where("tokens > 0"), "mixing-totals")
    power = exponent(totals, entropy_share, repeats, budget)
    facts = totals.agg(F.sum("tokens"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(power)))).first()
    corpus, norm = facts[0] or 0, facts[1] or 1.0
    quota = F.floor(F.pow(F.col("tokens").cast("double"), F.lit(power)) / norm * float(budget or corpus)).cast("bigint")
    plan = staged(
        totals.select("_source", F.col("tokens").alias("total"), quota.alias("quota"),
                      F.greatest(F.lit(1), F.ceil(F.col("docs") / BLOCK_DOCS)).cast("bigint").alias("blocks"))
        .withColumn("whole", F.floor(F.col("quota") / F.col("total")).cast("int"))
        .withColumn("rest", F.col("quota") - F.col("whole") * F.col("total")), "mixing-plan")

    same = F.col("p._source").eqNullSafe(F.col("d._source"))
    last = (rows.alias("d").join(plan.alias("p"), same).where("rest > 0")
            .withColumn("hash", hashed(seed, F.col("whole"), F.col("_key")))
            .withColumn("block", F.floor(F.col("hash") / F.lit(float(HASH_RANGE)) * F.col("blocks")).cast("bigint"))
            .select("d._source", "_key", "d.tokens", "hash", "block", "rest"))
    before = W.partitionBy("_source").orderBy("block").rowsBetween(W.unboundedPreceding, W.currentRow)  # one row a block
    blocks = (last.groupBy("_source", "block", "rest").agg(F.sum("tokens").alias("n"))
              .withColumn("upto", F.sum("n").over(before)).withColumn("from", F.col("upto") - F.col("n")))
    crossed = blocks.where("upto > rest and from <= rest")
    inside = W.partitionBy("d._source", "d.block").orderBy("hash")  # rows of equal hash share their sum
    cut = (last.alias("d").join(crossed.alias("b"), F.col("d._source").eqNullSafe(F.col("b._source")) & (F.col("d.block") == F.col("b.block")))
           .withColumn("sum", F.col("from") + F.sum("d.tokens").over(inside)).where(F.col("sum") <= F.col("d.rest"))
           .groupBy("d._source").agg(F.max("hash").alias("upto_hash")))
    ends = blocks.groupBy("_source").agg(F.max(F.when(F.col("upto") <= F.col("rest"), F.col("block"))).alias("last_block"))
    limits = staged(
        plan.alias("p").join(ends.alias("e"), F.col("p._source").eqNullSafe(F.col("e._source")), "left")
        .join(cut.alias("c"), F.col("p._source").eqNullSafe(F.col("c._source")), "left")
        .select("p.*", F.coalesce("last_block", F.lit(-1)).alias("last_block"), F.coalesce("upto_hash", F.lit(-1)).alias("upto_hash")),
        "mixing-limits")
    discard(rows, totals, plan)

    own = [c for c in docs.columns if c.lower() not in ("epoch", "place")]
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in own]).alias("doc"), F.col(key).alias("_key"), F.col(source).alias("_of"))
    turns = (whole.join(limits, F.col("_of").eqNullSafe(F.col("_source")))
             .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("whole"))))
             .withColumn("hash", hashed(seed, F.col("epoch"), F.col("_key")))
             .withColumn("block", F.floor(F.col("hash") / F.lit(float(HASH_RANGE)) * F.col("blocks")).cast("bigint")))
    taken = turns.where((F.col("epoch") < F.col("whole")) | (F.col("rest") > 0) & (
        (F.col("block") <= F.col("last_block")) | (F.col("hash") <= F.col("upto_hash"))))
    place = (F.col("epoch") + F.col("hash") / F.lit(float(HASH_RANGE))) * F.col("total") / F.col("quota")
    return taken.select("doc.*", "epoch", F.least(F.lit(1.0), place).alias("place"))
