"""Reproducible pseudo-random numbers: a function of seed and key, never of task order."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

TWO_32 = 4294967296.0


def key_hash(seed: str, *keys: Column) -> Column:
    return F.md5(F.concat_ws("|", F.lit(seed), *[k.cast("string") for k in keys]).cast("binary"))


def uniform(seed: str, *keys: Column) -> Column:
    """Number in [0, 1) from the first 32 bits of the key hash."""
    return F.conv(F.substring(key_hash(seed, *keys), 1, 8), 16, 10).cast("long") / F.lit(TWO_32)


def permuted(number: Column, size: Column, seed: str, rounds: int = 64) -> Column:
    """Place of ``number`` in a keyed shuffle of 0 .. size - 1, without a sort: any row finds its own place.

    Swap-or-not: a round pairs every number with its mirror about a key and
    swaps the pair or not by a hash of its larger one, so each round, and with
    it the whole, maps the range one to one onto itself.
    """
    def turn(x: Column, r: Column) -> Column:
        mirror = (F.conv(F.substring(key_hash(seed, F.lit("k"), r), 1, 12), 16, 10).cast("long") % size - x + size) % size
        swap = F.conv(F.substring(key_hash(seed, r, F.greatest(x, mirror)), 1, 1), 16, 10).cast("int") % 2 == 1
        return F.when(swap, mirror).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), number.cast("long"), turn)
