"""Reproducible noise on token arrays: every decision is a hash of (seed, key, position)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .hashing import uniform
from .tokens import bind


def shuffle_nearby(tokens: Column, key: Column, seed: str, span: float) -> Column:
    """Tokens sorted by position plus noise in [0, span); the first token stays first."""
    scored = F.transform(
        tokens,
        lambda t, i: F.struct(
            (i + F.when(i == 0, F.lit(-1.0)).otherwise(uniform(seed, key, i) * span)).alias("score"),
            i.alias("i"), t.alias("t")))
    return F.transform(F.sort_array(scored), lambda s: s["t"])


def drop_tokens(tokens: Column, key: Column, seed: str, share: float) -> Column:
    """Random tokens removed; the token of smallest hash stays when all would go."""

    def build(all_tokens: Column) -> Column:
        scored = F.transform(all_tokens, lambda t, i: F.struct(uniform(seed, key, i).alias("u"), i.alias("i"), t.alias("t")))
        return bind(scored, lambda s: bind(
            F.filter(s, lambda x: x["u"] >= share),
            lambda kept: F.transform(
                F.when((F.size(kept) == 0) & (F.size(s) > 0), F.array(F.array_min(s))).otherwise(kept), lambda x: x["t"])))

    return bind(tokens, build)


def blank_tokens(tokens: Column, key: Column, seed: str, share: float, mask) -> Column:
    return F.transform(tokens, lambda t, i: F.when(uniform(seed, key, i) < share, F.lit(mask)).otherwise(t))


def add_noise(tokens: Column, key: Column, seed: str, span: float, drop: float, blank: float, mask) -> Column:
    """Shuffle, then drop, then blank."""
    out = shuffle_nearby(tokens, key, seed + "-shuffle", span) if span else tokens
    out = drop_tokens(out, key, seed + "-drop", drop) if drop else out
    return blank_tokens(out, key, seed + "-blank", blank, mask) if blank else out


def mask_for_prediction(ids: Column, key: Column, seed: str, share: float, mask: int, vocab_size: int,
                        padding: int, split=(0.8, 0.1, 0.1)) -> Column:
    """Array of struct(input, target): chosen ids become the mask, stay, or turn into a random id.

    The first position and padding are never chosen; ``target`` is null where
    nothing is to be predicted.
    """
    to_mask, to_keep, _ = split

    def cell(x: Column, i: Column) -> Column:
        fate = uniform(seed + "-fate", key, i)
        other = F.floor(uniform(seed + "-id", key, i) * vocab_size).cast("long")
        value = F.when(fate < to_mask, F.lit(mask).cast("long")).when(fate < to_mask + to_keep, x).otherwise(other)
        return bind((i > 0) & (x != padding) & (uniform(seed, key, i) <= share), lambda chosen: F.struct(
            F.when(chosen, value).otherwise(x).alias("input"), F.when(chosen, x).alias("target")))

    return F.transform(F.transform(ids, lambda x: x.cast("long")), cell)


def choose_weighted(ids: Column, weights: Column, key: Column, seed: str, share: float) -> Column:
    """Positions of ceil(share * n) ids drawn without replacement in proportion to their weights."""

    def pick(w: Column) -> Column:
        scored = F.transform(w, lambda x, i: F.struct((-F.log(1 - uniform(seed, key, i)) / x).alias("race"), i.alias("i")))
        count = F.ceil(F.size(w) * F.lit(share)).cast("int")
        return F.sort_array(F.transform(F.slice(F.sort_array(scored), 1, count), lambda s: s["i"]))

    return bind(weights, pick)


def mask_for_evaluation(tokens: Column, key: Column, seed: str, share: float, mask) -> Column:
    """Like masking for training, but every chosen token is masked and each row has at least one.

    The first position is never chosen unless it is the only one.
    """

    def build(t: Column) -> Column:
        draws = F.transform(t, lambda x, i: F.when(i > 0, uniform(seed, key, i)).otherwise(F.lit(2.0)))
        return bind(draws, lambda u: bind(
            F.array_min(u),
            lambda least: F.transform(
                t, lambda x, i: F.when((F.get(u, i) <= share) | ((least > share) & (F.get(u, i) == least)), F.lit(mask)).otherwise(x))))

    return bind(tokens, build)
