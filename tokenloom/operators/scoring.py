"""Overlap scores of predictions against references.

A prediction table has one row per id: ``id``, ``hyp`` (text) and ``refs``
(array of texts). Texts are shuffled by id once and sorted by it; n-grams are
made and counted after that, one id at a time, so memory is in proportion to the
texts of one id. Rows that repeat an id are counted together.
All scores are sums of per-id statistics, which merge in any order.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain, groupby, islice

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from ..functions import text as T, tokens as K
from ..session import placed_by

ORDERS = (1, 2, 3, 4)


ROWS_AT_ONCE = 200  # rows whose texts are Python strings at a time
ROWS_OUT = 20_000  # rows handed back at a time


def _texts_by_id(predictions: DataFrame) -> DataFrame:
    """(id, hyp_len, lens, hyp, refs) in order of id in each partition, the tokens of a text joined by one space."""
    rows = placed_by(predictions.select("id", "hyp", "refs"), "id").sortWithinPartitions("id")
    tokens = rows.select("id", K.words(F.col("hyp")).alias("h"), F.transform("refs", K.words).alias("r"))
    return tokens.select(
        "id", F.size("h").cast("long").alias("hyp_len"), F.transform("r", F.size).alias("lens"),
        F.array_join("h", " ").alias("hyp"), F.transform("r", lambda t: F.array_join(t, " ")).alias("refs"))


def _add_grams(counts: list[Counter], text: str | None, orders) -> None:
    tokens = text.split(" ") if text else []
    for counter, n in zip(counts, orders):
        counter.update(zip(*[tokens[i:] for i in range(n)]))


def _counted(batches: Iterator[pa.RecordBatch], orders) -> Iterator[tuple]:
    """For each id: its rows' lengths, and by order the n-gram counts of the prediction and of each reference."""
    rows = (row for batch in batches for low in range(0, batch.num_rows, ROWS_AT_ONCE)
            for row in zip(*(column.to_pylist() for column in batch.slice(low, ROWS_AT_ONCE).columns)))
    for key, group in groupby(rows, key=lambda row: row[0]):
        sizes, hyp, refs = [], [Counter() for _ in orders], []
        for _, hyp_len, lens, text, others in group:
            sizes.append((hyp_len, lens))
            if others is None:
                continue
            _add_grams(hyp, text, orders)
            for place, other in enumerate(others):
                if place == len(refs):
                    refs.append([Counter() for _ in orders])
                _add_grams(refs[place], other, orders)
        yield key, sizes, hyp, list(zip(*refs)) or [()] * len(hyp)


def _batches(rows: Iterator[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    while block := list(islice(rows, ROWS_OUT)):
        yield pa.RecordBatch.from_arrays([pa.array(column, field.type) for column, field in zip(zip(*block), schema)], schema=schema)


def _clipped(own: Counter, refs: tuple[Counter, ...]) -> int:
    """N-grams that occur in a reference, each counted at most as often as in any one of them."""
    most: dict[tuple, int] = {}
    for ref in refs:
        for gram in own.keys() & ref.keys():
            most[gram] = max(most.get(gram, 0), ref[gram])
    return sum(min(own[gram], n) for gram, n in most.items())


def ngram_counts(predictions: DataFrame, orders=ORDERS) -> DataFrame:
    """(id, order, gram, hyp_n, ref_n) with ref_n the largest count in any one reference."""
    schema = StructType([
        predictions.schema["id"], StructField("order", IntegerType()), StructField("gram", StringType()),
        StructField("hyp_n", LongType()), StructField("ref_n", LongType())])
    arrow = to_arrow_schema(schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _batches((
            (key, n, " ".join(gram), own.get(gram, 0), max((ref.get(gram, 0) for ref in others), default=0))
            for key, _, hyp, refs in _counted(batches, orders) for n, own, others in zip(orders, hyp, refs)
            for gram in dict.fromkeys(chain(own, *others))), arrow)

    return _texts_by_id(predictions).mapInArrow(count, schema)


def overlap_statistics(predictions: DataFrame, orders=ORDERS) -> DataFrame:
    """Per id: clipped matches and possible n-grams by order, and the length figures."""
    names = [f"match{n}" for n in orders]
    schema = StructType([
        predictions.schema["id"], StructField("hyp_len", LongType()), StructField("lens", ArrayType(IntegerType())),
        *[StructField(name, LongType()) for name in names]])
    arrow = to_arrow_schema(schema)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows() -> Iterator[tuple]:
            for key, sizes, hyp, refs in _counted(batches, orders):
                found = [0 if key is None else _clipped(own, others) for own, others in zip(hyp, refs)]
                for size in sizes:
                    yield key, *size, *found

        yield from _batches(rows(), arrow)

    sized = _texts_by_id(predictions).mapInArrow(match, schema)
    closest = F.array_min(F.transform("lens", lambda n: F.struct(F.abs(n - F.col("hyp_len")).alias("d"), n.alias("n"))))["n"]
    total = F.aggregate("lens", F.lit(0.0), lambda a, n: a + n)
    return sized.select(
        "id", "hyp_len", F.array_min("lens").cast("long").alias("shortest"), closest.cast("long").alias("closest"),
        (total / F.size("lens")).alias("average"),
        *[F.greatest(F.col("hyp_len") - (n - 1), F.lit(0)).alias(f"possible{n}") for n in orders], *names)


def sum_statistics(statistics: DataFrame, orders=ORDERS) -> DataFrame:
    names = ["hyp_len", "shortest", "closest", "average"]
    names += [f"{part}{n}" for n in orders for part in ("match", "possible")]
    return statistics.agg(*[F.sum(n).alias(n) for n in names])


def _product(columns: list[Column]) -> Column:
    out = columns[0]
    for c in columns[1:]:
        out = out * c
    return out


def bleu(smooth: bool, orders=ORDERS) -> Column:
    """Score from (summed) statistics, shortest reference length, optional add-one smoothing."""
    add = 1.0 if smooth else 0.0
    precisions = [
        F.when(F.col(f"possible{n}") + add > 0, (F.col(f"match{n}") + add) / (F.col(f"possible{n}") + add)).otherwise(0.0)
        for n in orders]
    mean = F.when(F.least(*precisions) > 0, F.exp(sum((F.log(p) for p in precisions), F.lit(0.0)) / len(orders))).otherwise(0.0)
    ratio = F.col("hyp_len") / F.col("shortest")
    penalty = F.when(ratio > 1, 1.0).when(ratio > 0, F.exp(1 - 1 / ratio)).otherwise(0.0)
    return mean * penalty


def scorer_bleu(reference_length: str, orders=ORDERS) -> tuple[list[Column], Column]:
    """(BLEU-1..n, combined) in the caption-scoring variant.

    Tiny constants keep zero counts finite; the combined value applies the
    brevity penalty to its parts and once more to their mean, as published.
    """
    # Fixed values of this scorer.
    small, tiny = 1e-9, 1e-15
    ratio = (F.col("hyp_len") + tiny) / (F.col(reference_length) + small)
    penalty = F.when(ratio > 1, 1.0).otherwise(F.exp(1 - 1 / ratio))
    parts = [(F.col(f"match{n}") + tiny) / (F.col(f"possible{n}") + small) for n in orders]
    scores = [F.pow(_product(parts[: n]), F.lit(1.0 / n)) * penalty for n in orders]
    mean = F.when(F.least(*scores) > 0, F.exp(sum((F.log(s) for s in scores), F.lit(0.0)) / len(orders))).otherwise(0.0)
    return scores, mean * penalty


def fourth_smoothing_bleu(orders=ORDERS) -> Column:
    """Sentence score with zero matches smoothed by 1 / (2^k * K / ln(length)), K = 5."""
    denominators = [F.greatest(F.col(f"possible{n}"), F.lit(1)) for n in orders]
    logs, zeros = [], F.lit(0)
    for n, d in zip(orders, denominators):
        empty = F.col(f"match{n}") == 0
        zeros = zeros + F.when(empty, 1).otherwise(0)
        filled = 1 / (F.pow(F.lit(2.0), zeros.cast("double")) * 5 / F.log("hyp_len"))
        value = F.when(~empty, F.col(f"match{n}") / d).when(F.col("hyp_len") > 1, filled / d)
        logs.append(F.coalesce(F.log(value), F.lit(0.0)) / len(orders))
    score = _closest_penalty() * F.exp(sum(logs, F.lit(0.0)))
    return F.when(F.col("match1") == 0, 0.0).otherwise(score)


def unsmoothed_corpus_bleu(orders=ORDERS) -> Column:
    """Corpus score where a zero match counts as the smallest positive number."""
    smallest = 2.2250738585072014e-308  # fixed value
    parts = [
        F.log(F.when(F.col(f"match{n}") == 0, F.lit(smallest)).otherwise(F.col(f"match{n}") / F.col(f"possible{n}")))
        for n in orders]
    return F.when(F.col("match1") == 0, 0.0).otherwise(_closest_penalty() * F.exp(sum(parts, F.lit(0.0)) / len(orders)))


def _closest_penalty() -> Column:
    hyp, ref = F.col("hyp_len"), F.col("closest")
    return F.when(hyp > ref, 1.0).when(hyp == 0, 0.0).otherwise(F.exp(1 - ref / hyp))


def token_f1(predictions: DataFrame) -> DataFrame:
    """(id, precision, recall, f1) of the reference with the best F1; the first of equals."""
    hyp = F.array(F.struct(F.lit(0).alias("side"), F.col("h").alias("tokens")))
    pairs = placed_by(predictions, "id").select(
        "id", K.words(T.normalize_answer(F.col("hyp"))).alias("h"), F.col("hyp"), F.posexplode("refs").alias("ref_no", "ref"))
    sides = pairs.select("id", "ref_no", F.explode(F.concat(hyp, F.array(F.struct(
        F.lit(1).alias("side"), K.words(T.normalize_answer(F.col("ref"))).alias("tokens"))))).alias("s"))
    counts = (
        sides.select("id", "ref_no", "s.side", F.explode("s.tokens").alias("token")).groupBy("id", "ref_no", "token")
        .agg(F.count_if(F.col("side") == 0).alias("h"), F.count_if(F.col("side") == 1).alias("r"))
        .groupBy("id", "ref_no").agg(F.sum(F.least("h", "r")).alias("same"), F.sum("h").alias("hn"), F.sum("r").alias("rn")))
    blank = pairs.select("id", "ref_no", (F.col("ref") == "").alias("no_ref"), ((F.col("ref") == "") & (F.col("hyp") == "")).alias("both"))
    joined = blank.join(counts, ["id", "ref_no"], "left")
    hit = (F.col("same") > 0) & ~F.col("no_ref")
    one = F.when(F.col("both"), 1.0)
    precision = one.when(hit, F.col("same") / F.col("hn")).otherwise(0.0)
    recall = one.when(hit, F.col("same") / F.col("rn")).otherwise(0.0)
    scored = joined.select("id", "ref_no", precision.alias("precision"), recall.alias("recall")).withColumn(
        "f1", F.when(F.col("precision") > 0, 2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0))
    best = scored.groupBy("id").agg(F.max_by(F.struct("precision", "recall", "f1"), F.struct("f1", -F.col("ref_no"))).alias("b"))
    return best.select("id", "b.precision", "b.recall", "b.f1")


COLUMNS = 4096  # left tokens compared at a time


def common_subsequence(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence, one big-integer step per right token and block of left tokens.

    A block holds a bit row for each of its own tokens only; the carry of each
    right token's addition goes on to the next block. Memory is in proportion
    to the lengths of the texts.
    """
    carry, found = bytearray(len(right)), 0
    for start in range(0, len(left), COLUMNS):
        block = left[start:start + COLUMNS]
        places: dict[str, int] = {}
        for i, token in enumerate(block):
            places[token] = places.get(token, 0) | (1 << i)
        full = (1 << len(block)) - 1
        open_bits = full
        for at, token in enumerate(right):
            places_of = places.get(token, 0)
            if places_of or carry[at]:
                total = open_bits + (open_bits & places_of) + carry[at]
                carry[at] = total >> len(block)
                open_bits = (total | (open_bits & ~places_of)) & full
        found += len(block) - open_bits.bit_count()
    return found


@F.pandas_udf(LongType())
def _common_subsequence(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for hyp, ref in batches:
        yield pd.Series([common_subsequence(h.split(" "), r.split(" ")) for h, r in zip(hyp, ref)], dtype="int64")


def rouge_l(predictions: DataFrame, beta: float = 1.2) -> DataFrame:
    """(id, rouge_l) from the best precision and the best recall over references.

    Texts are cut at single spaces, so empty tokens count. Pairs without a
    common token skip the comparison.
    """
    rows = predictions.select("id", "hyp", F.explode("refs").alias("ref"))
    common = F.arrays_overlap(F.split("hyp", " "), F.split("ref", " "))
    scored = rows.withColumn("lcs", F.when(common, _common_subsequence("hyp", "ref")).otherwise(0))
    best = scored.groupBy("id").agg(
        F.max(F.col("lcs") / F.size(F.split("hyp", " "))).alias("p"),
        F.max(F.col("lcs") / F.size(F.split("ref", " "))).alias("r"))
    score = (1 + beta**2) * F.col("p") * F.col("r") / (F.col("r") + beta**2 * F.col("p"))
    return best.select("id", F.when((F.col("p") > 0) & (F.col("r") > 0), score).otherwise(0.0).alias("rouge_l"))
