"""Subword encoding on the table of distinct words; ``merges`` learns the merges.

The corpus itself is only read to count words and, at the end, to look
segmented words up.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, StructField, StructType

from ..session import places, release, staged
from ..sources.readers import parse_merges, read_numbered_lines
from ..sources.sinks import write_text_lines
from .merges import END_OF_WORD, Merge, learn_merges  # noqa: F401
from .tokentables import one_row_each
from .vocab import skewed_lookup

OPEN, CLOSE = "\ue000", "\ue001"
BETWEEN = CLOSE + OPEN
# Fixed values.
SEPARATOR = "@@"
MERGE_FILE_VERSION = "0.2"


def as_symbols(word: Column) -> Column:
    """Characters and an end mark, each enclosed in marks."""
    chars = F.regexp_extract_all(word, F.lit("(?s)(.)"), 1)
    return F.concat(F.lit(OPEN), F.array_join(F.array_append(chars, F.lit(END_OF_WORD)), BETWEEN), F.lit(CLOSE))


def symbol_list(symbols: Column) -> Column:
    return F.split(F.regexp_replace(symbols, f"^{OPEN}|{CLOSE}$", ""), BETWEEN)


def pair_counts(words: DataFrame, symbols: str = "symbols", n: str = "n") -> DataFrame:
    """(left, right, n): adjacent symbol pairs weighted by word frequency."""
    pairs = words.select(n, symbol_list(F.col(symbols)).alias("s")).where(F.size("s") > 1).select(
        n, F.explode(F.arrays_zip(F.slice("s", 1, F.size("s") - 1).alias("left"),
                                  F.slice("s", 2, F.size("s") - 1).alias("right"))).alias("p"))
    return pairs.groupBy("p.left", "p.right").agg(F.sum(n).alias("n"))


def merge_table(spark: SparkSession, merges: list[Merge]) -> DataFrame:
    rows = [(i, l, r) for i, (l, r) in enumerate(merges)]
    return spark.createDataFrame(rows, "rank int, left string, right string")


def saved_merges(merges: list[Merge], spark: SparkSession, path: str) -> str:
    """A merge file: version header, then one merge a line in order. The list is as long as its learner was asked for."""
    lines = [(0, f"#version: {MERGE_FILE_VERSION}"), *((i, f"{l} {r}") for i, (l, r) in enumerate(merges, 1))]
    rows = spark.createDataFrame(lines, "place int, value string").coalesce(1).sortWithinPartitions("place")
    return write_text_lines(rows.select("value"), path)


def loaded_merges(spark: SparkSession, path: str, most: int = -1) -> list[Merge]:
    """The merges of a merge file in rank order, at most ``most``; of a repeated pair the first."""
    table = parse_merges(read_numbered_lines(spark, path), most)
    return [(r.left, r.right) for r in table.orderBy("rank").collect()]


def lowest_rank_first(symbols: list[str], ranks: dict[Merge, int]) -> list[str]:
    """Joins all places of the adjacent pair of lowest rank, from left to right, until no adjacent pair has a rank.

    Symbols are a linked list and ranked places a heap: O(k log k) for k symbols.
    """
    size = len(symbols)
    symbols, after, before = list(symbols), [*range(1, size), -1], list(range(-1, size - 1))
    heap = [(rank, at) for at in range(size - 1) if (rank := ranks.get((symbols[at], symbols[at + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        lowest, places = heap[0][0], []
        while heap and heap[0][0] == lowest:
            places.append(heapq.heappop(heap)[1])
        beside = set()
        for at in places:
            right = after[at]
            if symbols[at] is None or right < 0 or ranks.get((symbols[at], symbols[right])) != lowest:
                continue
            symbols[at], symbols[right], after[at] = symbols[at] + symbols[right], None, after[right]
            if after[at] >= 0:
                before[after[at]] = at
            beside.update((before[at], at))
        for at in beside:  # only now: all places of a pair are joined before a new pair is looked at
            if at >= 0 and symbols[at] is not None and after[at] >= 0:
                rank = ranks.get((symbols[at], symbols[after[at]]))
                if rank is not None:
                    heapq.heappush(heap, (rank, at))
    return [symbol for symbol in symbols if symbol is not None]


def _pieces(word: str, ranks: dict[Merge, int]) -> list[str]:
    """The word's pieces without the end mark."""
    parts = lowest_rank_first([*word, END_OF_WORD], ranks)
    if parts[-1] == END_OF_WORD:
        return parts[:-1]
    return [*parts[:-1], parts[-1].removesuffix(END_OF_WORD)]


def segment(words: DataFrame, merges: list[Merge], token: str = "token") -> DataFrame:
    """Adds ``pieces``; run it on distinct words, so each word is encoded once.

    The ranks are one broadcast value, as long as the merge list. The result is
    a staged table: its users read it more than once.
    """
    ranks: dict[Merge, int] = {}
    for i, pair in enumerate(merges):
        ranks.setdefault(tuple(pair), i)
    shared = words.sparkSession.sparkContext.broadcast(ranks)

    @F.pandas_udf(ArrayType(StringType()))
    def pieces(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for tokens in batches:
            yield tokens.map(lambda t: _pieces(t, shared.value))

    done = staged(words.withColumn("pieces", pieces(F.col(token))), "segmented")
    release(words.sparkSession)
    return done


def marked(pieces: Column) -> Column:
    """Pieces with the separator on all but the last."""
    return F.transform(pieces, lambda p, i: F.when(i < F.size(pieces) - 1, F.concat(p, F.lit(SEPARATOR))).otherwise(p))


def encode_texts(df: DataFrame, key: str, tokens: str | Column, segmented: DataFrame) -> DataFrame:
    """(key, text) with every word replaced by its marked pieces.

    ``segmented`` has one row per distinct word (token, n, pieces). Only words
    of more than one piece are in the lookup; others stay as they are. The words
    of rows that repeat a key are put together in order of place and piece.

    Texts are placed in chunks by key, and a chunk asks for each of its distinct
    words once. So texts and distinct words are shuffled, but no tokens.
    """
    words = F.col(tokens) if isinstance(tokens, str) else tokens
    chunks = places(df)
    placed = df.withColumn("_chunk", F.pmod(F.xxhash64(key), F.lit(chunks)).cast("int")).repartition(chunks, "_chunk")
    rows = placed.select("_chunk", F.col(key), words.alias("tokens"))
    asked = one_row_each(placed.select("_chunk", words.alias("tokens")), ["_chunk"], "tokens", "token").distinct()
    split = segmented.where(F.size("pieces") > 1).select("token", "n", F.array_join(marked(F.col("pieces")), " ").alias("out"))
    found = staged(skewed_lookup(asked, split, "token", "n").select(F.col("_chunk").alias("_of"), "token", "out"), "looked-up")
    release(df.sparkSession)
    kinds = StructType([df.schema[key], StructField("text", StringType())])
    return rows.groupBy("_chunk").cogroup(found.groupBy("_of")).applyInArrow(_rewritten, kinds)


def _rewritten(texts: pa.Table, found: pa.Table) -> pa.Table:
    """The rows (chunk, key, tokens) of a chunk and its words (chunk, token, out) -> (key, text); rows without tokens give none."""
    name = texts.column_names[1]
    texts = texts.filter(pc.greater(pc.fill_null(pc.list_value_length(texts.column(2)), 0), 0))
    known, out = (found.column(i).combine_chunks() for i in (1, 2))
    number = texts.column(1).combine_chunks().dictionary_encode(null_encoding="encode").indices.to_numpy()
    repeated = (np.bincount(number) > 1)[number]
    keys, joined, again, at = [], [], {}, 0
    for batch in texts.to_batches():
        twice, at = repeated[at:at + len(batch)], at + len(batch)
        cells = batch.column(2)
        values = cells.flatten()
        place = pc.index_in(values, value_set=known)
        shown = pc.if_else(pc.is_valid(place), out.take(place), values)
        lists = pa.ListArray.from_arrays(pc.subtract(cells.offsets, cells.offsets[0]), shown)
        plain = pa.array(~twice)
        keys.append(batch.column(1).filter(plain))
        if shown.null_count:  # left out, as they have no text
            joined.append(pa.array([" ".join(w for w in row if w is not None) for row in lists.filter(plain).to_pylist()], pa.string()))
        else:
            joined.append(pc.binary_join(lists.filter(plain), " "))
        for row in np.flatnonzero(twice):
            again.setdefault(int(number[at - len(batch) + row]), [batch.column(1).slice(row, 1), []])[1].extend(
                (pos, w) for pos, w in enumerate(lists[row].as_py()) if w is not None)
    for one, entries in again.values():
        keys.append(one)
        joined.append(pa.array([" ".join(w for _, w in sorted(entries))], pa.string()))
    return pa.table({name: pa.chunked_array(keys, texts.schema.field(1).type), "text": pa.chunked_array(joined, pa.string())})


def piece_vocabulary(segmented: DataFrame, least: int) -> DataFrame:
    """Marked pieces seen at least ``least`` times, weighted by word frequency."""
    return (
        segmented.select("n", F.explode(marked(F.col("pieces"))).alias("piece"))
        .groupBy("piece").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    )


def expansions(spark: SparkSession, merges: list[Merge], vocabulary: DataFrame) -> DataFrame:
    """(piece, final, out): every merged piece outside the vocabulary with the pieces it is taken apart into.

    The merges are a graph from piece to its two halves. One level is the table
    of halves; replacing each half by its own entry doubles the levels, so the
    number of joins is the logarithm of the deepest merge. All tables are at
    most as long as the merge list, but for the vocabulary, which is read once.
    """
    halves = {left + right: (left, right) for left, right in merges}  # the last one of several ways counts
    depth: dict[str, int] = {}
    for whole in sorted(halves, key=len):
        depth[whole] = 1 + max(depth.get(half, 0) for half in halves[whole])
    rows = [(whole, False, left, right) for whole, (left, right) in halves.items()]
    rows += [(whole.removesuffix(END_OF_WORD), True, left, right.removesuffix(END_OF_WORD))
             for whole, (left, right) in halves.items() if whole.endswith(END_OF_WORD)]
    nodes = spark.createDataFrame(rows, "piece string, final boolean, left string, right string")
    looked_up = nodes.withColumn("known", F.when(F.col("final"), F.col("piece")).otherwise(F.concat("piece", F.lit(SEPARATOR))))
    inside = vocabulary.select(F.col("piece").alias("known")).join(F.broadcast(looked_up.select("known")), "known", "left_semi").distinct()
    half = lambda name, final: F.struct(F.col(name).alias("piece"), final.alias("final"))
    table = looked_up.join(inside, "known", "left_anti").select(
        "piece", "final", F.array(half("left", F.lit(False)), half("right", F.col("final"))).alias("out"))
    for _ in range(max(0, max(depth.values(), default=1) - 1).bit_length()):
        parts = table.select(F.col("piece").alias("whole"), F.col("final").alias("whole_final"), F.posexplode("out").alias("pos", "part"))
        deeper = parts.join(table.select(F.struct("piece", "final").alias("part"), F.col("out").alias("deeper")), "part", "left")
        table = deeper.groupBy("whole", "whole_final").agg(F.sort_array(F.collect_list(
            F.struct("pos", F.coalesce("deeper", F.array("part")).alias("out")))).alias("e")).select(
            F.col("whole").alias("piece"), F.col("whole_final").alias("final"), F.flatten("e.out").alias("out"))
    return table.select("piece", "final", F.col("out.piece").alias("out"))


def constrain(segmented: DataFrame, merges: list[Merge], vocabulary: DataFrame) -> DataFrame:
    """Pieces outside the vocabulary are taken apart, merge by merge, until inside or whole symbols."""
    sized = segmented.withColumn("k", F.size("pieces"))
    cells = one_row_each(sized, ["token", "k"], "pieces", "piece", "pos").select(
        "token", "pos", "piece", (F.col("pos") == F.col("k") - 1).alias("final"))
    table = F.broadcast(expansions(segmented.sparkSession, merges, vocabulary))  # at most two rows a merge
    out = F.coalesce("out", F.array("piece")).alias("out")
    return cells.join(table, ["piece", "final"], "left").groupBy("token").agg(
        F.sort_array(F.collect_list(F.struct("pos", out))).alias("e")).select("token", F.flatten("e.out").alias("pieces"))


def isolate_terms(word: Column, term: str) -> Column:
    """Word cut so that every match of the term (a pattern without groups) stands alone."""
    cut = F.split(F.regexp_replace(word, f"({term})", f"{OPEN}$1{OPEN}"), OPEN)
    parts = F.filter(F.transform(cut, lambda p: F.regexp_replace(p, r"^[\r\n ]+|[\r\n ]+$", "")), lambda p: p != "")
    return F.when(word.rlike(f"^({term})$") | ~word.rlike(term), F.array(word)).otherwise(parts)
