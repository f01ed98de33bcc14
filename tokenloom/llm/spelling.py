"""Spelling variants: words one edit apart, found by asymmetric q-chunks.

The shorter word of a pair (either one, if equally long) gives two disjoint
chunks of half its length, its first and its last letters. The other word gives
positional grams. One edit touches at most one chunk, and since the lengths
differ by none or one, the other chunk is a gram of the other word at its own
place or one further.

A chunk alone would bring all words of a frequent beginning or ending into one
group. What the chunk leaves of a word again has two halves, of which one edit
spares one; so the key of a chunk also holds a half of the rest, and a group
shares about three quarters of its letters. No group is cut or left out. Pairs
are verified by their edit distance, and each is taken by the first of its keys.

Texts are read once, in bounded slices; tasks send sums per word. A form has ten
times the occurrences of its word, so chains of forms have at most 18 links and
roots are found by a few doubling joins.

Defined results: null and empty texts have no words. A null key counts as an
empty string before the colon. Repeated rows count one by one. An empty table
gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, staged
from .exact import A_TO_Z
from .words import SLICE_BYTES, slices

LETTERS = 7  # words have at least so many code points
RUNS = re.compile("[A-Za-zÀ-ÿ]{%d,}" % LETTERS)  # a longer match starts where a run starts; a shorter run gives no word
ERASED = 31
TABLE_BYTES = 24_000_000


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) -> (word, n): occurrences in the task so far, sent whenever the table is full."""
    counts, size = Counter(), 0

    def sums() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                          names=["word", "n"])

    for batch in batches:
        for start, texts in slices(batch, 1):
            for key, content in zip(batch.column(0).slice(start, len(texts)).to_pylist(), texts):
                before = zlib.crc32(b"%d:" % key if key is not None else b":")
                text = content.translate(A_TO_Z).decode()
                runs = RUNS.findall(text) if len(content) <= SLICE_BYTES else (found[0] for found in RUNS.finditer(text))
                for word, n in Counter(runs).items():
                    h = zlib.crc32(word.encode(), before)
                    if h % ERASED == 0:
                        at = h % len(word)
                        word = word[:at] + word[at + 1:]
                        if len(word) < LETTERS:
                            continue
                    if word not in counts:
                        size += len(word) + 150
                    counts[word] += n
                if size >= TABLE_BYTES:
                    yield sums()
                    counts, size = Counter(), 0
    if counts:
        yield sums()


def word_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 2) -> DataFrame:
    """(word, n) for the words of at least ``LETTERS`` code points with ``least`` occurrences."""
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(_occurrences, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _keys(word: Column, length: Column) -> list[Column]:
    """The four (chunk, half of the rest) pairs of a word of ``length`` letters, looked up in ``word``, which may have one more."""
    chunk = F.shiftright(length, 1)
    half = F.shiftright(length - chunk, 1)
    first, last = lambda n: F.left(word, n), lambda n: F.right(word, n)
    return [first(chunk + half),                                   # first chunk, first half of the rest
            F.concat(first(chunk), last(half)),                    # first chunk, last half
            F.concat(first(half), last(chunk)),                    # last chunk, first half
            last(chunk + half)]                                    # last chunk, last half


def _keyed(words: DataFrame, length: Column) -> DataFrame:
    keys = F.array(*[F.xxhash64(F.lit(i), length, k) for i, k in enumerate(_keys(F.col("word"), length))])
    return words.select("word", "n", length.alias("length"), F.posexplode(keys).alias("way", "key"))


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, near, n, near_n): every pair of different words one inserted, deleted or replaced code point apart, in one order."""
    size = F.char_length("word")
    chunks = _keyed(words, size)
    grams = _keyed(words, size).unionByName(_keyed(words, size - 1)).select(
        F.col("word").alias("near"), F.col("n").alias("near_n"), "key", "way", "length")
    met = chunks.join(grams, ["key", "way", "length"]).where(
        ((F.char_length("near") > F.col("length")) | (F.col("word") < F.col("near")))
        & (F.levenshtein("word", "near", 1) == 1))
    same = [a == b for a, b in zip(_keys(F.col("word"), F.col("length")), _keys(F.col("near"), F.col("length")))]
    way = F.when(same[0], 0).when(same[1], 1).when(same[2], 2).otherwise(3)
    return met.where(F.col("way") == way).select("word", "near", "n", "near_n")


def _roots(links: DataFrame) -> DataFrame:
    """(word, root): forms followed to the last; each round halves what is left of a chain."""
    now = staged(links.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        further = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        step = staged(now.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                               F.col("next").isNotNull().alias("moved")), "spelling-roots")
        discard(now)
        now = step
        if now.where("moved").isEmpty():
            return now.select("word", "root")


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """One row per (word, n): its form, the root of its forms, the number of near words and the form's n.

    The form is the near word of largest n (ties: the smallest in code-point
    order) if that n is at least ``times`` the word's, else null.
    """
    words = staged(words, "spelling-words")
    pairs = near_pairs(words)
    near = pairs.selectExpr("stack(2, word, near, near_n, near, word, n) AS (word, near, near_n)").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    enough = -F.col("best.less") >= times * F.col("n")
    facts = staged(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(enough, F.col("best.near")).alias("form"),
        F.when(enough, -F.col("best.less")).alias("form_n")), "spelling-forms")
    discard(words)
    return facts.join(_roots(facts.where("form is not null")), "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
