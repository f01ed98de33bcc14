"""Substring dedup: passages that start in an earlier document are removed, found by difference-cover anchors.

A window is ``WINDOW`` consecutive words. For any two places there is a shift
below ``PERIOD`` that puts both on cover positions, so two equal windows hold
equal anchors (runs of ``WINDOW - PERIOD + 1`` words) at cover positions. Only
anchors are hashed for every text, 6 of 31 positions.

1. Anchors that occur in two documents survive. Their number is an aggregation
   with a map side; their places are found by a join whose hot keys the adaptive
   skew join can split.
2. Texts with surviving anchors are extended: every window around such an anchor
   gets a 128-bit hash, and the smallest document of each hash is looked up.
3. Windows that start in a smaller document are removed from the texts.

Equal word sequences are one class; its smallest document stands for the others,
which lose all their words (if they have a window at all) without being extended.

Defined results: null and empty texts have no words. A null key is compared with
nothing and keeps its words. Rows that repeat a key do not remove one another's
words, with equal or different texts. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import discard, release, staged
from .words import WordTable, slices, starts_of, window_hashes

WINDOW = 50
# fixed values: a perfect difference set modulo 31
PERIOD, COVER = 31, (1, 5, 11, 24, 25, 27)
ANCHOR = WINDOW - PERIOD + 1
ANCHOR_BASE, FIRST_BASE, SECOND_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
EMPTY = hashlib.sha256(b"").digest()


def _facts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) -> key, words, digest of the words joined by one space."""
    for batch in batches:
        for start, texts in slices(batch, 1):
            split = [text.split() for text in texts]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(start, len(texts)), pa.array([len(words) for words in split], pa.int64()),
                 pa.array([hashlib.sha256(b" ".join(words)).digest() for words in split], pa.binary())],
                names=["key", "n_words", "digest"])


def anchor_places(count: int) -> np.ndarray:
    """Cover positions of a text of ``count`` words at which an anchor fits."""
    if count < WINDOW:
        return np.zeros(0, np.int64)
    places = (np.arange(0, count, PERIOD)[:, None] + np.array(COVER)).ravel()
    return places[places <= count - ANCHOR]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text) -> (anchor, key, place) for every cover position."""
    table = WordTable()
    for batch in batches:
        for start, texts in slices(batch, 1):
            split = [text.split() for text in texts]
            counts = np.array([len(words) for words in split], np.int64)
            hashes = window_hashes(table.hashes([word for words in split for word in words]), ANCHOR, ANCHOR_BASE)
            places = [anchor_places(int(n)) for n in counts]
            per = np.array([len(p) for p in places], np.int64)
            if not per.sum():
                continue
            place = np.concatenate(places)
            rows = np.repeat(np.arange(len(texts)), per)
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[place + starts_of(counts)[rows]].view(np.int64)),
                 batch.column(0).slice(start, len(texts)).take(pa.array(rows)), pa.array(place.astype(np.int32))],
                names=["anchor", "key", "place"])


def _windows_at(table: WordTable, text: bytes, places: np.ndarray) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray]:
    """Words of a text, starts of all windows that hold an anchor at one of the places, and their two hashes."""
    words = text.split()
    first = len(words) - WINDOW + 1
    if first <= 0:
        return words, np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    near = np.zeros(len(words) + 1, np.int32)
    places = places[places <= len(words) - ANCHOR]
    np.add.at(near, np.maximum(places - (PERIOD - 1), 0), 1)
    np.add.at(near, places + 1, -1)
    starts = np.flatnonzero(np.cumsum(near)[:first])
    hashes = table.hashes(words)
    return words, starts, window_hashes(hashes, WINDOW, FIRST_BASE)[starts], window_hashes(hashes, WINDOW, SECOND_BASE)[starts]


def _extended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, places) -> (window, window2, key), one row per distinct window of a text."""
    table = WordTable()
    for batch in batches:
        keys, found = batch.column(0), []
        for row, (text, places) in enumerate(zip(batch.column(1), batch.column(2))):
            _, _, one, two = _windows_at(table, (text.as_py() or "").encode(), places.values.to_numpy())
            one, at = np.unique(one, return_index=True)
            found.append((np.full(len(one), row), one, two[at]))
        if found:
            rows, one, two = (np.concatenate(part) for part in zip(*found))
            yield pa.RecordBatch.from_arrays([pa.array(one.view(np.int64)), pa.array(two.view(np.int64)), keys.take(pa.array(rows))],
                                             names=["window", "window2", "key"])


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, text, places, windows that go) -> key, digest of all words, words removed, digest of the rest."""
    table = WordTable()
    for batch in batches:
        out = []
        for key, text, places, gone in zip(*batch.columns):
            words, starts, one, _ = _windows_at(table, (text.as_py() or "").encode(), places.values.to_numpy())
            starts = starts[np.isin(one, gone.values.to_numpy().view(np.uint64))]
            cover = np.zeros(len(words) + 1, np.int32)
            np.add.at(cover, starts, 1)
            np.add.at(cover, starts + WINDOW, -1)
            drop = np.cumsum(cover)[:len(words)] > 0
            kept = b" ".join(word for word, go in zip(words, drop) if not go)
            out.append((hashlib.sha256(b" ".join(words)).digest(), int(drop.sum()), hashlib.sha256(kept).digest(), kept.decode()))
        if out:
            digest, removed, rest, kept = zip(*out)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(digest, pa.binary()), pa.array(removed, pa.int64()), pa.array(rest, pa.binary()),
                 pa.array(kept, pa.string())], names=["key", "digest", "n_removed", "kept_digest", "kept_text"])


def without_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two frames: what happened to each input row, and the texts that lost some but not all of their words.

    The first has key, n_words, n_removed, kept_digest (SHA-256 of the words
    that stay, joined by one space) and digest (the same of all words); the
    second has key, digest, kept_text. A row that loses nothing keeps its text
    as it is; a row that loses all has an empty one.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    facts = staged(rows.mapInArrow(_facts, "key bigint, n_words bigint, digest binary"), "passages-facts")
    firsts = facts.where(F.col("n_words") >= WINDOW).groupBy("digest").agg(F.min("key").alias("first"))
    facts_first = facts.join(firsts, "digest", "left")
    readers = facts_first.where("key = first").select("key").distinct()  # the smallest document of each class

    anchors = rows.where("key is not null").mapInArrow(_anchors, "anchor bigint, key bigint, place int")
    twice = anchors.groupBy("anchor").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high").select("anchor")
    places = staged(anchors.join(twice, "anchor").groupBy("key").agg(F.collect_set("place").alias("places")).join(readers, "key"),
                    "passages-places")
    release(spark)
    texts = staged(rows.join(places, "key").select("key", "text", "places").distinct(), "passages-texts")
    release(spark)
    windows = texts.mapInArrow(_extended, "window bigint, window2 bigint, key bigint")
    earliest = windows.groupBy("window", "window2").agg(F.min("key").alias("low"), F.max("key").alias("high")).where("low < high")
    gone = staged(windows.join(earliest.drop("high"), ["window", "window2"]).where("key > low")
                  .groupBy("key").agg(F.collect_set("window").alias("gone")), "passages-gone")
    release(spark)
    fixed = staged(
        texts.join(gone, "key").select("key", "text", "places", "gone")
        .mapInArrow(_removed, "key bigint, digest binary, n_removed bigint, kept_digest binary, kept_text string"), "passages-fixed")
    discard(places, texts, gone)
    release(spark)
    copy = F.col("key").isNotNull() & (F.col("key") != F.col("first"))
    report = (
        facts_first.join(fixed.select("key", "digest", F.col("n_removed").alias("lost"), F.col("kept_digest").alias("rest")),
                         ["key", "digest"], "left")
        .select(F.col("key").alias(key), "n_words",
                F.when(copy, F.col("n_words")).otherwise(F.coalesce("lost", F.lit(0))).alias("n_removed"),
                F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("rest", "digest")).alias("kept_digest"), "digest")
    )
    return report, fixed.select(F.col("key").alias(key), "digest", "kept_text")
