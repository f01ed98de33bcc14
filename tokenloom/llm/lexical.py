"""Ranked lexical search: item tiles times document tiles, as dense float64 products that are exact integers.

The items (a stated query set) are cut into tiles of ``ITEMS``; a tile holds its
own compact vocabulary. Tile files lie in the shared folder, and a task has at
most ``PASS_TILES`` of them open, so its memory does not grow with the items.

1. One pass over the documents counts N, L and, per tile column, the documents
   that hold the term. Tasks send sums only.
2. Each tile gets its weights; item counts times weights are its rows.
3. A second pass turns blocks of documents into columns of impacts and
   multiplies. A product is cut by columns so that no partial sum can reach 2^53,
   where doubles stop being exact; parts are added as 64-bit integers.
4. Each task keeps the best ``k`` of each item, equal scores by smaller key; these
   are merged by groups of tasks, then by item.

Defined results: null and empty texts have no terms; an item without terms has
no rows. Every row of items is an item of its own, also under a repeated or null
id. Repeated documents count and rank one by one; a null key ranks behind equal
scores. Empty tables give an empty result. Other columns are ignored.
"""

from __future__ import annotations

import io
import math
from collections.abc import Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ..session import discard, staged
from . import files
from .words import SLICE_BYTES, slices

ITEMS, PASS_TILES, COLUMNS, DOCUMENTS, MERGERS = 256, 64, 1024, 512, 32
EXACT = 2 ** 53
MOST_IMPACT = 1_000_000  # (10^9 tf) div (1000 tf + 12 m) stays below this

# letters and digits of ASCII stay, A-Z in lower case; bytes of other letters are all above 127
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if b > 127 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


class Numbers(dict):
    """term -> number in order of first use."""

    def __missing__(self, term: bytes) -> int:
        value = self[term] = len(self)
        return value


def _pieces(text: bytes) -> Iterator[bytes]:
    """A folded text cut between terms, so that a very long one is split into few terms at a time."""
    start = 0
    while len(text) - start > SLICE_BYTES:
        end = text.find(b" ", start + SLICE_BYTES)
        if end < 0:
            break
        yield text[start:end]
        start = end
    yield text[start:] if start else text


def counted(texts: list[bytes]) -> tuple[list[bytes], np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct terms; (text, term, occurrences) entries in order of text; terms with repeats per text."""
    numbers, lengths, keys, times, waiting, size = Numbers(), np.zeros(len(texts), np.int64), [], [], [], 0

    def settle() -> None:
        if waiting:
            key, n = np.unique(np.concatenate(waiting), return_counts=True)
            keys.append(key)
            times.append(n)
            waiting.clear()

    for row, text in enumerate(texts):
        for piece in _pieces(text.translate(FOLD)):
            terms = piece.split()
            lengths[row] += len(terms)
            waiting.append(np.fromiter(map(numbers.__getitem__, terms), np.int64, len(terms)) + (row << 40))
            size += len(terms)
            if size > 2 * SLICE_BYTES:
                settle()
                size = 0
    settle()
    key = np.concatenate(keys) if keys else np.zeros(0, np.int64)
    n = np.concatenate(times) if times else np.zeros(0, np.int64)
    if len(keys) > 1:
        key, at = np.unique(key, return_inverse=True)
        n = np.bincount(at, n).astype(np.int64)
    return list(numbers), key >> 40, key & ((1 << 40) - 1), n, lengths


def _tiles(folder: str):
    """(item, text) -> the tile files written for them."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def put(items: list[int], texts: list[bytes]) -> str:
            terms, row, term, n, _ = counted(texts)
            out, uri = io.BytesIO(), f"{folder}/{files.attempt_name()}.tile"
            np.savez(out, items=np.array(items, np.int64), row=row, column=term, n=n,
                     terms=np.frombuffer(b" ".join(terms), np.uint8))
            with files.output(uri) as sink:
                sink.write(out.getvalue())
            return uri

        items, texts, size, made = [], [], 0, []
        for batch in batches:
            for item, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                items.append(item)
                texts.append((text.as_py() or "").encode())
                size += len(texts[-1])
                if len(items) == ITEMS or size >= SLICE_BYTES:
                    made.append(put(items, texts))
                    items, texts, size = [], [], 0
        if items:
            made.append(put(items, texts))
        if made:
            yield pa.RecordBatch.from_arrays([pa.array(made)], names=["uri"])

    return write


@lru_cache(maxsize=PASS_TILES)
def _tile(uri: str) -> tuple[dict, dict]:
    """A tile's arrays and its vocabulary (term -> column)."""
    with np.load(io.BytesIO(bytes(files.array(uri, np.uint8)))) as read:
        held = dict(read)
    return held, {term: column for column, term in enumerate(held.pop("terms").tobytes().split())}


def _columns(vocabulary: dict, terms: list[bytes]) -> np.ndarray:
    return np.fromiter((vocabulary.get(term, -1) for term in terms), np.int64, len(terms))


def _statistics(uris: list[str]):
    """(key, text) -> (tile, column, documents) sums of a task; tile -1 holds N and L."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tiles = [_tile(uri)[1] for uri in uris]
        held, totals = [np.zeros(len(v), np.int64) for v in tiles], np.zeros(2, np.int64)
        for batch in batches:
            for _, texts in slices(batch, 1):
                terms, _, term, _, lengths = counted(texts)
                totals += np.count_nonzero(lengths), lengths.sum()
                documents = np.bincount(term, minlength=len(terms))
                for vocabulary, sums in zip(tiles, held):
                    column = _columns(vocabulary, terms)
                    sums[column[column >= 0]] += documents[column >= 0]
        for tile, sums in [(-1, totals), *enumerate(held)]:
            column = np.flatnonzero(sums)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(column), tile, np.int32)), pa.array(column.astype(np.int32)), pa.array(sums[column])],
                names=["tile", "column", "n"])

    return read


def _weights(folder: str, documents: int):
    """Rows of one tile -> its weight file, one number per column."""

    def write(group: pa.Table) -> pa.Table:
        column, held = group.column("column").to_numpy(), group.column("n").to_numpy()
        weights = np.zeros(int(column.max()) + 1, np.int64)
        weights[column] = [math.floor(1000 * math.log((2 * documents + 2) / (2 * int(df) + 1))) for df in held]
        uri = f"{folder}/{files.attempt_name()}.weights"
        with files.output(uri) as sink:
            sink.write(weights.tobytes())
        return pa.table({"tile": pa.array([group.column("tile")[0].as_py()], pa.int32()), "uri": [uri]})

    return write


def products(held: dict, weights: np.ndarray, width: int = COLUMNS, exact: int = EXACT) -> list[tuple[int, np.ndarray]]:
    """(first column, item rows of these columns) parts whose products with any impacts stay below ``exact``."""
    rows, columns = len(held["items"]), int(held["column"].max()) + 1 if len(held["column"]) else 0
    most, parts = (exact - 1) // MOST_IMPACT, []
    by_column = np.argsort(held["column"], kind="stable")
    start = np.searchsorted(held["column"][by_column], np.arange(columns + 1))
    low = 0
    while low < columns:
        high = min(low + width, columns)
        while True:
            at = by_column[start[low]:start[high]]
            part = np.zeros((rows, high - low), np.int64)
            part[held["row"][at], held["column"][at] - low] = held["n"][at] * weights[held["column"][at]]
            if high - low == 1 or part.sum(1).max(initial=0) <= most:
                break
            high = low + (high - low) // 2
        while part.any():  # a single column too heavy for one part is taken in several
            now = np.minimum(part, most) if high - low == 1 else part
            parts.append((low, now.astype(np.float64)))
            part = part - now
        low = high
    return parts


class Best:
    """The k best (score, key) of each item so far; null keys come behind equal scores."""

    def __init__(self, items: int, k: int):
        self.k, self.least = k, np.ones(items, np.int64)
        self.item, self.score, self.none, self.key = (np.zeros(0, kind) for kind in (np.int64, np.int64, bool, np.int64))

    def add(self, scores: np.ndarray, none: np.ndarray, keys: np.ndarray) -> None:
        item, at = np.nonzero(scores >= self.least[:, None])
        if not len(item):
            return
        item = np.concatenate([self.item, item])
        score = np.concatenate([self.score, scores[item[len(self.item):], at]])
        none, key = np.concatenate([self.none, none[at]]), np.concatenate([self.key, keys[at]])
        order = np.lexsort((key, none, -score, item))
        item = item[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        order, item, last = order[place < self.k], item[place < self.k], item[place == self.k - 1]
        self.item, self.score, self.none, self.key = item, score[order], none[order], key[order]
        self.least[last] = self.score[np.searchsorted(item, last, "right") - 1]


def _scores(tiles: list[tuple[str, str | None]], documents: int, length: int, k: int):
    """(key, text) -> the task's best (task group, item, key, score) of every item."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = []
        for uri, weight_uri in tiles:
            held, vocabulary = _tile(uri)
            weights = np.zeros(len(vocabulary), np.int64)
            if weight_uri:
                known = files.array(weight_uri, np.int64)
                weights[:len(known)] = known
            opened.append((vocabulary, products(held, weights), held["items"], Best(len(held["items"]), k)))
        for batch in batches:
            for start, texts in slices(batch, 1):
                terms, row, term, n, lengths = counted(texts)
                m = np.array([100 - 25 + (25 * int(x) * documents) // length if length else 0 for x in lengths], np.int64)
                impact = (1_000_000_000 * n) // (1000 * n + 12 * m[row])
                column_of_key = batch.column(0).slice(start, len(texts))
                none, keys = column_of_key.is_null().to_numpy(False), column_of_key.fill_null(0).to_numpy()
                for vocabulary, parts, items, best in opened:
                    column = _columns(vocabulary, terms)[term] if len(terms) else term
                    for low in range(0, len(texts), DOCUMENTS):
                        high = min(low + DOCUMENTS, len(texts))
                        a, b = np.searchsorted(row, [low, high])
                        known = column[a:b] >= 0
                        at, doc, value = column[a:b][known], row[a:b][known] - low, impact[a:b][known]
                        scores = np.zeros((len(items), high - low), np.int64)
                        for first, part in parts:
                            inside = (at >= first) & (at < first + part.shape[1])
                            dense = np.zeros((part.shape[1], high - low))
                            dense[at[inside] - first, doc[inside]] = value[inside]
                            scores += (part @ dense).astype(np.int64)
                        best.add(scores, none[low:high], keys[low:high])
        group = TaskContext.get().partitionId() % MERGERS
        for _, _, items, best in opened:
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(best.item), group, np.int32)), pa.array(items[best.item]),
                 pa.array(best.key, pa.int64(), mask=best.none), pa.array(best.score)], names=["part", "item", "key", "score"])

    return read


def _first(df: DataFrame, k: int, *by: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("key"))
    return df.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, key: str = "doc_id", text: str = "text", item: str = "item_id",
           item_text: str = "text") -> DataFrame:
    """The ``k`` documents of highest score above 0 for each item: item id, rank, document key, score."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    asked = staged(items.select(F.monotonically_increasing_id().alias("item"), F.col(item).alias("id"),
                                F.col(item_text).cast("string").alias("text")), "search-items")
    folder = files.new_folder(spark, "search-tiles")
    uris = sorted(r.uri for r in asked.select("item", "text").mapInArrow(_tiles(folder), "uri string").collect())  # one per 256 items
    found = []
    for low in range(0, len(uris), PASS_TILES):
        tiles = uris[low:low + PASS_TILES]
        sums = staged(rows.mapInArrow(_statistics(tiles), "tile int, column int, n bigint").groupBy("tile", "column")
                      .agg(F.sum("n").alias("n")), "search-counts")
        totals = {r.column: r.n for r in sums.where("tile = -1").collect()}  # two rows
        documents, length = totals.get(0, 0), totals.get(1, 0)
        weights = {r.tile: r.uri for r in sums.where("tile >= 0").groupBy("tile").applyInArrow(
            _weights(folder, documents), "tile int, uri string").collect()}
        discard(sums)
        found.append(rows.mapInArrow(_scores([(uri, weights.get(n)) for n, uri in enumerate(tiles)], documents, length, k),
                                     "part int, item bigint, key bigint, score bigint"))
    if not found:
        return asked.select(F.col("id").alias(item), F.lit(1).alias("rank"), F.lit(None).cast("bigint").alias(key),
                            F.lit(None).cast("bigint").alias("score")).limit(0)
    best = _first(_first(reduce(DataFrame.union, found), k, "item", "part").drop("rank"), k, "item")
    return best.join(asked.select("item", "id"), "item").select(F.col("id").alias(item), "rank", F.col("key").alias(key), "score")
