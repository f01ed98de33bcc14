"""Approximate nearest neighbours by inner product: one hierarchical navigable small-world graph per shard.

Rows are dealt to shards of about ``SHARD`` vectors by a hash of their id. A
shard's graphs are built in numpy, whole batches of nodes at a time, and stored
as flat neighbour arrays: per level a table of ``LINKS`` (``2 * LINKS`` at the
ground) node numbers, -1 where none.

The largest inner product is the nearest by angle only among vectors of like
length. So a shard is cut into bands of falling length, each at most ``RATIO``
from longest to shortest, with a graph of its own that is linked by angle and
walked by inner product. Where fewer than ``SMALL`` vectors are that close, a
band takes the next ``SMALL`` of any length, and the walk's beam holds them all.
A band is left out for a query when its longest vector cannot reach the k-th
best score so far, which is exact. Vectors of one direction are one node, which
holds them by length; equal vectors are one vector with several ids.

Queries are written once, in blocks; each task walks one shard's graphs for one
block, a batch of queries in lockstep. The shards' results are merged by a
window that keeps the best on the map side. Found candidates are scored on the
original vectors in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite
components take no part, nor do null ids. Vectors of another length than the
query's are no candidates. Of rows that repeat an id, the smallest vector counts.
Products beyond the range of doubles are infinite; such a sum without a value
ranks last, as minus infinity. A query without candidates has no rows. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import discard, staged
from .files import array, attempt_name, new_folder, output, rows_each

SHARD = 16384
LINKS, BEAM_BUILD, BEAM_SEARCH = 16, 64, 128
BATCH = 256
RATIO, SMALL = 1.5, 256
QUERIES = 1024  # in a block


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, entry: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-first search of many queries at once: (nodes, similarities), best first, -1 where fewer were met."""
    count, rows = len(queries), np.arange(len(queries))
    met = np.zeros((count, len(vectors)), bool)
    nodes = np.full((count, width), -1, np.int64)
    near = np.full((count, width), -np.inf, np.float32)
    fresh = np.zeros((count, width), bool)
    nodes[:, 0], near[:, 0], fresh[:, 0] = entry, np.einsum("qd,qd->q", queries, vectors[entry]), True
    met[rows, entry] = True
    while True:
        at = np.where(fresh, near, -np.inf).argmax(axis=1)
        live = np.flatnonzero(fresh[rows, at])
        if not len(live):
            order = np.argsort(-near, axis=1, kind="stable")
            return np.take_along_axis(nodes, order, 1), np.take_along_axis(near, order, 1)
        at = at[live]
        fresh[live, at] = False
        around = links[nodes[live, at]].astype(np.int64)
        new = (around >= 0) & ~met[live[:, None], around]
        r, c = np.nonzero(new)
        met[live[r], around[r, c]] = True
        found = np.full(around.shape, -np.inf, np.float32)
        found[r, c] = np.einsum("kd,kd->k", queries[live[r]], vectors[around[r, c]])
        every_near = np.concatenate([near[live], found], axis=1)
        top = np.argpartition(-every_near, width - 1, axis=1)[:, :width]
        nodes[live] = np.take_along_axis(np.concatenate([nodes[live], around], axis=1), top, 1)
        near[live] = np.take_along_axis(every_near, top, 1)
        fresh[live] = np.take_along_axis(np.concatenate([fresh[live], new], axis=1), top, 1)


def _spread(vectors: np.ndarray, own: np.ndarray, candidates: np.ndarray, most: int) -> np.ndarray:
    """Neighbours of each node out of its candidates: near ones that are not nearer to a chosen one, then the nearest of the rest."""
    valid = (candidates >= 0) & (candidates != own[:, None])
    order = np.argsort(candidates, axis=1, kind="stable")  # a repeated candidate counts once
    ranked = np.take_along_axis(candidates, order, 1)
    repeat = np.zeros_like(valid)
    np.put_along_axis(repeat, order[:, 1:], ranked[:, 1:] == ranked[:, :-1], 1)
    valid &= ~repeat
    near = np.where(valid, np.einsum("nd,ncd->nc", vectors[own], vectors[candidates]), -np.inf)
    order = np.argsort(-near, axis=1, kind="stable")
    candidates, near, valid = (np.take_along_axis(x, order, 1) for x in (candidates, near, valid))
    points = vectors[candidates]
    between = np.einsum("ncd,nkd->nck", points, points)
    chosen = np.zeros_like(valid)
    for column in range(candidates.shape[1]):
        nearest = np.where(chosen, between[:, column], -np.inf).max(axis=1)
        chosen[:, column] = valid[:, column] & (near[:, column] > nearest) & (chosen.sum(axis=1) < most)
    rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.where(np.take_along_axis(valid, rank, 1), np.take_along_axis(candidates, rank, 1), -1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1) if out.shape[1] < most else out


class Graph:
    """Nodes' vectors, their levels, and one table of neighbours per level."""

    def __init__(self, vectors: np.ndarray, seed: int = 3):
        self.vectors = vectors
        draw = np.random.default_rng(seed).random(len(vectors))
        self.levels = np.floor(-np.log(1 - draw) / np.log(LINKS)).astype(np.int64)
        self.tables = [np.full((len(vectors), LINKS * (2 if level == 0 else 1)), -1, np.int32)
                       for level in range(int(self.levels.max()) + 1)]
        order = np.argsort(-self.levels, kind="stable")  # the upper levels are complete before the many nodes below arrive
        self.entry = int(order[0])
        done = 1
        while done < len(order):
            batch = order[done:done + min(BATCH, done)]
            self._insert(batch)
            done += len(batch)

    def _insert(self, batch: np.ndarray) -> None:
        entry = np.full(len(batch), self.entry)
        for level in range(len(self.tables) - 1, -1, -1):
            here = self.levels[batch] >= level
            found, _ = _beam(self.vectors, self.tables[level], self.vectors[batch], entry, BEAM_BUILD if here.any() else 1)
            entry = found[:, 0]
            if here.any():
                nodes = batch[here]
                among = np.broadcast_to(nodes, (len(nodes), len(nodes)))  # nodes that arrive together may be neighbours
                close = self.vectors[nodes] @ self.vectors[nodes].T
                few = min(LINKS, len(nodes))
                among = np.take_along_axis(among, np.argpartition(-close, few - 1, axis=1)[:, :few], 1)
                self._link(level, nodes, np.concatenate([found[here], among], axis=1))

    def _link(self, level: int, nodes: np.ndarray, candidates: np.ndarray) -> None:
        table = self.tables[level]
        chosen = _spread(self.vectors, nodes, candidates, LINKS)
        table[nodes, :LINKS] = chosen
        r, c = np.nonzero(chosen >= 0)
        target, source = chosen[r, c], nodes[r]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        owners, first, counts = np.unique(target, return_index=True, return_counts=True)
        for low in range(0, len(owners), BATCH):
            own, start, n = owners[low:low + BATCH], first[low:low + BATCH], counts[low:low + BATCH]
            added = np.full((len(own), int(n.max())), -1, np.int64)
            where = np.arange(added.shape[1])[None, :] < n[:, None]
            added[where] = source[np.repeat(start, n) + np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)]
            table[own] = _spread(self.vectors, own, np.concatenate([table[own].astype(np.int64), added], axis=1), table.shape[1])


def search(vectors: np.ndarray, tables: list[np.ndarray], entry: int, queries: np.ndarray, width: int) -> np.ndarray:
    """Nodes nearest to each query, best first."""
    at = np.full(len(queries), entry)
    for table in tables[:0:-1]:
        at = _beam(vectors, table, queries, at, 1)[0][:, 0]
    return _beam(vectors, tables[0], queries, at, min(width, len(vectors)))[0]


def usable(rows: DataFrame, key: str, vector: str) -> DataFrame:
    """(id, vector as doubles, dim), one row per id, without rows that take no part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return (
        rows.select(F.col(key).cast("bigint").alias("id"), v.alias("vector"))
        .where(F.col("id").isNotNull() & F.col("vector").isNotNull() & finite & F.exists("vector", lambda x: x != 0))
        .groupBy("id").agg(F.min("vector").alias("vector")).withColumn("dim", F.size("vector"))
    )


def directions(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unit vectors and the logarithms of the lengths, for components of any size."""
    most = np.abs(vectors).max(axis=1)
    units = vectors / most[:, None]
    length = np.sqrt((units**2).sum(axis=1))
    return units / length[:, None], np.log(most) + np.log(length)


def bands(lengths: np.ndarray) -> list[np.ndarray]:
    """Vectors by falling (log) length, cut into bands of like length or of few vectors."""
    order, out, low = np.argsort(-lengths, kind="stable"), [], 0
    falling = -lengths[order]
    while low < len(order):
        high = int(np.searchsorted(falling, falling[low] + np.log(RATIO), "right"))
        high = min(len(order), max(high, low + SMALL))
        out.append(order[low:high])
        low = high
    return out


def _build(folder: str):
    """The rows of one shard -> its files."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("id").to_numpy()
        dim = table.column("dim")[0].as_py()
        original = table.column("vector").combine_chunks().flatten().to_numpy().reshape(-1, dim)
        order = np.argsort(ids)
        ids, original = ids[order], original[order]
        vectors, owner = np.unique(original, axis=0, return_inverse=True)
        units, lengths = directions(vectors)
        placed, members, flat, links, rows = [], [], [], [], []
        for band in bands(lengths):
            _, node = np.unique(units[band].astype(np.float32), axis=0, return_inverse=True)
            band = band[np.lexsort((-lengths[band], node.ravel()))]
            count = np.bincount(node.ravel())
            longest = band[np.cumsum(count) - count]
            graph = Graph(units[longest].astype(np.float32))
            top = lengths[longest].max()
            rows.append((len(longest), len(graph.tables), graph.entry, top))
            flat.append(units[longest] * np.exp(lengths[longest] - top)[:, None])
            links += [t.ravel() for t in graph.tables]
            placed.append(band)
            members.append(count)
        placed = np.concatenate(placed)
        new_number = np.empty(len(placed), np.int64)
        new_number[placed] = np.arange(len(placed))
        owner = new_number[owner.ravel()]
        starts = lambda counts: np.concatenate([[0], np.cumsum(counts)])
        name = attempt_name()
        parts = {"ids": ids[np.lexsort((ids, owner))].astype("<i8"), "owners": starts(np.bincount(owner, minlength=len(placed))).astype("<i8"),
                 "vectors": vectors[placed].astype("<f8"), "members": starts(np.concatenate(members)).astype("<i8"),
                 "flat": np.concatenate(flat).astype("<f4"), "links": np.concatenate(links).astype("<i4"), "bands": np.array(rows, "<f8")}
        for suffix, part in parts.items():
            with output(f"{folder}/{name}.{suffix}") as out:
                out.write(part.tobytes())
        return pa.table({"shard": table.column("shard")[:1], "dim": table.column("dim")[:1], "name": [name]})

    return run


def _ranges(low: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers of all ranges of ``count`` from ``low``, one after the other."""
    return np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


class Shard:
    """A shard's files, opened."""

    def __init__(self, folder: str, name: str, dim: int):
        self.ids, self.owners = array(f"{folder}/{name}.ids", "<i8"), array(f"{folder}/{name}.owners", "<i8")
        self.vectors, self.members = array(f"{folder}/{name}.vectors", "<f8").reshape(-1, dim), array(f"{folder}/{name}.members", "<i8")
        flat, links = np.array(array(f"{folder}/{name}.flat", "<f4")).reshape(-1, dim), np.array(array(f"{folder}/{name}.links", "<i4"))
        self.bands, node, at = [], 0, 0
        for count, levels, entry, top in array(f"{folder}/{name}.bands", "<f8").reshape(-1, 4):
            count, tables = int(count), []
            for level in range(int(levels)):
                width = LINKS * (2 if level == 0 else 1)
                tables.append(links[at:at + count * width].reshape(count, width))
                at += count * width
            self.bands.append((node, flat[node:node + count], tables, int(entry), top))
            node += count

    def _answers(self, query: int, vector: np.ndarray, nodes: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the vectors of some nodes, best first, at most k."""
        low, count = self.members[nodes], self.members[nodes + 1] - self.members[nodes]
        if len(nodes) and count.max() > 2 * k + 2:  # of one direction, the longest are best, or the shortest where the product is negative
            ends = [*zip(low, np.minimum(count, k + 1)), *zip(low + np.maximum(count - k - 1, k + 1), np.clip(count - k - 1, 0, k + 1))]
            low, count = (np.array(x, np.int64) for x in zip(*ends))
        found = _ranges(low, count)
        with np.errstate(over="ignore", invalid="ignore"):
            score = (self.vectors[found] * vector).sum(axis=1)
        score = np.where(np.isnan(score), -np.inf, score)
        # all ids of equal vectors, in ascending order; k + 1 of them are enough for k without the query
        times = np.minimum(self.owners[found + 1] - self.owners[found], k + 1)
        ids, score = self.ids[_ranges(self.owners[found], times)], np.repeat(score, times)
        score, ids = score[ids != query], ids[ids != query]
        best = np.lexsort((ids, -score))[:k]
        return ids[best], score[best]

    def nearest(self, own: np.ndarray, queries: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(query id, ids, scores) of each query's k nearest of the shard."""
        units, lengths = directions(queries)
        for low in range(0, len(queries), BATCH):
            batch = range(low, min(low + BATCH, len(queries)))
            best = {q: (np.zeros(0, np.int64), np.zeros(0)) for q in batch}
            for first, flat, tables, entry, top in self.bands:
                live = np.array([q for q in batch if len(best[q][0]) < k or best[q][1][-1] <= 0
                                 or np.log(best[q][1][-1]) <= lengths[q] + top + 1e-9])
                if not len(live):
                    break  # the bands below are shorter still
                width = max(BEAM_SEARCH, 2 * k, min(len(flat), SMALL))
                for q, nodes in zip(live, search(flat, tables, entry, units[live].astype(np.float32), width)):
                    ids, score = self._answers(own[q], queries[q], first + nodes[nodes >= 0], k)
                    ids, score = np.concatenate([best[q][0], ids]), np.concatenate([best[q][1], score])
                    top_k = np.lexsort((ids, -score))[:k]
                    best[q] = ids[top_k], score[top_k]
            for q in batch:
                yield int(own[q]), *best[q]


def _blocks(folder: str):
    """(id, vector, dim) -> files of at most ``QUERIES`` queries of one length."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                some = batch.filter(pa.array(dims == dim))
                for low in range(0, some.num_rows, QUERIES):
                    block, name = some.slice(low, QUERIES), attempt_name()
                    with output(f"{folder}/{name}.asked") as out:
                        out.write(block.column("id").to_numpy().astype("<i8").tobytes())
                        out.write(block.column("vector").flatten().to_numpy().astype("<f8").tobytes())
                    yield pa.RecordBatch.from_pydict({"block": [name], "dim": pa.array([int(dim)], pa.int32()),
                                                      "asked": pa.array([block.num_rows], pa.int32())})

    return write


def nearest_neighbours(rows: DataFrame, queries: DataFrame, k: int, key: str = "vec_id", vector: str = "embedding",
                       shard: int = SHARD) -> DataFrame:
    """query_id, rank, vec_id, score: the k rows found nearest to each row of ``queries``, whose own id is left out."""
    spark = rows.sparkSession
    folder = new_folder(spark, "neighbours")
    base = staged(usable(rows, key, vector), "neighbours-rows")
    shards = max(1, -(-base.count() // shard))
    index = staged(
        base.withColumn("shard", F.pmod(F.xxhash64("id"), F.lit(shards)).cast("int")).groupBy("shard", "dim")
        .applyInArrow(_build(folder), "shard int, dim int, name string"), "neighbours-index")
    blocks = staged(usable(queries, key, vector).mapInArrow(_blocks(folder), "block string, dim int, asked int"), "neighbours-queries")

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened: tuple[str, Shard] | None = None
        for batch in batches:
            for row in batch.to_pylist():
                if opened is None or opened[0] != row["name"]:
                    opened = row["name"], Shard(folder, row["name"], row["dim"])
                asked = array(f"{folder}/{row['block']}.asked", "<i8")
                points = asked[row["asked"]:].view("<f8").reshape(-1, row["dim"])
                out = list(opened[1].nearest(asked[:row["asked"]], points, k))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat([q for q, _, _ in out], [len(i) for _, i, _ in out]), pa.int64()),
                     pa.array(np.concatenate([i for _, i, _ in out]), pa.int64()),
                     pa.array(np.concatenate([s for _, _, s in out]), pa.float64())], names=["query_id", "vec_id", "score"])

    met = index.join(blocks, "dim")  # one row for each shard and block of queries
    tasks = max(shards, spark.sparkContext.defaultParallelism)
    found = rows_each(met, tasks, "name", "block").sortWithinPartitions("name").mapInArrow(look, "query_id bigint, vec_id bigint, score double")
    order = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    result = staged(found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
                    .select("query_id", "rank", "vec_id", "score"), "neighbours-found")
    discard(base, index, blocks)
    return result
