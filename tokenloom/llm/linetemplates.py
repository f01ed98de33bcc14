"""Line dedup by log templates: a tree of fixed depth groups lines, and recurring templates are dropped.

A line's tokens lie between white space; tokens that hold a digit are variable
fields from the start. The tree's path is the number of tokens, then the first
``DEPTH`` tokens. Under a path, lines that agree in ``SIMILAR`` of their places
are linked, and all lines that links lead to share a template. So a line's
template depends on the lines alone, not on their order, number or placing.

1. One narrow pass counts the documents of every path. Only paths that occur in
   ``min_docs`` documents can hold a recurring template; the others' lines go no
   further.
2. The distinct masked lines of those paths are keyed by runs of their further
   tokens, one run more than places may differ, so that lines to be linked have
   a run in common. Lines with a common run share a bucket.
3. Every line of a bucket is compared with the bucket's smallest one. Buckets
   that still hold several components are dealt to blocks of about ``GROUP``
   lines, each task compares two blocks, and components of the links are the
   templates. No task holds a path.
4. A template of ``min_docs`` documents recurs. The document with the smallest
   key keeps its lines, all others lose them.

A line of at most ``DEPTH`` tokens is its own template, its digits aside. A line
of fields alone has nothing to tell it by: it keeps its digits, so that only the
same numbers repeat it. The registered queries use ``EVERY_LINE``: all lines with
text take part, and only the number of documents decides.

Defined results: blank lines and lines below ``min_tokens`` tokens stay. Null
texts stay null, texts without a dropped line stay as they are. A null key
loses nothing and is not counted. Rows that repeat a key are one document.
Other columns are carried along.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from ..session import discard, release, staged
from .components import components
from .words import slices, unused

DEPTH, SIMILAR, FIELD = 3, 0.7, b"<*>"
MIN_DOCS, MIN_TOKENS = 10, 3
EVERY_LINE = {"min_docs": 3, "min_tokens": 1}
GROUP = 1000  # lines of a bucket that one task compares with as many others; no result depends on it
LONG = 64  # tokens up to which a line counts once in its block, and once more for each as many
DIGIT = re.compile(rb"[0-9]")


def masked(line: bytes) -> list[bytes]:
    tokens = line.split()
    if not DIGIT.search(line):
        return tokens
    fields = [FIELD if DIGIT.search(token) else token for token in tokens]
    return fields if any(field is not FIELD for field in fields) else tokens


def _lines(min_tokens: int, whole: bool):
    """(key, text) -> (key, path, line[, masked line]) for each line with enough tokens; path and line are hashes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            for start, texts in slices(batch, 1):
                rows, paths, hashes, contents = [], [], [], []
                for row, text in enumerate(texts, start):
                    for line in set(text.split(b"\n")):
                        tokens = masked(line)
                        if len(tokens) >= min_tokens:
                            content = b" ".join(tokens)
                            rows.append(row)
                            paths.append(digest(b"%d " % len(tokens) + b" ".join(tokens[:DEPTH])))
                            hashes.append(digest(content))
                            contents.append(content.decode())
                arrays = [batch.column(0).take(pa.array(rows, pa.int64())),
                          *(pa.array(np.array(x, np.uint64).view(np.int64)) for x in (paths, hashes))]
                names = ["key", "path", "line"]
                if whole:
                    arrays, names = arrays + [pa.array(contents, pa.string())], names + ["content"]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return run


def parse(contents: list[str]) -> tuple[list[int], list[str]]:
    """Number of the template of each masked line of one path, in the order given, and the templates.

    The greedy parse of lines one after the other, to compare with; no query uses it, as its templates depend on the order.
    """
    templates: list[list[str]] = []
    out = []
    for content in contents:
        tokens = content.split(" ")
        best, most = -1, 0.0
        for number, template in enumerate(templates):
            share = sum(a == b for a, b in zip(template, tokens)) / len(tokens)
            if share > most:
                best, most = number, share
        if best >= 0 and most >= SIMILAR:
            templates[best] = [a if a == b else FIELD.decode() for a, b in zip(templates[best], tokens)]
        else:
            best = len(templates)
            templates.append(tokens)
        out.append(best)
    return out, [" ".join(t) for t in templates]


def runs_of(count: int) -> list[tuple[int, int]]:
    """Runs of places of which similar lines of so many tokens and one path have at least one in common."""
    least = next(k for k in range(int(SIMILAR * count), count + 1) if k / count >= SIMILAR)
    rest, cuts = count - DEPTH, count - least + 1
    if rest < cuts:  # the path alone makes lines similar
        return [(DEPTH, DEPTH)]
    return [(DEPTH + rest * i // cuts, DEPTH + rest * (i + 1) // cuts) for i in range(cuts)]


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, line, content) -> path, line, bucket for each run of lines that are longer than a path."""
    for batch in batches:
        rows, buckets = [], []
        for row, content in enumerate(batch.column(2)):
            tokens = content.as_py().split(" ")
            if len(tokens) > DEPTH:
                for number, (start, end) in enumerate(runs_of(len(tokens))):
                    rows.append(row)
                    buckets.append(xxhash.xxh3_64_intdigest(f"{number} {' '.join(tokens[start:end])}"))
        taken = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(taken), batch.column(1).take(taken),
                                          pa.array(np.array(buckets, np.uint64).view(np.int64))], names=["path", "line", "bucket"])


def _similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of (a, b, content, content) -> the pairs that agree in enough places."""
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            x, y = x.split(" "), y.split(" ")
            keep.append(len(x) == len(y) and sum(map(str.__eq__, x, y)) / len(x) >= SIMILAR)
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _across(table: pa.Table) -> pa.Table:
    """Two blocks of a bucket -> links of similar lines, as many as join the components that they join."""
    one, other = table.column("one")[0].as_py(), table.column("other")[0].as_py()
    names, side = table.column("line").to_numpy(), table.column("block").to_numpy()
    own = np.unique(table.column("root").to_numpy(), return_inverse=True)[1]
    codes: dict[str, int] = {}
    places = np.array([[codes.setdefault(token, len(codes)) for token in content.as_py().split(" ")] for content in table.column("content")], np.int32)
    left, right = np.flatnonzero(side == one), np.flatnonzero(side == other)
    found: list[tuple[int, int]] = []
    for i in left:
        rest = right[(own[right] != own[i]) & ((right > i) if one == other else True)]
        rest = rest[(places[rest] == places[i]).sum(axis=1) / places.shape[1] >= SIMILAR]
        if len(rest):
            met, first = np.unique(own[rest], return_index=True)
            found += [(names[i], names[j]) for j in rest[first]]
            own[np.isin(own, met)] = own[i]
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def dealt(placed: DataFrame, contents: DataFrame) -> DataFrame:
    """(path, bucket, line, root, n) -> the lines of buckets of several components, once for each pair of blocks to compare."""
    split = (placed.groupBy("path", "bucket").agg(F.min("root").alias("low"), F.max("root").alias("high"))
             .where("low != high").select("path", "bucket"))
    weight = F.ceil(F.size(F.split("content", " ", -1)) / LONG)  # the same for all lines of a path
    blocks = F.least("n", F.ceil(F.col("n") * weight / GROUP)).cast("int")
    return (placed.join(split, ["path", "bucket"]).join(contents.select("line", "content"), "line")
            .withColumn("block", F.pmod(F.xxhash64("line"), blocks).cast("int"))
            .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
            .select("path", "bucket", "line", "root", "content", "block",
                    F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other")))


def templates(contents: DataFrame) -> DataFrame:
    """(path, line, content), distinct -> (node, root): lines that share a template with a smaller one. A staged table."""
    keyed = staged(contents.select("path", "line", "content").mapInArrow(_keyed, "path bigint, line bigint, bucket bigint"), "lines-keyed")
    sizes = keyed.groupBy("path", "bucket").agg(F.count(F.lit(1)).alias("n"), F.min("line").alias("leader")).where("n > 1")
    shared = staged(keyed.join(sizes, ["path", "bucket"]), "lines-shared")
    side = lambda name, text: contents.select(F.col("line").alias(name), F.col("content").alias(text))
    stars = shared.where("line != leader").select(F.col("line").alias("a"), F.col("leader").alias("b")).distinct()
    links = staged(stars.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y")
                   .mapInArrow(_similar, "a bigint, b bigint"), "lines-links")
    roots = components(links, "a", "b")
    placed = (shared.join(roots.withColumnRenamed("node", "line"), "line", "left")
              .select("path", "bucket", "line", F.coalesce("root", "line").alias("root"), "n"))
    more = staged(dealt(placed, contents).groupBy("path", "bucket", "one", "other").applyInArrow(_across, "a bigint, b bigint"), "lines-more")
    out = components(links.unionByName(more), "a", "b")
    discard(keyed, shared, links, roots, more)
    return out


def repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                   min_tokens: int = MIN_TOKENS) -> DataFrame:
    """(key, lines): for documents that lose lines, the hashes of those masked lines. A staged table."""
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text")).where("key is not null")
    narrow = staged(rows.mapInArrow(_lines(min_tokens, False), "key bigint, path bigint, line bigint").distinct(), "lines")
    paths = staged(narrow.select("path", "key").distinct().groupBy("path").agg(F.count(F.lit(1)).alias("docs"))
                   .where(F.col("docs") >= min_docs).select("path"), "lines-paths")
    release(spark)
    contents = staged(
        rows.mapInArrow(_lines(min_tokens, True), "key bigint, path bigint, line bigint, content string")
        .join(paths, "path").groupBy("path", "line", "content").agg(F.count(F.lit(1)).alias("n")).drop("n"), "lines-contents")
    release(spark)
    shared = templates(contents)
    found = staged(narrow.join(paths, "path").join(shared.withColumnRenamed("node", "line"), "line", "left")
                   .select("key", "line", F.coalesce("root", "line").alias("merged")), "lines-found")
    recurring = (found.select("merged", "key").distinct().groupBy("merged")
                 .agg(F.count(F.lit(1)).alias("docs"), F.min("key").alias("first")).where(F.col("docs") >= min_docs))
    out = staged(found.join(recurring, "merged").where("key != first").groupBy("key").agg(F.collect_set("line").alias("lines")),
                 "lines-dropped")
    discard(narrow, paths, contents, shared, found)
    release(spark)
    return out


def without_repeated_lines(docs: DataFrame, key: str = "doc_id", text: str = "text", min_docs: int = MIN_DOCS,
                           min_tokens: int = MIN_TOKENS) -> DataFrame:
    """The rows with shortened texts, and n_lines and n_dropped. Columns of these names are replaced."""
    plain = docs.drop("n_lines", "n_dropped")
    of, gone_lines = unused(plain.columns, "_of", "_lines")
    dropped = repeated_lines(docs, key, text, min_docs, min_tokens).withColumnsRenamed({"key": of, "lines": gone_lines})
    # merged by key at every size, so that small and large tables take the same plan
    joined = plain.join(dropped.hint("merge"), F.col(key).cast("bigint") == F.col(of), "left").select(*[F.col(f"`{c}`") for c in plain.columns], gone_lines)
    place, last = plain.columns.index(text), len(plain.columns)
    names = [f"c{i}" for i in range(last + 2)]  # whatever the columns' own names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digest = xxhash.xxh3_64_intdigest
        for batch in batches:
            texts, lines, lost = [], [], []
            for value, gone in zip(batch.column(place), batch.column(last)):
                content = value.as_py()
                split = content.split("\n") if content is not None else []
                if gone.is_valid:
                    go = set(gone.values.to_numpy().view(np.uint64).tolist())
                    kept = [line for line in split
                            if len(tokens := masked(line.encode())) < min_tokens or digest(b" ".join(tokens)) not in go]
                    content = "\n".join(kept)
                else:
                    kept = split
                texts.append(content)
                lines.append(len(split))
                lost.append(len(split) - len(kept))
            columns = [*batch.columns[:-1], pa.array(lines, pa.int64()), pa.array(lost, pa.int64())]
            columns[place] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kinds = [*(field.dataType for field in plain.schema.fields), LongType(), LongType()]
    schema = StructType([StructField(name, kind) for name, kind in zip(names, kinds)])
    return joined.toDF(*names[:-1]).mapInArrow(run, schema).toDF(*plain.columns, "n_lines", "n_dropped")
