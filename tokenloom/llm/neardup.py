"""Near duplicates by MinHash, banding, verification and connected components.

1. One pass reads every text: number of words' shingles, digest of its word
   sequence, and the minima of ``BANDS * ROWS`` universal hash functions over
   its shingles. Rows with equal word sequences form a class at once, which goes
   on as one node, so copies are never paired. Nodes are numbered, as one key may
   stand for several texts.
2. A band is ``ROWS`` minima; texts with an equal band share a bucket. A pair at
   similarity 0.8 misses all 32 bands of 5 with probability 3e-6.
3. Every member of a bucket is paired with one leader only, the member met in
   most buckets (in a family of copies that is the text nearest to all others).
   Candidates must agree in enough minima, then their full shingle sets are
   compared. Confirmed links give components.
4. Buckets that still hold several components are compared inside: members
   are dealt to blocks, each task compares the signatures of two blocks, and
   only pairs of different components that may be similar leave it. A bitmap of
   each set bounds the similarity from above without loss, so few of the pairs
   that leave are below the threshold. They are confirmed on full sets as well.
   After this, any linked pair that shares a bucket is in one component,
   whatever the bucket's size.

Defined results: null and blank texts have no shingles and are linked with
nothing. A text with fewer words than a shingle is one shingle, so it is linked
with equal word sequences only. A null key takes part in nothing. Rows that
repeat a key with the same text get the same answer; with different texts they
are told apart by the digest of their words, and each is linked as its own text.
Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..session import discard, release, staged
from .components import components
from .words import WordTable, mixed, slices, starts_of, window_hashes

BANDS, ROWS = 32, 5
BLOCK = 512  # members of a bucket that one task compares with as many others
HASH_STEP = 4096  # shingles hashed at a time, so that the work stays in the cache
BITMAP = 4096  # bits of a set's bitmap
SPREAD = 5.0  # standard deviations below the expected agreement at which a signature rules a pair out
SHINGLE_BASE = 0x9E3779B97F4A7C15


def _families(count: int) -> tuple[np.ndarray, np.ndarray]:
    """Odd multipliers and offsets of the universal hash functions x -> a*x + b."""
    draw = np.random.default_rng(20240517)
    return draw.integers(0, 2**64, count, np.uint64) | np.uint64(1), draw.integers(0, 2**64, count, np.uint64)


def minima(shingles: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """Upper halves of the smallest hash values: one row per run of shingles, one column per hash function."""
    a, b = _families(count)
    lengths = np.diff(np.append(starts, len(shingles)))
    out = np.full((len(starts), count), np.iinfo(np.uint64).max, np.uint64)
    with np.errstate(over="ignore"):
        for low in range(0, len(shingles), HASH_STEP):
            part = shingles[low:low + HASH_STEP]
            first = int(np.searchsorted(starts, low, "right")) - 1
            last = int(np.searchsorted(starts, low + len(part), "left"))
            cuts = np.maximum(starts[first:last] - low, 0)
            for k in range(count):
                found = np.minimum.reduceat(part * a[k] + b[k], cuts)
                np.minimum(out[first:last, k], found, out=out[first:last, k])
    assert lengths.all()
    return (out >> np.uint64(32)).astype(np.uint32)


def _shingles(table: WordTable, words: list[bytes], counts: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of documents whose words lie side by side, and how many each has (repeats included)."""
    hashes = window_hashes(table.hashes(words), width, SHINGLE_BASE)
    per = np.maximum(counts - width + 1, 0)
    where = np.repeat(starts_of(counts) - starts_of(per), per) + np.arange(int(per.sum()))
    return hashes[where], per


def _read(width: int):
    """Batches of (key, text) -> key, words' digest, set size, signature (null without a full shingle)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable()
        for batch in batches:
            for start, texts in slices(batch, 1):
                split = [text.lower().split() for text in texts]  # bytes.lower changes A-Z only
                counts = np.array([len(words) for words in split], np.int64)
                digests = [hashlib.sha256(b" ".join(words)).digest() if words else None for words in split]
                shingles, per = _shingles(table, [word for words in split for word in words], counts, width)
                at = starts_of(per)
                sizes = [len(np.unique(shingles[s:s + n])) if n else min(int(c), 1) for s, n, c in zip(at, per, counts)]
                signatures: list[bytes | None] = [None] * len(texts)
                full = np.flatnonzero(per)
                if len(full):
                    found = minima(shingles, at[full], BANDS * ROWS)
                    for row, signature in zip(full, found):
                        signatures[row] = signature.tobytes()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(digests, pa.binary()), pa.array(sizes, pa.int64()),
                     pa.array(signatures, pa.binary())], names=["key", "digest", "size", "signature"])

    return run


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit per residue of the shingle hashes."""
    bits = np.zeros(BITMAP, bool)
    bits[(shingles % np.uint64(BITMAP)).astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def _sets(width: int):
    """Batches of (node, text, digest) -> node, sorted distinct shingle hashes, how many, their bitmap; texts of other digests are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = WordTable()
        for batch in batches:
            for start, texts in slices(batch, 1):
                asked = batch.column(2).slice(start, len(texts)).to_pylist()
                split = [text.lower().split() for text in texts]
                own = [i for i, (words, digest) in enumerate(zip(split, asked)) if hashlib.sha256(b" ".join(words)).digest() == digest]
                split = [split[i] for i in own]
                counts = np.array([len(words) for words in split], np.int64)
                shingles, per = _shingles(table, [word for words in split for word in words], counts, width)
                sets = [np.unique(shingles[s:s + n]) for s, n in zip(starts_of(per), per)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)).take(pa.array(own, pa.int64())), pa.array([x.tobytes() for x in sets], pa.binary()),
                     pa.array([len(x) for x in sets], pa.int64()), pa.array([bitmap(x) for x in sets], pa.binary())],
                    names=["key", "shingles", "size", "bits"])

    return run


def _confirm(percent: int):
    """Batches of (a, b, set, set) -> the pairs whose Jaccard similarity reaches the threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for left, right in zip(batch.column(2), batch.column(3)):
                x, y = (np.frombuffer(side.as_buffer(), np.uint64) for side in (left, right))
                small, large = sorted((len(x), len(y)))
                if 100 * small < percent * large:
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    return run


def least_agreement(percent: int) -> int:
    """Minima that a pair at the threshold shares with all but negligible probability."""
    n, p = BANDS * ROWS, percent / 100
    return int(n * p - SPREAD * (n * p * (1 - p)) ** 0.5)


def _plausible(percent: int):
    """Batches of (a, b, signature, signature) -> the pairs whose signatures agree often enough."""
    least = least_agreement(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint32).reshape(batch.num_rows, -1) for i in (2, 3))
                yield batch.select([0, 1]).filter(pa.array((x == y).sum(axis=1) >= least))

    return run


def possible(bits: np.ndarray, size: int, others: np.ndarray, sizes: np.ndarray, percent: int) -> np.ndarray:
    """Whether a set may reach the threshold with each of the others.

    A bit that only one bitmap has stands for at least one shingle that the
    other set lacks, which bounds the common shingles from above.
    """
    common = np.minimum(size - np.bitwise_count(bits & ~others).sum(axis=1, dtype=np.int64),
                        sizes - np.bitwise_count(others & ~bits).sum(axis=1, dtype=np.int64))
    return 100 * common >= percent * (size + sizes - common)


def _across(percent: int, key_type: pa.DataType):
    """One pair of blocks of a bucket -> plausible pairs of different components.

    A pair that shares several buckets is given by its first one only.
    """
    least = least_agreement(percent)

    def run(group: tuple, table: pa.Table) -> pa.Table:
        band, one, other = (table.column(name)[0].as_py() for name in ("band", "one", "other"))
        side = table.column("block").to_numpy()
        names = table.column("key").to_numpy()
        roots = table.column("root").to_numpy()
        signs = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(len(names), -1)
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(names), -1)
        sizes = table.column("size").to_numpy()
        left, right = np.flatnonzero(side == one), np.flatnonzero(side == other)
        found_a, found_b = [], []
        for i in left:
            rest = right[(roots[right] != roots[i]) & ((names[right] > names[i]) if one == other else True)]
            if not len(rest):
                continue
            equal = signs[rest] == signs[i]
            near = equal.sum(axis=1) >= least
            rest, equal = rest[near], equal[near]
            near = possible(bits[i], sizes[i], bits[rest], sizes[rest], percent)
            rest, equal = rest[near], equal[near]
            if len(rest):
                first = equal.reshape(len(rest), BANDS, ROWS).all(axis=2).argmax(axis=1) == band
                found_a += [names[i]] * int(first.sum())
                found_b += list(names[rest[first]])
        return pa.table({"a": pa.array(found_a, key_type), "b": pa.array(found_b, key_type)})

    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) confirmed on full shingle sets, as a staged table."""
    type_of = pairs.schema["a"].dataType.simpleString()
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("y"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return staged(joined.mapInArrow(_confirm(percent), f"a {type_of}, b {type_of}"), "neardup-links")


def words_digest(text: Column) -> Column:
    """The digest by which rows of a key are told apart: SHA-256 of a text's lower-cased (A-Z) words; null without words."""
    spaced = F.trim(F.regexp_replace(text, r"[\x20\x09-\x0D]+", " "))
    lower = F.translate(spaced, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.when(F.length(spaced) > 0, F.unhex(F.sha2(lower, 256)))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", width: int = 5, percent: int = 80) -> DataFrame:
    """One row per input row: key, n_shingles, component_id, kept, digest, stays.

    Texts are linked if 100 * common shingles >= percent * all shingles of both
    (words of ``width``, lower-cased A-Z); component_id is the smallest key that
    links lead to, and ``kept`` says that it is the row's own. ``digest`` is that
    of the row's words, and ``stays`` marks one text of each component, where
    ``kept`` would mark two texts of one key. Keys are integers.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))
    read = staged(rows.mapInArrow(_read(width), "key bigint, digest binary, size bigint, signature binary"), "neardup-read")
    classes = staged(read.where("digest is not null").groupBy("digest").agg(F.min("key").alias("first"), F.max("size").alias("size"))
                     .where("first is not null").withColumn("node", F.monotonically_increasing_id()), "neardup-classes")
    # one row per class: the signature of its first key
    signed = staged(read.where("signature is not null").join(classes.select("digest", F.col("first").alias("key"), "node"), ["key", "digest"])
                    .select(F.col("node").alias("key"), "signature").distinct(), "neardup-signed")

    bytes_of = 4 * ROWS
    bands = signed.select("key", F.posexplode(F.array(*[
        F.xxhash64(F.substring("signature", 1 + i * bytes_of, bytes_of), F.lit(i)) for i in range(BANDS)])).alias("band", "bucket"))
    sizes = bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    shared = staged(bands.join(sizes, "bucket"), "neardup-shared")
    release(spark)

    met = shared.groupBy("key").agg(F.sum("n").alias("met"))
    leaders = (shared.join(met, "key").groupBy("bucket")
               .agg(F.max(F.struct("met", (-F.col("key")).alias("minus"))).alias("top"))
               .select("bucket", (-F.col("top.minus")).alias("leader")))
    stars = (shared.join(leaders, "bucket").where("key != leader")
             .select(F.greatest("key", "leader").alias("a"), F.least("key", "leader").alias("b")).distinct())
    signs = signed.select(F.col("key").alias("b"), F.col("signature").alias("y"))
    likely = staged(
        stars.join(signed.withColumnsRenamed({"key": "a", "signature": "x"}), "a").join(signs, "b").select("a", "b", "x", "y")
        .mapInArrow(_plausible(percent), "a bigint, b bigint"), "neardup-likely")
    candidates = shared.select(F.col("key").alias("node")).distinct().join(classes, "node").select(F.col("first").alias("key"), "node", "digest")
    sets = staged(rows.join(candidates, "key").select("node", "text", "digest").mapInArrow(
        _sets(width), "key bigint, shingles binary, size bigint, bits binary").dropDuplicates(["key"]), "neardup-sets")
    release(spark)
    links = _links(likely, sets, percent)
    roots = components(links, "a", "b")

    placed = (shared.join(roots.select(F.col("node").alias("key"), "root"), "key", "left")
              .withColumn("root", F.coalesce("root", "key")))
    split = (placed.groupBy("bucket", "band").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.max("n").alias("n"))
             .where("low != high").select("bucket", "band", "n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    dealt = (
        placed.select("key", "root", "bucket").join(split, "bucket").join(signed, "key")
        .join(sets.select("key", "size", "bits"), "key")
        .withColumn("block", F.pmod(F.xxhash64("key"), blocks).cast("int"))
        .withColumn("with", F.explode(F.sequence(F.lit(0), blocks - 1)))
        .select("bucket", "band", "key", "root", "signature", "size", "bits", "block",
                F.least("block", "with").alias("one"), F.greatest("block", "with").alias("other"))
    )
    across = (dealt.groupBy("bucket", "one", "other")
              .applyInArrow(_across(percent, pa.int64()), "a bigint, b bigint").distinct())
    more = _links(across, sets, percent)
    every = components(links.unionByName(more), "a", "b")

    # a component is named by its smallest key, and one of that key's texts stays
    tied = every.unionByName(every.select(F.col("root").alias("node"), "root").distinct()).join(classes.select("node", "first"), "node")
    named = tied.groupBy("root").agg(F.min("first").alias("component"), F.min(F.struct("first", "node")).alias("stays"))
    answers = (tied.join(named, "root").select("node", "component", (F.col("node") == F.col("stays.node")).alias("one"))
               .unionByName(classes.join(tied, "node", "left_anti").select("node", F.col("first").alias("component"), F.lit(True).alias("one"))))
    by_class = staged(classes.select("node", "digest", "size").join(answers, "node").drop("node"), "neardup-answers")
    discard(shared, likely, sets, links, more, signed, roots, every, classes)
    release(spark)
    found = (read.select("key", "digest").where("key is not null and digest is not null").join(by_class, "digest")
             .select("key", "digest", "size", "component", (F.col("one") & (F.col("key") == F.col("component"))).alias("stays")))
    alone = read.where("digest is null or key is null").select(
        "key", "digest", "size", F.col("key").alias("component"), F.lit(True).alias("stays"))
    return found.unionByName(alone).select(
        F.col("key").alias(key), F.col("size").alias("n_shingles"), F.col("component").alias("component_id"),
        F.col("key").eqNullSafe(F.col("component")).alias("kept"), "digest", "stays")
