"""Exact dedup: local, salted and global combining of equal contents.

Rows meet by the digest of their content, but only equal contents are ever
combined: the content itself is part of the grouping key in all three steps.

1. Each task combines the equal contents it holds (the map side of the first
   aggregation).
2. Digest groups are merged under a salt taken from the row's key, so a content
   that fills a third of the table is shared by ``salts`` tasks.
3. The salts' winners, at most ``salts`` rows a content, are combined globally.

A last, narrow join carries the winner to every row; it moves keys and digests
only, and its hot digests are split by the adaptive skew join.

Defined results: a null text is an empty one. A null key takes part in groups
but never wins over another key. Rows that repeat one key with equal contents
are counted one by one and get the same answer, ``kept`` included. Other
columns are ignored. An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import staged
from .words import texts_of

SALTS = 32
UPPER, LOWER = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz"
A_TO_Z = bytes.maketrans(UPPER, LOWER)  # bytes of other letters in UTF-8 are all above 127

Digest = Callable[[bytes], bytes]


def sha256(content: bytes) -> bytes:
    return hashlib.sha256(content).digest()


def _facts(rows: DataFrame, key_type: str, digest: Digest, contents: bool) -> DataFrame:
    """(key, digest and, if asked for, normalised content) of rows (key, text)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [value.as_py().translate(A_TO_Z) for value in texts_of(batch.column(1))]
            columns = [batch.column(0), pa.array([digest(x) for x in texts], pa.binary())]
            names = ["key", "digest"]
            if contents:
                columns, names = columns + [pa.array(texts, pa.binary())], names + ["content"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return rows.mapInArrow(read, f"key {key_type}, digest binary" + (", content binary" if contents else ""))


def _combined(facts: DataFrame, salts: int) -> DataFrame:
    """One row per content: (digest, content, largest key, rows)."""
    salted = (
        facts.groupBy("digest", "content", F.pmod(F.xxhash64("key"), F.lit(salts)).alias("salt"))
        .agg(F.max("key").alias("keep"), F.count(F.lit(1)).alias("rows"))
    )
    return salted.groupBy("digest", "content").agg(F.max("keep").alias("keep"), F.sum("rows").alias("rows"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", salts: int = SALTS,
                 digest: Digest = sha256) -> DataFrame:
    """One row per input row: key, keep_id, group_size, kept, digest.

    Texts are equal if identical after lower-casing A-Z; the largest key of
    equal texts stays. ``digest`` only routes rows: contents that differ under
    one digest are told apart by the contents themselves.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    key_type = rows.schema["key"].dataType.simpleString()
    facts = _facts(rows, key_type, digest, contents=True)
    winners = staged(
        _combined(facts, salts).groupBy("digest")
        .agg(F.max("keep").alias("keep"), F.max("rows").alias("rows"), F.count(F.lit(1)).alias("contents")),
        "exact-winners",
    )
    single = winners.where("contents = 1").drop("contents")
    found = _facts(rows, key_type, digest, contents=False).join(single, "digest")
    clashes = winners.where("contents > 1").select("digest")
    if not clashes.isEmpty():  # one digest, several contents: these digests meet by content
        clashing = facts.join(clashes, "digest", "left_semi")
        found = found.unionByName(clashing.join(_combined(clashing, salts), ["digest", "content"]).drop("content"))
    return found.select(
        F.col("key").alias(key), F.col("keep").alias("keep_id"), F.col("rows").alias("group_size"),
        F.col("key").eqNullSafe(F.col("keep")).alias("kept"), "digest",
    )
