"""Token ids in flat files: unsigned integers, 64-bit document offsets and document keys, in ascending key order.

Part ``p`` of a corpus is three little-endian files: ``.ids`` (16 bits an id if
the vocabulary allows it, else 32), ``.offsets`` (one more than documents; the
first is 0) and ``.keys``. Parts follow one another in key order; where a part
begins in the whole sequence of ids is the prefix sum of the parts before it,
one number a part. Files are read back memory-mapped.

Texts are cut at ASCII white space, and each distinct run is encoded once per
worker process: the tokenizer drops white space and never joins across it. Arrow
cuts a slice of texts, numbers its distinct runs and lines up their ids, so only
the distinct runs of a slice are looked up one by one. The tokenizer also
lower-cases, and it cuts between letters and the punctuation after them, so a
run of letters with closing punctuation is looked up by its letters. Pieces that
are new are asked for together, as one text or one list of words, and words of
Latin-1 letters without the steps that leave such words as they are. When the
tables are half full they become the older ones, which give back what is seen
again and are dropped at the next turn, so memory does not grow with the corpus.

Defined results: null and empty texts hold the end id only. A null key sorts
first; each part knows how many of its keys are null. Rows that repeat a key
are documents of their own, in any order among themselves. Other columns are
ignored; an empty table gives no part.
"""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window as W, functions as F

from ..session import release, staged
from .files import array, attempt_name, new_folder, output, rows_each
from .words import ENTRY_BYTES, LONG_WORD, slices

TABLE_BYTES = 300_000_000  # of all tables together
SLICE_BYTES = 3_000_000  # texts are encoded in slices of about this size
ASKED = 2000  # pieces asked for at once
CLOSING = b".,!?;:\"#$%&()*+-/=@[\\]^_`{}~"  # ASCII punctuation but the apostrophe and what special tokens are marked with
# steps that lower-case a word of Latin-1 letters, leave it whole and write its bytes as symbols
STEPS = {
    "normalizer": {"type": "Sequence", "normalizers": [
        {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]},
    "pre_tokenizer": {"type": "Sequence", "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False}]}}


class Encoder:
    """Encodes texts run by run with a tokenizers file."""

    _opened: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks already use all cores
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.kind = np.dtype(id_type(path)).char
        self.added = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.ends = self._word_ends()
        self.bare = self._without_steps()
        self.runs: dict[bytes, bytes] = {}  # white-space runs -> ids
        self.pieces: dict[str, bytes] = {"": b""}  # what the tokenizer was asked -> ids
        self.size = 0  # bytes of both tables, about
        self.older: tuple[dict[bytes, bytes], dict[str, bytes]] = ({}, {})

    @classmethod
    def of(cls, path: str) -> "Encoder":
        """The worker process's encoder of this file; its tables serve all tasks that run there."""
        if path not in cls._opened:
            cls._opened[path] = cls(path)
        return cls._opened[path]

    @staticmethod
    def _parts(run: bytes) -> tuple[str, str]:
        """A run as two texts whose ids follow one another."""
        letters = run.rstrip(CLOSING)
        text = letters.lower().decode()  # of bytes: A-Z only
        if text.isalpha():  # no apostrophes, marks or special tokens, so the cut and the case do not matter
            return text, run[len(letters):].decode()
        return run.decode(), ""

    def _word_ends(self) -> np.ndarray | None:
        """Whether an id ends a word; None if the tokenizer does not mark that in every word."""
        from tokenizers.pre_tokenizers import ByteLevel

        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        known = self.tokenizer.get_vocab(with_added_tokens=True)
        if not suffix or any(letter + suffix not in known for letter in ByteLevel.alphabet()) \
                or any(re.sub(r"\s", "", token).isalpha() for token in self.added):
            return None
        ends = np.zeros(max(known.values()) + 1, bool)
        ends[[number for token, number in known.items() if token.endswith(suffix) and token not in self.added]] = True
        return ends

    def _without_steps(self):
        """The tokenizer for lower-case words of Latin-1 letters, which need no cutting; None if its steps are not known to leave them whole."""
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, WhitespaceSplit

        steps = {name: getattr(self.tokenizer, name) for name in STEPS}
        if self.ends is None or any(step is None or json.loads(step.__getstate__()) != STEPS[name] for name, step in steps.items()):
            return None
        bare = Tokenizer(self.tokenizer.model)
        bare.pre_tokenizer = Sequence([WhitespaceSplit(), ByteLevel(add_prefix_space=False, use_regex=False)])
        return bare

    @staticmethod
    def _kind(piece: str) -> int:
        """0: Latin-1 letters, 1: other letters, 2: anything else."""
        if not piece.isalpha():
            return 2
        return 0 if piece.isascii() or len(piece.encode("latin-1", "ignore")) == len(piece) else 1

    def _asked(self, pieces: list[str], kind: int) -> list[bytes]:
        """The ids of each of some pieces without white space, all of one kind."""
        numbers = None
        if kind < 2 and self.ends is not None:  # a piece is at least one word, so it is one if there are as many words
            text, tokenizer = " ".join(pieces), self.tokenizer
            if kind == 0 and self.bare:
                text, tokenizer = text.lower(), self.bare
            numbers = np.array(tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
            bounds = np.flatnonzero(self.ends[numbers]) + 1
            numbers = numbers if len(bounds) == len(pieces) else None
        if numbers is None:
            found = self.tokenizer.encode(pieces, is_pretokenized=True, add_special_tokens=False)
            numbers = np.array(found.ids, np.int64)
            bounds = np.cumsum(np.bincount(np.array(found.word_ids, np.int64), minlength=len(pieces)))
        content, width = numbers.astype(f"<{self.kind}").tobytes(), np.dtype(self.kind).itemsize
        bounds = [0, *(bounds * width).tolist()]
        return [content[a:b] for a, b in zip(bounds, bounds[1:])]

    def _fill(self, table: dict, added: list, values: list[bytes]) -> None:
        table.update(zip(added, values))
        self.size += sum(map(len, added)) + sum(map(len, values)) + ENTRY_BYTES * len(added)

    def _learn_pieces(self, wanted: list[str]) -> None:
        """Fills the table of pieces, from the older one where that has them."""
        older = self.older[1]
        again = [piece for piece in wanted if piece in older] if older else []
        self._fill(self.pieces, again, list(map(older.__getitem__, again)))
        new = [piece for piece in wanted if piece not in older] if again else wanted
        kinds = list(map(self._kind, new))
        for kind in range(3):
            own = [piece for piece, its in zip(new, kinds) if its == kind]
            for low in range(0, len(own), ASKED):
                some = own[low:low + ASKED]
                self._fill(self.pieces, some, self._asked(some, kind))

    def _learn(self, wanted: list[bytes]) -> list[bytes]:
        """The ids of distinct runs that the table lacks; it has them afterwards, but for long ones."""
        found = list(map(self.older[0].get, wanted)) if self.older[0] else [None] * len(wanted)
        unseen, pieces = [run for run, ids in zip(wanted, found) if ids is None], self.pieces
        cut = list(chain.from_iterable(map(self._parts, unseen)))  # flat, as many small tuples would keep the collector busy
        new = list(set(cut).difference(pieces))
        self._learn_pieces(new)
        ids = map(pieces.__getitem__, cut)
        found = _completed(found, [first + second for first, second in zip(ids, ids)])
        self._fill(self.runs, wanted, found)
        for table, added in ((pieces, new), (self.runs, unseen)):
            for long in [entry for entry in added if len(entry) > LONG_WORD]:
                self.size -= len(long) + len(table.pop(long)) + ENTRY_BYTES
        return found

    def encode(self, texts: list[bytes], end: bytes) -> list[bytes]:
        if not texts:
            return []
        if self.size > TABLE_BYTES // 2:
            self.older = self.runs, self.pieces
            self.runs, self.pieces, self.size = {}, {"": b""}, 0
        split = pc.ascii_split_whitespace(pa.array(texts, pa.binary()).cast(pa.string()))  # white space around a text gives an empty run
        numbered = split.values.dictionary_encode()
        distinct = numbered.dictionary.cast(pa.binary()).to_numpy(zero_copy_only=False).tolist()
        known = list(map(self.runs.get, distinct))
        known = _completed(known, self._learn([run for run, ids in zip(distinct, known) if ids is None]))
        stops = split.offsets.to_numpy()[1:]
        order = np.insert(numbered.indices.to_numpy(), stops, len(known))  # each text is followed by the end
        lined = pa.array([*known, end], pa.large_binary()).take(pa.array(order))
        content, places = lined.buffers()[2].to_pybytes(), np.frombuffer(lined.buffers()[1], np.int64)
        bounds = [0, *places[stops + np.arange(1, len(stops) + 1)].tolist()]
        return [content[a:b] for a, b in zip(bounds, bounds[1:])]


def _completed(found: list, rest: list) -> list:
    """``found`` with what is None in it taken from ``rest``, in order."""
    left = iter(rest)
    return [next(left) if value is None else value for value in found]


def id_type(path: str) -> str:
    """The smallest of 16 and 32 bits that holds every id."""
    from tokenizers import Tokenizer

    return "<u2" if Tokenizer.from_file(path).get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4"


def write_tokens(docs: DataFrame, tokenizer: str, end_id: int, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str, str]:
    """Writes all texts; gives the parts (part, name, docs, nulls, tokens, base), their folder and the ids' type."""
    spark = docs.sparkSession
    dtype, folder = id_type(tokenizer), new_folder(spark, "tokens")
    end = np.array([end_id], dtype).tobytes()
    rows = docs.select(F.col(key).cast("bigint").alias("key"), F.col(text).cast("string").alias("text"))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, width, encoder = attempt_name(), np.dtype(dtype).itemsize, Encoder.of(tokenizer)
        keys, ends, total, nulls = [], [np.zeros(1, np.int64)], 0, 0
        stream = None
        for batch in batches:
            for start, texts in slices(batch, 1, SLICE_BYTES):
                stream = stream or output(f"{folder}/{name}.ids")
                encoded = encoder.encode(texts, end)
                stream.write(b"".join(encoded))
                ends.append(total + np.cumsum([len(ids) // width for ids in encoded]))
                total = int(ends[-1][-1])
                own = batch.column(0).slice(start, len(texts))
                nulls += own.null_count  # they are the first of all
                keys.append(own.fill_null(0).to_numpy())
        if stream:
            stream.close()
            for suffix, parts in (("offsets", ends), ("keys", keys)):
                with output(f"{folder}/{name}.{suffix}") as out:
                    out.write(np.concatenate(parts).astype("<i8").tobytes())
            yield pa.RecordBatch.from_pydict({"part": [TaskContext.get().partitionId()], "name": [name],
                                              "docs": [sum(map(len, keys))], "nulls": [nulls], "tokens": [total]})

    # ranges are sampled from the plain rows, so no text is encoded twice
    parts = staged(rows.repartitionByRange("key").sortWithinPartitions("key")
                   .mapInArrow(write, "part bigint, name string, docs bigint, nulls bigint, tokens bigint"), "tokens-parts")
    release(spark)
    before = W.orderBy("part").rowsBetween(W.unboundedPreceding, -1)  # one row a part
    return parts.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0))), folder, dtype


def read_tokens(parts: DataFrame, folder: str, dtype: str) -> DataFrame:
    """Reads the files back: key, start in the whole sequence, number of ids, crc32 of the ids as 32-bit integers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name, base, nulls in zip(*(column.to_pylist() for column in batch.columns)):
                ids = array(f"{folder}/{name}.ids", dtype)
                offsets, keys = array(f"{folder}/{name}.offsets", "<i8"), array(f"{folder}/{name}.keys", "<i8")
                for low in range(0, len(keys), 5000):
                    cut = offsets[low:low + 5001]
                    crc = [zlib.crc32(ids[a:b].astype("<u4").tobytes()) for a, b in zip(cut[:-1], cut[1:])]
                    some = np.array(keys[low:low + 5000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(some, mask=np.arange(low, low + len(some)) < nulls), pa.array(base + cut[:-1]), pa.array(np.diff(cut)), pa.array(crc, pa.int64())],
                        names=["key", "start", "n_tokens", "ids_crc32"])

    return (rows_each(parts.select("name", "base", "nulls"), parts.sparkSession.sparkContext.defaultParallelism, "name")
            .mapInArrow(read, "key bigint, start bigint, n_tokens bigint, ids_crc32 bigint"))
