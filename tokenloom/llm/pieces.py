"""SentencePiece encoding and decoding: an Aho-Corasick automaton over the pieces drives a single-pass Viterbi.

The automaton reports, at each end position, every piece that ends there, the
longest first and the shorter ones along its output links; each relaxes the best
score of that position. A character that no piece covers costs a penalty below
all scores and is written as its UTF-8 bytes. Equal scores keep the longer last
piece.

As in the model's own rule, a space becomes the mark U+2581 and one mark is put
in front of the text. No piece has a mark after another character, so a best
path is the best paths of the runs between such places side by side, and each
distinct run is parsed once per worker process. The table of runs is emptied
when it is full. A U+2581 in the text itself is written as bytes, so that
decoding gives back every text exactly.

Defined results: a null text has no pieces and decodes to null; an empty one has
none and decodes to the empty text. Keys may be null or repeated; other columns
are carried along.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StringType, StructField, StructType

from .words import ENTRY_BYTES, LONG_WORD, SLICE_BYTES, TABLE_BYTES

MARK = "▁"
PENALTY = 10.0  # of an uncovered character, below the lowest score


class Pieces:
    """Pieces and scores of a model file."""

    _opened: dict[str, "Pieces"] = {}

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.text: list[bytes] = []  # what a piece decodes to
        self.bytes = [0] * 256
        self.automaton = ahocorasick.Automaton()
        lowest = 0.0
        for number in range(model.get_piece_size()):
            piece = model.id_to_piece(number)
            self.text.append(piece.replace(MARK, " ").encode())
            if model.is_byte(number):
                self.bytes[int(piece[1:-1], 16)] = number
                self.text[-1] = bytes([int(piece[1:-1], 16)])
            elif model.is_control(number) or model.is_unknown(number) or model.is_unused(number):
                self.text[-1] = b""
            else:
                self.automaton.add_word(piece, (len(piece), model.get_score(number), number))
                lowest = min(lowest, model.get_score(number))
                assert MARK not in piece.lstrip(MARK)
        self.automaton.make_automaton()
        self.unknown = lowest - PENALTY
        self.runs: dict[str, list[int]] = {}
        self.size = 0  # bytes of the table, about

    @classmethod
    def of(cls, path: str) -> "Pieces":
        if path not in cls._opened:
            cls._opened[path] = cls(path)
        return cls._opened[path]

    def best_path(self, run: str) -> list[int]:
        """Pieces of the best score over a run of marks and characters."""
        count = len(run)
        best = [0.0] + [float("-inf")] * count
        last = [(1, -1)] * (count + 1)
        done = 0

        def close(upto: int) -> None:  # positions whose last character no piece covers
            nonlocal done
            while done < upto:
                done += 1
                if best[done - 1] + self.unknown > best[done]:
                    best[done], last[done] = best[done - 1] + self.unknown, (1, -1)

        for end, (length, score, number) in self.automaton.iter(run):
            close(end)
            through = best[end + 1 - length] + score
            if through > best[end + 1]:
                best[end + 1], last[end + 1] = through, (length, number)
        close(count)
        out: list[int] = []
        at = count
        while at:
            length, number = last[at]
            out += [number] if number >= 0 else [self.bytes[b] for b in reversed(run[at - length:at].encode())]
            at -= length
        return out[::-1]

    def _parse(self, run: str) -> list[int]:
        """A run of spaces and other characters; marks in it are literal."""
        body = run.lstrip(" ")
        lead = MARK * (len(run) - len(body))
        parts = body.split(MARK)
        found = self.best_path(lead + parts[0])
        for part in parts[1:]:
            found += [self.bytes[b] for b in MARK.encode()] + (self.best_path(part) if part else [])
        if len(run) <= LONG_WORD:
            if self.size >= TABLE_BYTES:
                self.runs.clear()
                self.size = 0
            self.runs[run] = found
            self.size += len(run) + 8 * len(found) + ENTRY_BYTES
        return found

    def encode(self, text: str) -> list[int]:
        if not text:
            return []
        words, out, lead = text.split(" "), [], " "
        look = self.runs.get
        for position, word in enumerate(words):
            if not word and position + 1 < len(words):
                lead += " "  # several spaces belong to the run that follows
                continue
            run = lead + word
            out += look(run) or self._parse(run)
            lead = " "
        return out

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.text.__getitem__, ids))[1:].decode("utf-8", "replace")


def _append(docs: DataFrame, fields: StructType, text: str, work) -> DataFrame:
    """Rows with more columns made from ``text`` by ``work(list of texts) -> arrays``, a bounded slice at a time."""
    place, names = docs.columns.index(text), [*docs.columns, *fields.fieldNames()]
    schema = StructType([*docs.schema.fields, *fields.fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths = pc.binary_length(batch.column(place)).fill_null(0).to_numpy()
            cuts = np.flatnonzero(np.diff(np.cumsum(lengths) // SLICE_BYTES)) + 1
            for low, high in zip([0, *cuts], [*cuts, batch.num_rows]):
                part = batch.slice(low, high - low)
                if part.num_rows:
                    yield pa.RecordBatch.from_arrays([*part.columns, *work(part.column(place).to_pylist())], names=names)

    return docs.mapInArrow(run, schema)


def encode(docs: DataFrame, model: str, text: str = "text", column: str = "pieces") -> DataFrame:
    """The rows with their texts' piece ids. A column of that name is replaced."""

    def work(texts: list) -> list[pa.Array]:
        pieces = Pieces.of(model)
        return [pa.array([None if t is None else pieces.encode(t) for t in texts], pa.list_(pa.int32()))]

    fields = StructType([StructField(column, ArrayType(IntegerType()))])
    return _append(docs.drop(column), fields, text, work)


def encode_checked(docs: DataFrame, model: str, text: str = "text") -> DataFrame:
    """The rows with pieces, n_pieces and round_trip (whether the pieces decode to the text); columns of these names are replaced."""

    def work(texts: list) -> list[pa.Array]:
        pieces = Pieces.of(model)
        found = [None if t is None else pieces.encode(t) for t in texts]
        return [pa.array(found, pa.list_(pa.int32())), pa.array([len(ids or ()) for ids in found], pa.int64()),
                pa.array([t is None or pieces.decode(ids) == t for t, ids in zip(texts, found)], pa.bool_())]

    fields = StructType([StructField("pieces", ArrayType(IntegerType())), StructField("n_pieces", LongType()),
                         StructField("round_trip", BooleanType())])
    return _append(docs.drop(*fields.fieldNames()), fields, text, work)


def decode(rows: DataFrame, model: str, column: str = "pieces", text: str = "decoded") -> DataFrame:
    """The rows with the texts their piece ids stand for. A column of that name is replaced."""
    rows = rows.drop(text)
    place, names = rows.columns.index(column), [*rows.columns, text]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(model)
        for batch in batches:
            for low in range(0, batch.num_rows, 200):
                part = batch.slice(low, 200)
                texts = [None if ids is None else pieces.decode(ids) for ids in part.column(place).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], names=names)

    return rows.mapInArrow(run, StructType([*rows.schema.fields, StructField(text, StringType())]))


def report(docs: DataFrame, model: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_pieces, ids_crc32 (ids as little-endian 32-bit integers), round_trip: whether decoding gives the text back."""
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))
    kind = rows.schema["key"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = Pieces.of(model)
        for batch in batches:
            counts, crc, same = [], [], []
            for value in batch.column(1):
                content = value.as_py()
                ids = pieces.encode(content or "")
                counts.append(len(ids))
                crc.append(zlib.crc32(np.array(ids, "<u4").tobytes()))
                same.append(pieces.decode(ids) == (content or ""))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(crc, pa.int64()), pa.array(same, pa.bool_())],
                names=["key", "n_pieces", "ids_crc32", "round_trip"])

    return rows.mapInArrow(run, f"key {kind}, n_pieces bigint, ids_crc32 bigint, round_trip boolean").withColumnRenamed("key", key)
