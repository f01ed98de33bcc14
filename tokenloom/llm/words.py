"""Words of texts as 64-bit hashes in numpy arrays, a bounded slice of documents at a time.

A word is a run of bytes other than space and \\x09-\\x0D, which is how
``bytes.split`` cuts UTF-8. Hash arithmetic wraps at 64 bits throughout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash

SLICE_BYTES = 1_500_000  # texts are worked on in slices of about this size; one long text is a slice of its own
TABLE_BYTES = 80_000_000  # a table of words is emptied beyond this, so its memory does not grow with the corpus
ENTRY_BYTES = 200  # of an entry, beside its letters
LONG_WORD = 300  # longer ones, mostly encoded data, are in no table


class WordTable(dict):
    """word -> 64-bit hash, filled on demand and bounded by bytes."""

    size = 0

    def __missing__(self, word: bytes) -> int:
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= LONG_WORD:
            if self.size >= TABLE_BYTES:
                self.clear()
                self.size = 0
            self[word] = value
            self.size += len(word) + ENTRY_BYTES
        return value

    def hashes(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def texts_of(column: pa.Array) -> pa.Array:
    """The UTF-8 bytes of a text column; null counts as empty."""
    return column.cast(pa.binary()).fill_null(b"")


def slices(batch: pa.RecordBatch, text: int, most: int = SLICE_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first row, texts as bytes) for runs of rows of about ``most`` bytes."""
    column = texts_of(batch.column(text))
    start, size, run = 0, 0, []
    for value in column:
        content = value.as_py()
        run.append(content)
        size += len(content)
        if size >= most:
            yield start, run
            start, size, run = start + len(run), 0, []
    if run:
        yield start, run


def starts_of(counts: np.ndarray) -> np.ndarray:
    """Where each run begins when runs of these lengths lie side by side."""
    return np.concatenate([[0], np.cumsum(counts)[:-1]]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit values one to one, so that every bit depends on all others."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def window_hashes(hashes: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of every run of ``width`` consecutive words; equal runs have equal hashes.

    Horner's rule with an odd base, doubling the run length where it can: a run
    of 2k words is two runs of k.
    """
    if len(hashes) < width:
        return np.zeros(0, np.uint64)
    total, done, power = None, 0, None
    run, length, run_power = hashes, 1, np.uint64(base)
    left = width
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                if total is None:
                    total, done, power = run, length, run_power
                else:
                    n = len(hashes) - (done + length) + 1
                    total = total[:n] * run_power + run[done:done + n]
                    done, power = done + length, power * run_power
            left >>= 1
            if left:
                n = len(hashes) - 2 * length + 1
                run = run[:n] * run_power + run[length:length + n]
                length, run_power = 2 * length, run_power * run_power
        return mixed(total)


def unused(names: list[str], *wanted: str) -> list[str]:
    """Column names like the wanted ones that no column has, in any case."""
    taken, out = {name.lower() for name in names}, []
    for name in wanted:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out
