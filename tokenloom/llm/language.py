"""Language identification by cross-parsing against suffix automata.

For each language a suffix automaton is built over a bounded sample of labelled
text. A text is parsed greedily into the longest phrases that occur in that
sample; the language that needs the fewest phrases, times the bits that point
into its sample, per letter, wins. All text is parsed, in blocks of ``BLOCK``
letters (a phrase ends with its block); many blocks advance in lockstep, one
letter of each at a time.

Learning is bounded: at most ``SAMPLE_DOCS`` documents a language, chosen by
hash, a piece of ``PIECE`` characters of each from a place chosen by hash, and
``TOTAL`` characters over all languages. The automata are broadcast; ``TOTAL``
bounds them as well. The whole alphabet of the samples is kept, however many
scripts they hold: an automaton numbers the letters of its own sample, and its
transitions lie in blocks of ``WIDE`` letters, written only where a state has one.

Defined results: a text that is null or has no letter is ``und`` with score 0,
and so is every text if there is no labelled text. Letters that no sample holds
end a phrase. Equal entropies go to the language that sorts first. Rows without
label or text, or whose key is null, are not learned from. Repeated rows get the
same answer; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window as W, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from .words import slices, starts_of

SAMPLE_DOCS, PIECE, TOTAL = 96, 400, 400_000
BLOCK = 256
WIDE = 64  # letters of a block of transitions
UNKNOWN = "und"


def suffix_moves(symbols: np.ndarray) -> list[dict[int, int]]:
    """Transitions of the suffix automaton of a symbol sequence, one dictionary per state (0 is the root)."""
    moves: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for symbol in symbols.tolist():
        new = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        state = last
        while state >= 0 and symbol not in moves[state]:
            moves[state][symbol] = new
            state = link[state]
        if state >= 0:
            target = moves[state][symbol]
            if length[target] == length[state] + 1:
                link[new] = target
            else:
                clone = len(moves)
                moves.append(dict(moves[target]))
                length.append(length[state] + 1)
                link.append(link[target])
                while state >= 0 and moves[state].get(symbol) == target:
                    moves[state][symbol] = clone
                    state = link[state]
                link[target] = link[new] = clone
        last = new
    return moves


def suffix_automaton(symbols: np.ndarray, size: int) -> np.ndarray:
    """The same as a table: row = state, column = symbol, 0 = none."""
    moves = suffix_moves(symbols)
    table = np.zeros((len(moves), size), np.int32)
    for state, row in enumerate(moves):
        for symbol, target in row.items():
            table[state, symbol] = target
    return table


class Automaton:
    """A suffix automaton over any number of symbols, in two levels: state and block of symbols, then symbol in its block."""

    def __init__(self, symbols: np.ndarray, size: int):
        own = np.unique(symbols)
        self.number = np.zeros(size, np.int64)  # 0: a symbol that the sequence lacks, without transitions
        self.number[own] = np.arange(1, len(own) + 1)
        self.per = -(-(len(own) + 1) // WIDE)
        moves = suffix_moves(self.number[symbols])
        self.places = np.zeros(len(moves) * self.per, np.int32)  # block 0 has no transition
        used = np.unique(np.fromiter((state * self.per + symbol // WIDE for state, row in enumerate(moves) for symbol in row), np.int64))
        self.places[used] = np.arange(1, len(used) + 1)
        self.targets = np.zeros((len(used) + 1) * WIDE, np.int32)
        for state, row in enumerate(moves):
            for symbol, target in row.items():
                self.targets[int(self.places[state * self.per + symbol // WIDE]) * WIDE + symbol % WIDE] = target

    def step(self, states: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        """The state after one more symbol, by its number; 0 = none."""
        blocks = self.places[states * self.per + numbers // WIDE].astype(np.int64)
        return self.targets[blocks * WIDE + numbers % WIDE].astype(np.int64)


class Languages:
    """Learned alphabet and one automaton per language."""

    def __init__(self, texts: dict[str, str]):
        letters = sorted({c for text in texts.values() for c in text.lower() if c.isalpha()})
        self.codes = np.zeros(0x110000, np.int32)  # 0: no letter
        for point in range(0x110000):
            if chr(point).isalpha():
                self.codes[point] = 1  # a letter of no sample
        for number, letter in enumerate(letters):
            self.codes[ord(letter)] = number + 2
        self.pad = len(letters) + 2
        self.size = self.pad + 1
        self.names, self.tables, self.bits = [], [], []
        for name in sorted(texts):
            sample = self.symbols(texts[name])
            if (sample > 1).any():
                self.names.append(name)
                self.tables.append(Automaton(sample, self.size))
                self.bits.append(math.log2(len(sample) + 1))

    def symbols(self, text: str) -> np.ndarray:
        """Codes of a lower-cased text; runs of other characters are one 0, none at the ends."""
        points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32)
        codes = self.codes[points]
        letter = codes != 0
        keep = letter.copy()
        keep[1:] |= letter[:-1]  # the first other character after a letter
        codes = codes[keep]
        return codes[:-1] if len(codes) and codes[-1] == 0 else codes

    def phrases(self, blocks: np.ndarray, table: Automaton) -> np.ndarray:
        """Phrases of each row of symbols, padding not counted."""
        state = np.zeros(len(blocks), np.int64)
        count = np.ones(len(blocks), np.int64)
        root = table.step(np.zeros(self.size, np.int64), table.number)
        for symbol in np.ascontiguousarray(blocks.T):
            step = table.step(state, table.number[symbol])
            ended = step == 0
            count += ended
            state = np.where(ended, root[symbol], step)
        return count - (blocks == self.pad).sum(axis=1)

    def entropies(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(bits per symbol of each text under each language, symbols of each text)."""
        symbols = [self.symbols(text) for text in texts]
        lengths = np.array([len(s) for s in symbols], np.int64)
        per = -(-lengths // BLOCK)
        blocks = np.full((int(per.sum()), BLOCK), self.pad, np.int32)
        flat = blocks.reshape(-1)
        for at, s in zip(starts_of(per), symbols):
            flat[at * BLOCK:at * BLOCK + len(s)] = s
        out = np.zeros((len(texts), len(self.names)))
        owner = np.repeat(np.arange(len(texts)), per)
        for number, (table, bits) in enumerate(zip(self.tables, self.bits)):
            counts = np.bincount(owner, weights=self.phrases(blocks, table), minlength=len(texts)) if len(blocks) else 0
            out[:, number] = counts * bits / np.maximum(lengths, 1)
        return out, lengths

    def best(self, texts: list[str]) -> tuple[list[str], list[float]]:
        """Language and score: the winner's share when each language weighs 2 to the minus its bits for some letters."""
        if not self.names:
            return [UNKNOWN] * len(texts), [0.0] * len(texts)
        entropy, lengths = self.entropies(texts)
        least = entropy.argmin(axis=1)
        ahead = entropy - entropy.min(axis=1, keepdims=True)
        score = 1 / np.exp2(-ahead * np.minimum(lengths, 64)[:, None]).sum(axis=1)
        return ([self.names[i] if n else UNKNOWN for i, n in zip(least, lengths)],
                [float(s) if n else 0.0 for s, n in zip(score, lengths)])


def learn(labelled: DataFrame, key: str = "doc_id", text: str = "text", lang: str = "lang") -> Languages:
    """Automata from a bounded sample of labelled rows."""
    rows = labelled.select(F.col(key).alias("key"), F.col(text).alias("text"), F.col(lang).alias("lang")).where(
        "key is not null and text is not null and lang is not null")
    order = W.partitionBy("lang").orderBy(F.xxhash64("key"), "key")  # each task keeps SAMPLE_DOCS rows a language at most
    chosen = (rows.select("key", "lang").withColumn("at", F.row_number().over(order)).where(F.col("at") <= SAMPLE_DOCS)
              .select("key", "lang").distinct())
    place = f"1 + cast(pmod(xxhash64(key, 'place'), greatest(1, length(text) - {PIECE} + 1)) as int)"
    sample = rows.join(F.broadcast(chosen), ["key", "lang"]).select(
        "lang", "key", F.expr(f"substring(text, {place}, {PIECE})").alias("piece"))
    texts: dict[str, list[str]] = {}
    for row in sorted(sample.collect(), key=lambda r: (r["lang"], r["key"], r["piece"])):
        texts.setdefault(row["lang"], []).append(row["piece"])
    share = TOTAL // max(1, len(texts))
    return Languages({name: " ".join(pieces)[:share] for name, pieces in texts.items()})


def predict(docs: DataFrame, model: Languages, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, lang_pred, score for every row, from its whole text alone."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col(key).alias("key"), F.col(text).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch, 1):
                names, scores = shared.value.best([t.decode() for t in texts])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                    names=["key", "lang_pred", "score"])

    kind = rows.schema["key"].dataType.simpleString()
    return rows.mapInArrow(run, f"key {kind}, lang_pred string, score double").withColumnRenamed("key", key)


def predict_onto(docs: DataFrame, model: Languages, text: str = "text", column: str = "lang_pred") -> DataFrame:
    """The rows with their predicted language in one more column."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    docs = docs.drop(column)
    place, names = docs.columns.index(text), [f"c{i}" for i in range(len(docs.columns) + 1)]  # whatever the columns' own names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, texts in slices(batch, place):
                found, _ = shared.value.best([t.decode() for t in texts])
                yield pa.RecordBatch.from_arrays([*batch.slice(start, len(texts)).columns, pa.array(found, pa.string())], names=names)

    kinds = [*(field.dataType for field in docs.schema.fields), StringType()]
    return docs.toDF(*names[:-1]).mapInArrow(run, StructType([StructField(n, k) for n, k in zip(names, kinds)])).toDF(*docs.columns, column)


def fold(key: str, folds: int) -> Column:
    """crc32 of the key as text, modulo ``folds``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % folds
