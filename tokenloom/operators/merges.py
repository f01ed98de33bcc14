"""Merges of symbol pairs: learning on sharded words, and taking one word through a list of merges.

Learning. Distinct words lie in shards; each shard is a row of arrays with an
index from symbol pair to the words that hold it, so a step takes apart the
touched words only. A frequent pair has its words in every shard.

A step is one small job. The driver proposes the merges it expects next, the
shards apply them in order and return by how much each one changes pair counts.
With these changes the driver replays the step exactly. Where the best pair was
proposed for a later turn and touches no place of those before it, it takes its
turn now, and the changes of the merges it passes are renamed; the step ends at
the first turn whose best pair cannot be had so. The words themselves never
move. What is expected is counted on a bounded number of the heaviest words;
this guess decides how long a step is, not what is learned. Between two rebuilds of the shards only the list of merges grows; a word
is brought up to date when it is touched.

The driver holds the merge list, as long as the caller asked for, and a bounded
list of the most frequent pairs. Every pair outside that list ranks behind its
last one (``bound``); when no listed pair is certain to be next, a full count
fills the list again. A merge whose result is a symbol already (made by another
pair before) may add to pairs outside the list, so a full count follows it.
"""

from __future__ import annotations

import heapq
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ..session import discard, release, staged

END_OF_WORD = "</w>"  # fixed value
Merge = tuple[str, str]
_END = 0x110000  # symbols: code points, the end of word, then merged ones in order of their making

SHARD_SYMBOLS = 1_000_000
HEAD_WORDS, HEAD_SYMBOLS = 30_000, 64  # words the driver holds, and the most symbols of one
SHARD = ("symbols array<int>, starts array<int>, n array<bigint>, pairs array<bigint>, totals array<bigint>, "
         "first array<int>, postings array<int>")


# ---- one word

def merged_in_order(symbols: list, turns: dict, results: list, on_merge=None) -> list:
    """The symbols after all merges, each applied everywhere from left to right before the next.

    ``turns`` gives for a pair of symbols its places in the list of merges, in
    rising order, and ``results`` the symbol each merge makes. A pair that comes
    up when its turn has passed waits for its next turn, if it has one. Symbols
    are a linked list and open pairs a heap, so a word of k symbols takes
    O(k log k). ``on_merge(turn, before, left, right, after)`` sees each merge.
    """
    size = len(symbols)
    if size < 2:
        return list(symbols)
    symbols, after, before = list(symbols), list(range(1, size)) + [-1], list(range(-1, size - 1))
    heap = []
    for at in range(size - 1):
        found = turns.get((symbols[at], symbols[at + 1]))
        if found:
            heap.append((found[0], at))
    heapq.heapify(heap)
    while heap:
        turn, at = heapq.heappop(heap)
        right = after[at]
        if right < 0 or symbols[at] is None:
            continue
        found = turns.get((symbols[at], symbols[right]))
        if not found or (place := bisect_left(found, turn)) == len(found) or found[place] != turn:
            continue
        left, next_one = before[at], after[right]
        if on_merge:
            on_merge(turn, symbols[left] if left >= 0 else None, symbols[at], symbols[right],
                     symbols[next_one] if next_one >= 0 else None)
        symbols[at], symbols[right], after[at] = results[turn], None, next_one
        if next_one >= 0:
            before[next_one] = at
        for start in (left, at):
            if start >= 0 and after[start] >= 0:
                found = turns.get((symbols[start], symbols[after[start]]))
                if found and (place := bisect_left(found, turn + 1)) < len(found):
                    heapq.heappush(heap, (found[place], start))
    return [symbol for symbol in symbols if symbol is not None]


def turns_of(merges: list) -> dict:
    turns = defaultdict(list)
    for turn, pair in enumerate(merges):
        turns[pair].append(turn)
    return dict(turns)


# ---- shards of words

class Steps:
    """Merges as tasks use them: by symbol number, with the indexed pairs under which their words are found.

    A symbol made since the shards were built consists of indexed symbols; a word
    that holds the pair (left, right) holds an indexed pair of the last one of
    ``left`` and the first one of ``right``. A symbol can be made in several ways,
    so these are sets.
    """

    def __init__(self, numbers: dict[str, int], built: int):
        self.numbers, self.built = numbers, built
        self.names: list[str] = [END_OF_WORD, *numbers][: 1 + len(numbers)]
        self.firsts: dict[int, set] = {}
        self.lasts: dict[int, set] = {}
        self.merges: list[tuple[int, int]] = []
        self.results: list[int] = []
        self.entries: list[list[int]] = []

    def number(self, symbol: str) -> int:
        return ord(symbol) if len(symbol) == 1 else _END if symbol == END_OF_WORD else self.numbers[symbol]

    def name(self, number: int) -> str:
        return chr(number) if number < _END else self.names[number - _END]

    def add(self, left: str, right: str) -> None:
        a, b = self.number(left), self.number(right)
        made = left + right
        if made != END_OF_WORD and made not in self.numbers:
            self.numbers[made] = _END + len(self.names)
            self.names.append(made)
        c = self.number(made)
        own = lambda sets, x: sets.get(x) or {x}
        self.entries.append([x << 32 | y for x in own(self.lasts, a) for y in own(self.firsts, b)])
        indexed = {c} if c < self.built else set()
        self.firsts[c] = own(self.firsts, a) | self.firsts.get(c, indexed)
        self.lasts[c] = own(self.lasts, b) | self.lasts.get(c, indexed)
        self.merges.append((a, b))
        self.results.append(c)


def _shard(symbols: np.ndarray, starts: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
    """Arrays of a shard with its index: pairs, their counts, and where the words of each begin in ``postings``."""
    word = np.repeat(np.arange(len(n)), np.diff(starts))
    inside = word[:-1] == word[1:]
    key = (symbols[:-1].astype(np.int64) << 32 | symbols[1:])[inside]
    of = word[:-1][inside]
    order = np.argsort(key, kind="stable")
    key, of = key[order], of[order]
    new = np.append(True, key[1:] != key[:-1])[: len(key)]
    pairs = key[new]
    totals = np.add.reduceat(n[of], np.flatnonzero(new)) if len(key) else np.zeros(0, np.int64)
    once = new | np.append(True, of[1:] != of[:-1])[: len(key)]
    postings = of[once]
    first = np.append(np.flatnonzero(new[once]), len(postings))
    values = [(symbols, pa.int32()), (starts, pa.int32()), (n, pa.int64()), (pairs, pa.int64()), (totals, pa.int64()),
              (first, pa.int32()), (postings, pa.int32())]
    return pa.RecordBatch.from_arrays([pa.array([v.astype(np.int64 if t == pa.int64() else np.int32)], pa.list_(t)) for v, t in values],
                                      names=[c.split()[0] for c in SHARD.split(", ")])


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(token, n) -> shards."""
    tokens, n, size = [], [], 0

    def shard() -> pa.RecordBatch:
        sizes = np.array([len(t) + 1 for t in tokens], np.int64)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        symbols = np.full(starts[-1], _END, np.int64)
        letters = np.ones(starts[-1], bool)
        letters[starts[1:] - 1] = False
        symbols[letters] = np.frombuffer("".join(tokens).encode("utf-32-le"), np.uint32)
        return _shard(symbols, starts, np.array(n, np.int64))

    for batch in batches:
        for token, count in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            tokens.append(token)
            n.append(count)
            size += len(token) + 1
            if size >= SHARD_SYMBOLS:
                yield shard()
                tokens, n, size = [], [], 0
    if tokens:
        yield shard()


def _shards(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    for batch in batches:
        for row in range(batch.num_rows):
            yield [column[row].values.to_numpy(zero_copy_only=False) for column in batch.columns]


def _touched(shard: list[np.ndarray], entries: list[list[int]]) -> np.ndarray:
    """Words that may hold one of the pairs."""
    _, _, _, pairs, _, first, postings = shard
    asked = np.unique(np.array([key for keys in entries for key in keys], np.int64))
    at = np.searchsorted(pairs, asked)
    at = at[(at < len(pairs))]
    at = at[np.isin(pairs[at], asked)]
    return np.unique(np.concatenate([postings[first[i]:first[i + 1]] for i in at])) if len(at) else np.zeros(0, np.int64)


def _changes(steps: Steps, since: int, watched: set[Merge]):
    """Shards -> (left, right, seen, step, n): changes of pair counts by each merge from ``since`` on."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns, change = turns_of(steps.merges), defaultdict(int)
        for shard in _shards(batches):
            symbols, starts, counts = shard[:3]
            for word in _touched(shard, steps.entries[since:]):
                n = int(counts[word])

                def note(turn, before, left, right, after, n=n):
                    if turn < since:
                        return
                    made = steps.results[turn]
                    change[turn, left, right] -= n
                    if before is not None:
                        change[turn, before, left] -= n
                        change[turn, before, made] += n
                    if after is not None:
                        change[turn, right, after] -= n
                        change[turn, made, after] += n

                merged_in_order(symbols[starts[word]:starts[word + 1]].tolist(), turns, steps.results, note)
        yield from _named(steps, change, since, watched)

    return read


def _named(steps: Steps, change: dict, since: int, watched: set[Merge]) -> Iterator[pa.RecordBatch]:
    rows = [(steps.name(a), steps.name(b), turn - since, n) for (turn, a, b), n in change.items() if n]
    own = {steps.name(x) for pair in steps.merges[since:] for x in pair} | {steps.name(x) for x in steps.results[since:]}
    rows = [(a, b, (a, b) in watched or a in own and b in own, turn, n) for a, b, turn, n in rows]
    if rows:
        kinds = [pa.string(), pa.string(), pa.bool_(), pa.int32(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(list(column), kind) for column, kind in zip(zip(*rows), kinds)],
                                         names=["left", "right", "seen", "step", "n"])


def _current(steps: Steps, shard: list[np.ndarray], turns: dict) -> Iterator[tuple[int, list[int]]]:
    """(word, symbols) of the words that merges since the build may have changed."""
    symbols, starts = shard[:2]
    for word in _touched(shard, steps.entries):
        yield word, merged_in_order(symbols[starts[word]:starts[word + 1]].tolist(), turns, steps.results)


def _counted(steps: Steps):
    """Shards -> (left, right, n) of all pairs."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = turns_of(steps.merges)
        for shard in _shards(batches):
            symbols, starts, counts, pairs, totals = shard[:5]
            change = defaultdict(int)
            for word, now in _current(steps, shard, turns):
                n, was = int(counts[word]), symbols[starts[word]:starts[word + 1]].tolist()
                for a, b in zip(was, was[1:]):
                    change[a << 32 | b] -= n
                for a, b in zip(now, now[1:]):
                    change[a << 32 | b] += n
            key = np.concatenate([pairs, np.array(list(change), np.int64)])
            key, at = np.unique(key, return_inverse=True)
            total = np.zeros(len(key), np.int64)
            np.add.at(total, at, np.concatenate([totals, np.array(list(change.values()), np.int64)]))
            key, total = key[total > 0], total[total > 0]
            for low in range(0, len(key), 50_000):
                some = key[low:low + 50_000].tolist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([steps.name(k >> 32) for k in some]), pa.array([steps.name(k & 0xFFFFFFFF) for k in some]),
                     pa.array(total[low:low + 50_000])], names=["left", "right", "n"])

    return read


def _rebuilt(steps: Steps):
    """Shards -> shards whose words have all merges applied."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns = turns_of(steps.merges)
        for shard in _shards(batches):
            symbols, starts, counts = shard[:3]
            symbols, keep = symbols.astype(np.int64), np.ones(len(symbols), bool)
            for word, now in _current(steps, shard, turns):
                low, high = starts[word], starts[word + 1]
                symbols[low:low + len(now)] = now
                keep[low + len(now):high] = False
            sizes = np.add.reduceat(keep, starts[:-1]).astype(np.int64) if len(counts) else np.zeros(0, np.int64)
            yield _shard(symbols[keep], np.concatenate([[0], np.cumsum(sizes)]), counts)

    return read


# ---- the driver's side

def _rank(pair: Merge, n: int) -> tuple:
    return (-n, *pair)


class _Head:
    """The heaviest words as they stand after the merges learned so far, with an index from pair to the words that may hold it.

    They only serve to guess what comes next; their number is bounded by the caller.
    """

    def __init__(self, words: list[tuple[list[str], int]]):
        self.words = [symbols for symbols, _ in words]
        self.n = [n for _, n in words]
        self.places: dict[Merge, set] = defaultdict(set)
        self.total: dict[Merge, int] = defaultdict(int)
        for at, (symbols, n) in enumerate(words):
            for pair in zip(symbols, symbols[1:]):
                self.places[pair].add(at)
                self.total[pair] += n

    def merged(self, pair: Merge, changed: dict[int, list[str]]) -> dict[Merge, int]:
        """Applies a merge to the words, which become entries of ``changed``; gives the changes of pair counts."""
        (a, b), change = pair, defaultdict(int)
        for at in self.places.get(pair, ()):
            was = changed.get(at) or self.words[at]
            now, i = [], 0
            while i < len(was):
                if was[i] == a and i + 1 < len(was) and was[i + 1] == b:
                    now.append(a + b)
                    i += 2
                else:
                    now.append(was[i])
                    i += 1
            if len(now) == len(was):
                continue
            n = self.n[at]
            for p in zip(was, was[1:]):
                change[p] -= n
            for p in zip(now, now[1:]):
                change[p] += n
                self.places[p].add(at)
            changed[at] = now
        return change

    def apply(self, pair: Merge) -> None:
        changed: dict[int, list[str]] = {}
        for p, n in self.merged(pair, changed).items():
            self.total[p] += n
        for at, symbols in changed.items():
            self.words[at] = symbols
        self.places.pop(pair, None)


class _Expected:
    """Guesses the next merges: what a merge changes in the heaviest words is counted.

    In the others it takes from the pairs beside it in proportion, and gives that
    to the pairs it makes.
    """

    def __init__(self, live: dict[Merge, int], head: _Head):
        self.n, self.head, self.changed = dict(live), head, {}
        self.others = {pair: n - head.total.get(pair, 0) for pair, n in live.items()}
        self.ending, self.beginning = defaultdict(set), defaultdict(set)
        for pair in live:
            self._place(pair)
        self.heap = [_rank(pair, n) for pair, n in live.items()]
        heapq.heapify(self.heap)

    def _place(self, pair: Merge) -> None:
        self.beginning[pair[0]].add(pair)
        self.ending[pair[1]].add(pair)

    def next(self) -> Merge | None:
        while self.heap:
            n, left, right = heapq.heappop(self.heap)
            if self.n.get((left, right)) == -n:
                return left, right
        return None

    def take(self, pair: Merge, least: int) -> None:
        (a, b), change = pair, defaultdict(int)
        self.n.pop(pair)
        n = self.others.pop(pair)
        for beside, made in ((self.ending[a], lambda p: (p[0], a + b)), (self.beginning[b], lambda p: (a + b, p[1]))):
            open_ones = [p for p in beside if p in self.n and self.others[p] > 0]
            total = max(n, sum(self.others[p] for p in open_ones))
            for p in open_ones if n > 0 else ():
                moved = self.others[p] * n // total
                change[p] -= moved
                change[made(p)] += moved
        for p, moved in change.items():
            self.others[p] = self.others.get(p, 0) + moved
        for p, moved in self.head.merged(pair, self.changed).items():
            change[p] += moved
        for p, moved in change.items():
            if p in self.n or p != pair and moved >= least:
                self.others.setdefault(p, 0)
                self._set(p, self.n.get(p, 0) + moved)

    def _set(self, pair: Merge, n: int) -> None:
        if pair not in self.n:
            self._place(pair)
        self.n[pair] = n
        heapq.heappush(self.heap, _rank(pair, n))


def _proposed(live: dict[Merge, int], head: _Head, most: int, least: int, known) -> list[Merge]:
    """The best pair, then what is expected after it; a merge that makes a known symbol ends the list."""
    expected, taken, made = _Expected(live, head), [], set()
    while len(taken) < most and (pair := expected.next()):
        if taken and expected.n[pair] < least:
            break
        taken.append(pair)
        if pair[0] + pair[1] in known or pair[0] + pair[1] in made:
            break
        made.add(pair[0] + pair[1])
        expected.take(pair, least)
    return taken


def _commute(p: Merge, q: Merge) -> bool:
    """Whether two merges of new symbols touch no common place of any word, so that their order shows in names only."""
    return p[1] != q[0] and q[1] != p[0] and p[0] + p[1] not in q and q[0] + q[1] not in p


def _exchange(p: Merge, q: Merge, of_p: dict[Merge, int], of_q: dict[Merge, int]) -> None:
    """Makes the changes counted for p and then q those of q and then p, for merges that commute.

    Only places where both stand side by side differ: the merge that comes first
    finds the bare symbol of the other beside it, the second finds the made one.
    """
    (a, b), (c, d) = p, q
    ab, cd = a + b, c + d
    for made, bare, mixed_p, mixed_q in (((ab, cd), (b, c), (ab, c), (b, cd)), ((cd, ab), (d, a), (d, ab), (cd, a))):
        n = of_q.get(made, 0)
        if n:
            for changes, sign in ((of_q, 1), (of_p, -1)):
                for pair, by in ((made, -n), (mixed_p, n), (bare, -n), (mixed_q, n)):
                    changes[pair] = changes.get(pair, 0) + sign * by


def _heaviest(count: int):
    """New shards -> (symbols, n): the most frequent words of each, without those of very many symbols."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for symbols, starts, counts, *_ in _shards(batches):
            words = np.flatnonzero(np.diff(starts) <= HEAD_SYMBOLS)
            if len(words) > count:
                words = words[np.argpartition(-counts[words], count)[:count]]
            yield pa.RecordBatch.from_arrays([
                pa.array([symbols[starts[word]:starts[word + 1]] for word in words], pa.list_(pa.int32())),
                pa.array(counts[words], pa.int64())], names=["symbols", "n"])

    return read


def learn_merges(counts: DataFrame, merges: int, candidates: int = 4096, most: int = 96) -> list[Merge]:
    """The first ``merges`` merges for words (token, n), by falling pair count, ties by the two symbols.

    Equal to counting all pairs anew before each merge. The list ends early when
    no pair is left. Null tokens have no symbols; an empty token is its end alone.
    """
    spark = counts.sparkSession
    words = counts.where("token is not null").select("token", F.col("n").cast("bigint").alias("n"))
    shards = staged(words.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "token").mapInArrow(_built, SHARD), "merge-shards")
    top = shards.mapInArrow(_heaviest(HEAD_WORDS), "symbols array<int>, n bigint").orderBy(F.desc("n"), "symbols").limit(HEAD_WORDS).collect()
    head = _Head([([END_OF_WORD if c == _END else chr(c) for c in r.symbols], r.n) for r in top])
    learned: list[Merge] = []
    numbers: dict[str, int] = {}
    pending: list[Merge] = []
    built = _END + 1

    def steps(more: list[Merge] = ()) -> Steps:
        out = Steps(dict(numbers), built)
        for pair in [*pending, *more]:
            out.add(*pair)
        return out

    live: dict[Merge, int] = {}
    bound = (0,)  # ranks behind every pair: nothing is listed yet
    kept = 12  # merges of the last step; the next one asks for more, but not for so many that most would be counted in vain
    while len(learned) < merges:
        best = min((_rank(pair, n) for pair, n in live.items()), default=None)
        if best is None or best > bound:
            top = shards.mapInArrow(_counted(steps()), "left string, right string, n bigint").groupBy("left", "right").agg(
                F.sum("n").alias("n")).orderBy(F.desc("n"), "left", "right").limit(candidates).collect()
            live = {(r.left, r.right): r.n for r in top}
            if not top:
                break
            bound = _rank((top[-1].left, top[-1].right), top[-1].n) if len(top) == candidates else (1,)
        least = max(1, -bound[0])
        known = {*numbers, END_OF_WORD}
        asked = _proposed(live, head, min(most, merges - len(learned), 2 * kept + 8), least, known)
        kept = 0
        changes = [{} for _ in asked]
        if len(asked) > 1 or len(learned) + 1 < merges:
            found = shards.mapInArrow(_changes(steps(asked), len(pending), set(live)),
                                      "left string, right string, seen boolean, step int, n bigint")
            sums = found.repartition("left", "right", "seen").groupBy("left", "right", "seen", "step").agg(F.sum("n").alias("n")).groupBy("left", "right", "seen").agg(
                F.collect_list(F.struct("step", "n")).alias("each"), F.sum(F.greatest("n", F.lit(0))).alias("gain"))
            for r in sums.where(F.col("seen") | (F.col("gain") >= least)).collect():  # listed pairs and new ones above the bound
                for change in r.each:
                    changes[change.step][r.left, r.right] = change.n
        fresh, made = True, [left + right for left, right in asked]
        new_symbol = made[-1] not in known and made[-1] not in made[:-1]  # of the last one; all before it make new ones
        for step in range(len(asked)):
            best = min((_rank(p, n) for p, n in live.items()), default=(1,))
            at = asked.index(best[1:], step) if best <= bound and best[1:] in asked[step:] else -1
            if at > step and at == len(asked) - 1 and not new_symbol:
                break
            while at > step and _commute(asked[at - 1], asked[at]):
                _exchange(asked[at - 1], asked[at], changes[at - 1], changes[at])
                asked[at - 1], asked[at], changes[at - 1], changes[at] = asked[at], asked[at - 1], changes[at], changes[at - 1]
                at -= 1
            if at != step:
                break
            pair = asked[step]
            kept += 1
            learned.append(pair)
            pending.append(pair)
            head.apply(pair)
            live.pop(pair)
            for other, n in changes[step].items():
                if other != pair:
                    live[other] = live.get(other, 0) + n
            live = {p: n for p, n in live.items() if n > 0}
            made = pair[0] + pair[1]
            fresh = made not in numbers and made != END_OF_WORD
            numbers.setdefault(made, _END + 1 + len(numbers)) if made != END_OF_WORD else None
            if not fresh:
                live = {}  # pairs outside the list may have gained
                break
        if len(live) > 2 * candidates:
            ranked = sorted(_rank(p, n) for p, n in live.items())[:candidates]
            bound = min(bound, ranked[-1])
            live = {(left, right): -n for n, left, right in ranked}
        if len(pending) >= min(512, max(24, len(learned) // 4)) and len(learned) < merges:
            before, shards = shards, staged(shards.mapInArrow(_rebuilt(steps()), SHARD), "merge-shards")
            discard(before)
            release(spark)  # the shuffles of the steps so far
            pending, built = [], _END + 1 + len(numbers)
    discard(shards)
    release(spark)
    return learned
