"""Near duplicates and components against brute force."""

from __future__ import annotations

import random
import re

import pytest

from tokenloom.llm.components import components
from tokenloom.llm.neardup import BANDS, ROWS, least_agreement, near_duplicates

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, width, percent):
    sets = {}
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
        grams = {tuple(words[i:i + width]) for i in range(len(words) - width + 1)} if len(words) >= width else {tuple(words)} - {()}
        sets[key] = grams
    keys = sorted(sets)
    root = {k: k for k in keys}

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(keys):
        for b in keys[:i]:
            x, y = sets[a], sets[b]
            if x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {k: (len(sets[k]), find(k), find(k) == k) for k in keys}


def answer(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()}


def family(draw, words, copies, edits):
    out = []
    for _ in range(copies):
        text = list(words)
        for _ in range(draw.randint(0, edits)):
            text[draw.randrange(len(text))] = f"w{draw.randrange(10**6)}"
        out.append(" ".join(text))
    return out


@pytest.mark.parametrize("width,percent", [(4, 80), (5, 80)])
def test_against_all_pairs(spark, width, percent):
    draw = random.Random(5)
    texts = [None, "", " \t\n", "one", "One", "one two three", "ONE two\tthree", "ä Ä", "ä ä"]
    for _ in range(8):  # families around the threshold, whose members are linked through others
        base = [f"v{draw.randrange(400)}" for _ in range(draw.randint(40, 150))]
        texts += family(draw, base, 12, max(2, len(base) // 18))
    passage = " ".join(f"p{i}" for i in range(60))
    texts += [passage + " " + " ".join(f"x{draw.randrange(10**6)}" for _ in range(80)) for _ in range(30)]
    texts += texts[20:30] + [" ".join(f"long{i % 9000}" for i in range(40000))] * 2
    draw.shuffle(texts)
    rows = list(enumerate(texts))
    docs = spark.createDataFrame([(k, t, 1, "d") for k, t in rows], "doc_id long, text string, size int, digest string")
    assert answer(near_duplicates(docs, width=width, percent=percent)) == brute(rows, width, percent)


def test_family_whose_blocks_are_compared_inside(spark, monkeypatch):
    """Members far from the leader are found although the bucket is cut into several blocks."""
    from tokenloom.llm import neardup
    monkeypatch.setattr(neardup, "BLOCK", 4)
    draw = random.Random(8)
    base = [f"v{i}" for i in range(120)]
    rows = list(enumerate(family(draw, base, 60, 7)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert answer(near_duplicates(docs, width=4)) == brute(rows, 4, 80)


def test_repeated_rows_nulls_and_empty_tables(spark):
    schema = "doc_id long, text string"
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (5, "A b c d e f"), (None, "a b c d e f"), (7, None)]
    got = sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, schema)).collect()), key=repr)
    assert [r[:3] for r in got if r[0] is not None] == [(3, 2, 3), (3, 2, 3), (5, 2, 3), (7, 0, 7)]
    assert len(got) == 5
    assert near_duplicates(spark.createDataFrame([], schema)).count() == 0


def test_components_of_paths_stars_and_loops(spark):
    draw = random.Random(3)
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 201), (201, 200), (None, 4)]
    edges += [(draw.randrange(300, 400), draw.randrange(300, 400)) for _ in range(60)]
    root = {n: n for e in edges for n in e if n is not None}
    for _ in range(500):
        for a, b in edges:
            if a is not None:
                root[a] = root[b] = min(root[a], root[b])
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {n: r for n, r in root.items() if n != r and n != 7 or (n == 7)}


def test_signature_bound_is_loose():
    assert 0.6 * BANDS * ROWS < least_agreement(80) < 0.75 * BANDS * ROWS


def test_bitmap_bound_never_rules_out_a_link():
    import numpy as np
    from tokenloom.llm.neardup import bitmap, possible
    draw = np.random.default_rng(1)
    for _ in range(300):
        base = draw.integers(0, 2**64, int(draw.integers(5, 9000)), np.uint64)
        kept = base[draw.random(len(base)) < draw.uniform(0.7, 1)]
        other = np.unique(np.append(kept, draw.integers(0, 2**64, int(len(base) * draw.uniform(0, 0.2)), np.uint64)))
        base = np.unique(base)
        common = len(np.intersect1d(base, other))
        linked = 100 * common >= 80 * (len(base) + len(other) - common)
        x, y = (np.frombuffer(bitmap(s), np.uint64) for s in (base, other))
        assert possible(x, len(base), y[None, :], np.array([len(other)]), 80)[0] or not linked
