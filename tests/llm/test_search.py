"""Ranked lexical search against plain integer arithmetic."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np

from tokenloom.llm import lexical

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def brute(docs, items, k):
    held = [(key, Counter(terms(text))) for key, text in docs]
    many = sum(1 for _, c in held if c)
    length = sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        asked, found = Counter(terms(text)), []
        for key, c in held:
            n = sum(c.values())
            m = 100 - 25 + (25 * n * many) // length if length else 0
            score = sum(times * math.floor(1000 * math.log((2 * many + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                        for t, times in asked.items() if t in c)
            if score > 0:
                found.append((-score, key is None, key or 0, key))
        out += [(item, rank, key, -score) for rank, (score, _, _, key) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=repr)


def answer(df):
    return sorted(((r["item_id"], r["rank"], r["doc_id"], r["score"]) for r in df.collect()), key=repr)


def fixture(seed=3):
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(60)] + ["Éa", "éa", "naïve", "x1", "日本", "Straße"]
    texts = [None, "", " .,;\n", "w1", "W1", "w1_w2|w3", " w1 w2", "日本-x1", "w1 " * 3000]
    texts += [" ".join(draw.choice(vocabulary) for _ in range(draw.randint(1, 80))) for _ in range(150)]
    texts += texts[20:40] * 3  # ties
    docs = [(i, text) for i, text in enumerate(texts)] + [(5, "W1"), (None, "w1 w2"), (None, "w1")]
    items = [(i % 290, " ".join(draw.choice(vocabulary) for _ in range(draw.randint(0, 12)))) for i in range(600)]
    return docs, items + [(None, "w1"), (7, None), (8, "nowhere"), (9, "w3 " * 50)]


def test_against_plain_arithmetic(spark):
    docs, items = fixture()
    frame = spark.createDataFrame([(k, t, 1, 2, 3) for k, t in docs], "doc_id bigint, text string, item int, score int, rank int").repartition(5)
    asked = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in items], "item_id bigint, text string, item int, part int, id string").repartition(3)
    for k in (20, 3):
        assert answer(lexical.ranked(frame, asked, k=k)) == brute(docs, items, k)


def test_empty_tables(spark):
    docs = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    items = spark.createDataFrame([(1, "a")], "item_id bigint, text string")
    assert lexical.ranked(docs.limit(0), items).collect() == []
    found = lexical.ranked(docs, items.limit(0))
    assert found.collect() == [] and found.columns == ["item_id", "rank", "doc_id", "score"]
    assert answer(lexical.ranked(docs, items)) == brute([(1, "a b")], [(1, "a")], 20)


def test_parts_stay_exact():
    """However narrow the bound, the parts add up to the item rows, and no part can reach it."""
    draw = np.random.default_rng(1)
    held = {"items": np.arange(5), "row": draw.integers(0, 5, 200), "column": draw.integers(0, 40, 200), "n": draw.integers(1, 9, 200)}
    place, at = np.unique(held["row"] * 40 + held["column"], return_index=True)
    held.update({name: held[name][at] for name in ("row", "column", "n")})
    weights = draw.integers(1, 20_000, 40)
    for exact in (2 ** 53, 100_000 * lexical.MOST_IMPACT, 7_000 * lexical.MOST_IMPACT):
        total = np.zeros((5, 40), np.int64)
        for low, part in lexical.products(held, weights, width=16, exact=exact):
            assert part.sum(1).max() * lexical.MOST_IMPACT < exact
            total[:, low:low + part.shape[1]] += part.astype(np.int64)
        want = np.zeros((5, 40), np.int64)
        want[held["row"], held["column"]] = held["n"] * weights[held["column"]]
        assert (total == want).all()


def test_long_texts_are_cut_between_terms():
    text = ("ab " * 400_000 + "c" * 2_000_000 + " ab").encode()
    names, _, term, n, lengths = lexical.counted([b"", text])
    assert dict(zip((names[i] for i in term), n)) == {b"ab": 400_001, b"c" * 2_000_000: 1} and list(lengths) == [0, 400_002]
