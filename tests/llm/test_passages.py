"""Substring dedup against a brute-force version."""

from __future__ import annotations

import hashlib
import random
import re

from tokenloom.llm import passages
from tokenloom.llm.passages import COVER, PERIOD, WINDOW, without_repeats


def brute(rows):
    first, out = {}, []
    split = [(k, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for k, t in rows]
    for k, words in split:
        for s in range(len(words) - WINDOW + 1):
            w = tuple(words[s:s + WINDOW])
            if k is not None:
                first[w] = min(first.get(w, k), k)
    for k, words in split:
        drop = set()
        for s in range(len(words) - WINDOW + 1):
            if k is not None and first[tuple(words[s:s + WINDOW])] < k:
                drop.update(range(s, s + WINDOW))
        kept = " ".join(w for i, w in enumerate(words) if i not in drop)
        out.append((k, len(words), len(drop), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def answer(df):
    report, _ = without_repeats(df)
    return sorted(((r["doc_id"], r["n_words"], r["n_removed"], bytes(r["kept_digest"]).hex()) for r in report.collect()), key=repr)


def test_cover_aligns_any_two_places():
    assert {(a - b) % PERIOD for a in COVER for b in COVER} == set(range(PERIOD))


def test_against_brute_force(spark):
    draw = random.Random(11)
    word = lambda: f"w{draw.randrange(5000)}é"
    shared = [[word() for _ in range(n)] for n in (49, 50, 51, 75, 130, 300)]
    loop = ["a", "b", "c"] * 70
    texts = [None, "", " \n", "one two", " ".join(loop), " ".join(loop[:100]), " ".join(loop[1:60])]
    for _ in range(60):
        parts = []
        for _ in range(draw.randint(1, 5)):
            run = draw.choice(shared)
            cut = draw.randint(0, max(0, len(run) - 50)) if draw.random() < 0.5 else 0
            parts.append([word() for _ in range(draw.randint(0, 90))] + run[cut:cut + draw.randint(45, 400)])
        texts.append("  ".join(" ".join(p) for p in parts))
    texts += texts[10:16] + ["\t".join(texts[20].split())] + [" ".join(f"u{i}" for i in range(30000))] * 2
    keys = list(range(len(texts)))
    draw.shuffle(keys)
    rows = list(zip(keys, texts)) + [(keys[12], texts[12]), (keys[13], texts[20]), (None, texts[21])]
    docs = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id long, text string, digest string, key int")
    assert answer(docs) == brute(rows)


def test_empty_table_and_kept_texts(spark):
    assert answer(spark.createDataFrame([], "doc_id long, text string")) == []
    run = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join(run)), (2, "a b " + "\n".join(run) + " c")]
    _, texts = without_repeats(spark.createDataFrame(rows, "doc_id long, text string"))
    assert [(r["doc_id"], r["kept_text"]) for r in texts.collect()] == [(2, "a b c")]
    assert passages.anchor_places(49).size == 0
