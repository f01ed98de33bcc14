"""Spelling variants against all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

from tokenloom.llm import spelling

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words_of(rows):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(counts):
    out, form = {}, {}
    for word, n in counts.items():
        found = sorted((-counts[other], other) for other in counts if near(word, other))
        best = found[0] if found and -found[0][0] >= 10 * n else None
        form[word] = best and best[1]
        out[word] = (n, len(found), best and best[1], best and -best[0])
    for word, (n, many, other, m) in list(out.items()):
        root = word
        while form[root]:
            root = form[root]
        out[word] = (other, root, n, many, m)
    return out


def answer(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def changed(draw, word):
    at, letter = draw.randrange(len(word)), draw.choice("abéz")
    return draw.choice([word[:at] + letter + word[at:], word[:at] + word[at + 1:], word[:at] + letter + word[at + 1:]])


def test_against_all_pairs(spark):
    draw = random.Random(4)
    bases = ["".join(draw.choice("abcdeéÿ") for _ in range(draw.randint(7, 13))) for _ in range(40)]
    bases += ["prefix" + "".join(draw.choice("ab") for _ in range(4)) for _ in range(12)] + ["aaaaaaa", "aaaaaaaa", "aaaaaaaaa"]
    words = []
    for base in bases:
        edited = changed(draw, base)
        words += [base] * draw.choice([2, 30, 300]) + [edited] * draw.choice([2, 3, 25]) + [changed(draw, edited)] * 2
    draw.shuffle(words)
    texts = [" ".join(words[i:i + 40]) for i in range(0, len(words), 40)]
    rows = [(i, t.title() if i % 3 else t) for i, t in enumerate(texts)] + [(None, texts[0]), (1, texts[1]), (7, None), (8, ""), (9, "×÷ a1b 7-8")]
    frame = spark.createDataFrame([(k, t, "x", 1) for k, t in rows], "doc_id bigint, text string, word string, n int").repartition(4)
    counts = words_of(rows)
    found = spelling.word_counts(frame)
    assert {r["word"]: r["n"] for r in found.collect()} == counts
    assert answer(spelling.variants(found)) == brute(counts)


def test_chains_of_forms(spark):
    chain = [("abcdefgh" + "xyzuvwqrst"[:i], 10 ** (9 - i)) for i in range(8)]
    got = answer(spelling.variants(spark.createDataFrame(chain, "word string, n bigint")))
    assert {root for _, root, *_ in got.values()} == {"abcdefgh"} and got == brute(dict(chain))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert spelling.variants(spelling.word_counts(docs)).collect() == []
