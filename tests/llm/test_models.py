"""Neighbours against brute force, language and quality on held-out rows and edge cases."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from tokenloom.llm import language, quality
from tokenloom.llm.language import Languages, suffix_automaton
from tokenloom.llm import neighbours
from tokenloom.llm.neighbours import nearest_neighbours
from tokenloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def exact(rows, queries, k):
    out = {}
    for q, v in queries:
        found = sorted((-float(np.dot(v, w)), i) for i, w in rows if i != q and len(w) == len(v))[:k]
        out[q] = [(i, -s) for s, i in found]
    return out


def answer(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert len(out[r["query_id"]]) == r["rank"]
    return out


def test_neighbours_recall_over_shards(spark):
    draw = np.random.default_rng(1)
    centres = draw.normal(size=(12, 24))
    rows = [(i, list(map(float, centres[i % 12] + 0.6 * draw.normal(size=24)) ) ) for i in range(3000)]
    rows = [(i, [x * (1 + i % 5) for x in v]) for i, v in rows]  # lengths differ, so this is no search by angle
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got, want = answer(nearest_neighbours(df, df.where("vec_id % 20 = 0"), 20, shard=800)), exact(rows, rows[::20], 20)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.95 * 20 * len(want)
    vectors = dict(rows)
    assert all(abs(s - np.dot(vectors[q], vectors[i])) < 1e-9 for q in got for i, s in got[q])


@pytest.mark.parametrize("dim", [32, 64])
@pytest.mark.parametrize("spread,longest", [(0.25, 1), (0.5, 1), (1.0, 1), (0.0, 1e4), (0.25, 1e200)])
def test_recall_with_uneven_lengths(dim, spread, longest, tmp_path):
    draw = np.random.default_rng(6)
    vectors = draw.normal(size=(4000, dim))
    vectors *= (np.exp(spread * draw.normal(size=4000)) / np.linalg.norm(vectors, axis=1))[:, None]
    vectors[11] *= longest
    table = pa.table({"id": np.arange(4000), "dim": pa.array([dim] * 4000, pa.int32()), "shard": pa.array([0] * 4000, pa.int32()),
                      "vector": pa.array(list(vectors))})
    name = neighbours._build(f"file://{tmp_path}")(table).column("name")[0].as_py()
    queries = np.arange(5, 4000, 40)
    got = {q: set(ids) for q, ids, _ in neighbours.Shard(f"file://{tmp_path}", name, dim).nearest(queries, vectors[queries], 20)}
    score = vectors[queries] @ vectors.T
    score[np.arange(len(queries)), queries] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    assert np.mean([len(got[q] & set(w)) / 20 for q, w in zip(queries, want)]) >= 0.95


def test_vectors_of_one_direction(spark):
    """Thousands of lengths of one direction beside others: all are reached, with products of either sign."""
    draw = np.random.default_rng(8)
    line = draw.normal(size=8)
    rows = [(i, list(map(float, line * (1 + i / 700)))) for i in range(700)] + [(1000 + i, list(map(float, draw.normal(size=8)))) for i in range(700)]
    rows += [(2000, list(map(float, -line)))]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = answer(nearest_neighbours(df, df.where("vec_id in (0, 300, 1003, 1250, 2000)"), 20))
    chosen = [r for r in rows if r[0] in (0, 300, 1003, 1250, 2000)]
    want = exact(rows, chosen, 20)
    hits = {q: len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want}
    assert min(hits.values()) >= 19


def test_neighbours_ties_and_rows_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 0.0]) for i in range(60)] + [(60, [0.5, 0.5]), (61, [2.0, 1.0]), (62, [1.0, 0.0, 0.0])]
    bad = [(70, None), (71, []), (72, [0.0, 0.0]), (73, [nan, 1.0]), (74, [inf, 1.0]), (75, [None, 1.0]), (None, [1.0, 1.0])]
    df = spark.createDataFrame([(i, v, 9) for i, v in rows + bad + [(5, [1.0, 0.0])]], "vec_id long, embedding array<double>, dim int")
    got = answer(nearest_neighbours(df, df.where("vec_id in (0, 40, 62, 70)"), 20, shard=16))
    want = exact(rows, [rows[0], rows[40]], 20)
    assert got == want
    assert answer(nearest_neighbours(df.limit(0), df, 20)) == {}


def test_suffix_automaton_accepts_exactly_the_substrings():
    draw = random.Random(2)
    for _ in range(30):
        text = [draw.randrange(3) for _ in range(draw.randint(1, 25))]
        table = suffix_automaton(np.array(text), 3)
        have = {tuple(text[a:b]) for a in range(len(text)) for b in range(a + 1, len(text) + 1)}
        for _ in range(200):
            word = tuple(draw.randrange(3) for _ in range(draw.randint(1, 6)))
            state = 0
            for symbol in word:
                state = table[state, symbol]
                if not state:
                    break
            assert bool(state) == (word in have)


def greedy(sample, text):
    count, rest = 0, text
    while rest:
        n = next((n for n in range(len(rest), 0, -1) if rest[:n] in sample), 1)
        count, rest = count + 1, rest[n:]
    return count


def test_phrases_equal_greedy_parsing():
    sample = "the cat sat on the mat and the dog sat on the cat"
    model = Languages({"en": sample})
    for text in ["the cat and the dog", "mat", "dog on dog on dog", "a hat"]:
        blocks = np.full((1, language.BLOCK), model.pad, np.uint8)
        symbols = model.symbols(text)
        blocks[0, :len(symbols)] = symbols
        assert model.phrases(blocks, model.tables[0])[0] == greedy(sample, text)


def test_language_accuracy_and_edge_cases(spark):
    got = {r["doc_id"]: r for r in QUERIES["op5_language_id"](spark, FOLDER).collect()}
    truth = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "lang").collect()}
    held = [k for k, r in got.items() if r["held_out"]]
    assert len(got) == len(truth) and sum(got[k]["lang_pred"] == truth[k] for k in held) >= 0.97 * len(held)
    assert all(0 <= r["score"] <= 1 for r in got.values())
    rows = [(1, "hello there old friend", "en"), (2, "guten morgen alter freund", "de"), (3, None, "en"), (4, "12 !", None), (None, "x", "en"), (5, "", "de")]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, lang string, score double")
    model = language.learn(docs)
    found = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in language.predict(docs, model).collect()}
    assert found[1][0] == "en" and found[2][0] == "de" and found[3] == found[4] == found[5] == ("und", 0.0)
    long = spark.createDataFrame([(1, "guten morgen " * 50_000), (2, "日本語")], "doc_id long, text string")
    assert [r["lang_pred"] for r in language.predict(long, model).orderBy("doc_id").collect()][0] == "de"
    none = language.learn(docs.limit(0))
    assert {r["lang_pred"] for r in language.predict(docs, none).collect()} == {"und"}
    assert language.predict(docs.limit(0), model).count() == 0


def test_quality_on_held_out_rows(spark):
    rows = QUERIES["op7_quality_classifier"](spark, FOLDER).join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").where("held_out").collect()
    assert sum((r["score"] >= 0.3) == r["predicted"] for r in rows) == len(rows)
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.9 * len(rows)


def test_chunks_cover_every_byte():
    for n in (0, 1, 511, 512, 513, 960, 961, 5000):
        text = np.random.default_rng(n).integers(0, 256, n, np.uint8).tobytes()
        parts = quality.chunks_of(text)
        flat = [int(b) for i, p in enumerate(parts) for b in p[(quality.OVERLAP if i else 0):]]
        assert bytes(b for b in flat if b != quality.PAD) == text and len(flat) - n < quality.CHUNK + 1


def test_quality_edge_cases(spark):
    docs = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate([None, "", "good words here", "bad!!! ###", "x" * 200_000])], "doc_id long, text string, score double")
    labels = spark.createDataFrame([(2, 1), (3, 0), (3, None), (None, 1), (4, 7)], "doc_id long, quality int")
    scores = [r["score"] for r in quality.score(docs, quality.learn(docs, labels)).collect()]
    assert len(scores) == 5 and all(0 <= s <= 1 for s in scores)
    assert {r["score"] for r in quality.score(docs, quality.learn(docs, labels.where("quality = 1"))).collect()} == {1.0}
    assert {r["score"] for r in quality.score(docs, quality.learn(docs, labels.limit(0))).collect()} == {0.0}
    assert quality.score(docs.limit(0), quality.learn(docs, labels)).count() == 0
    with pytest.raises(Exception):
        quality.learn(docs.drop("text"), labels)
