"""Pieces against the sentencepiece library, templates and mixing against plain versions, the pipeline against all of them."""

from __future__ import annotations

import random

import duckdb
import public_tokenizers
import pytest
import sentencepiece
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from tokenloom.llm import linetemplates, mixing, mixing_sql
from tokenloom.llm.linetemplates import without_repeated_lines
from tokenloom.llm.pieces import Pieces, decode, encode, report

MODEL = public_tokenizers.path("piece_bpe_32k.model")
FOLDER = "/root/testdata/sf0.001"
ODD = [None, "", " ", "   ", "Hello world", "  two  spaces  ", "a\nb\tc\r", "▁mark ▁▁ x▁y", "日本語 और 😀", "ééé", "x" * 5000, "<s> </s> <0x41> <unk>", "\x00"]


def varint(data: bytes, at: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        value |= (data[at] & 127) << shift
        shift, at = shift + 7, at + 1
        if data[at - 1] < 128:
            return value, at


def number(value: int) -> bytes:
    out = b""
    while value > 127:
        out, value = out + bytes([value & 127 | 128]), value >> 7
    return out + bytes([value])


def as_unigram() -> sentencepiece.SentencePieceProcessor:
    """The same pieces and scores in a model that the library parses by best score."""
    data, at, out = open(MODEL, "rb").read(), 0, b""
    while at < len(data):
        start = at
        tag, at = varint(data, at)
        assert tag & 7 == 2
        size, at = varint(data, at)
        body, at = data[at:at + size], at + size
        if tag >> 3 == 2:  # trainer settings: another model type, given last, wins
            body += b"\x18\x01"
            out += number(tag) + number(len(body)) + body
        else:
            out += data[start:at]
    return sentencepiece.SentencePieceProcessor(model_proto=out)


def best_total(run, scores, penalty):
    """The best total by trying every last piece at every place."""
    best = [0.0] + [float("-inf")] * len(run)
    for end in range(1, len(run) + 1):
        best[end] = best[end - 1] + penalty
        for start in range(max(0, end - 16), end):
            if run[start:end] in scores:
                best[end] = max(best[end], best[start] + scores[run[start:end]])
    return best[-1]


def test_best_paths(spark):
    """Totals equal a quadratic search, and no word scores less than what the library finds (it is not always optimal)."""
    library, pieces = as_unigram(), Pieces(MODEL)
    scores = {p: s for p, (_, s, _) in pieces.automaton.items()}
    texts = [r["text"] for r in spark.read.parquet(f"{FOLDER}/documents.parquet").select("text").limit(60).collect()]
    words = sorted({w for t in texts for w in t.split()} | set("Hello naïve café Straße 3,14 don't x日y 😀".split()))
    total = lambda ids: sum(library.get_score(i) for i in ids)
    same = 0
    for word in words:
        ids, theirs = pieces.encode(word), library.encode(word)
        same += ids == theirs
        if not any(library.is_byte(i) for i in ids):
            assert total(ids) == best_total("▁" + word, scores, pieces.unknown) >= total(theirs)
    assert len(words) > 5000 and same > 0.99 * len(words)


def test_round_trips(spark):
    pieces = Pieces(MODEL)
    assert all(pieces.decode(pieces.encode(t)) == t for t in ODD if t is not None)
    docs = spark.createDataFrame([(i, t, "p", 1) for i, t in enumerate(ODD)], "doc_id long, text string, pieces string, run int")
    back = decode(encode(docs, MODEL), MODEL)
    assert all(r["decoded"] == r["text"] for r in back.collect()) and back.columns == ["doc_id", "text", "run", "pieces", "decoded"]
    assert all(r["round_trip"] for r in report(docs, MODEL).collect())
    assert report(docs.limit(0), MODEL).count() == encode(docs.limit(0), MODEL).count() == 0


def plain_templates(rows, min_docs, min_tokens):
    """Lines of documents, their paths and templates, one after the other."""
    paths, where = {}, {}
    for key, text in rows:
        for line in set((text or "").split("\n")):
            tokens = [("<*>" if any(c in "0123456789" for c in t) else t) for t in line.encode().decode().split()]
            if len(tokens) >= min_tokens and key is not None:
                path = (len(tokens), *tokens[:3])
                paths.setdefault(path, {}).setdefault(" ".join(tokens), set()).add(key)
                where[line] = (path, " ".join(tokens))
    drop = set()
    for path, lines in paths.items():
        if len(set().union(*lines.values())) < min_docs:
            continue
        numbers, texts = linetemplates.parse(sorted(lines))
        merged = dict(zip(sorted(set(texts)), linetemplates.parse(sorted(set(texts)))[0]))
        groups = {}
        for content, n in zip(sorted(lines), numbers):
            groups.setdefault(merged[texts[n]], set()).add(content)
        for contents in groups.values():
            docs = set().union(*(lines[c] for c in contents))
            if len(docs) >= min_docs:
                drop |= {(key, path, c) for c in contents for key in lines[c] if key != min(docs)}
    out = []
    for key, text in rows:
        kept = [line for line in text.split("\n") if (key, *where.get(line, (0, 0))) not in drop] if text is not None else []
        out.append((key, "\n".join(kept) if text is not None else None, (text.count("\n") + 1 if text is not None else 0) - len(kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [4000, 5])
def test_line_templates(spark, monkeypatch, group):
    draw = random.Random(4)
    rows = [(None, "Visit 3 times the page of Bob now"), (500, None), (501, ""), (502, " \n\n"), (503, "line " * 20_000)]
    for key in range(60):
        lines = [f"Visit {draw.randrange(99)} times the page of {draw.choice(['Ann', 'Bob', 'Cy'])} now", "All rights reserved."] if key % 2 else []
        lines += [" ".join(draw.choice(["red", "green", "blue", "grey"]) for _ in range(draw.randint(1, 9))) for _ in range(6)]
        lines += [f"own line number {key} of document alpha{key} here", "ok"]
        draw.shuffle(lines)
        rows.append((key, "\n".join(lines)))
    rows.append(rows[-1])
    docs = spark.createDataFrame([(k, t, "x", 3) for k, t in rows], "doc_id long, text string, line string, n_lines int")
    got = without_repeated_lines(docs, min_docs=10)
    assert got.columns == ["doc_id", "text", "line", "n_lines", "n_dropped"]
    want = plain_templates(rows, 10, 3)
    assert sorted(((r["doc_id"], r["text"], r["n_dropped"]) for r in got.collect()), key=repr) == want
    assert sum(n for _, _, n in want) > 50
    if group == 5:  # dealt to several tasks, the templates of a path still meet
        monkeypatch.setattr(linetemplates, "GROUP", 5)
        again = {r["doc_id"]: r["text"] or "" for r in without_repeated_lines(docs, min_docs=10).collect()}
        assert sum("Visit" in t for t in again.values()) <= 3
    assert without_repeated_lines(docs.limit(0)).count() == 0


def test_template_fields_generalise():
    numbers, texts = linetemplates.parse(["user a logged in at noon today", "user b logged in at noon today", "user b went out by the door"])
    assert numbers == [0, 0, 1] and texts[0] == "user <*> logged in at noon today"
    assert xxhash.xxh3_64_intdigest(b"") == xxhash.xxh3_64_intdigest("")


def skewed(spark):
    draw = random.Random(6)
    rows = [(i, "hot" if i % 2 else draw.choice([None, "b", "c", "d", "e"]), " ".join("w" for _ in range(draw.randint(0, 30)))) for i in range(900)]
    rows += [(1000, "hot", None), (1001, "blank", " \n"), (1002, "e", "word " * 60_000)]
    return spark.createDataFrame([(*r, 0.5, 7) for r in rows], "doc_id long, source string, text string, place double, hash int")


@pytest.mark.parametrize("block", [50_000, 40])
def test_mixing_equals_its_sql(spark, monkeypatch, block):
    monkeypatch.setattr(mixing, "BLOCK_DOCS", block)
    docs = skewed(spark)
    got = mixing.mix(docs)
    assert got.columns == ["doc_id", "source", "text", "hash", "epoch", "place"]
    db = duckdb.connect()
    db.register("documents", docs.select("doc_id", "source", "text").toPandas())
    want = sorted(db.execute(mixing_sql.MIX).fetchall(), key=repr)
    rows = got.select("doc_id", "source", F.col("epoch"), F.round("place", 6)).collect()
    assert sorted(map(tuple, rows), key=repr) == want
    assert mixing.mix(docs.limit(0)).count() == 0


def test_exponent_meets_its_limits(spark):
    totals = spark.createDataFrame([(900,), (50,), (30,), (20,)], "tokens long")
    flat, limited, own = (mixing.exponent(totals, *a) for a in ((1.0, 1e9), (1.0, 2.0), (0.0, 1e9)))
    assert flat == 0 and own == 1 and 0 < limited < 1
    weights = [t**limited for t in (900, 50, 30, 20)]
    assert abs(max(w / sum(weights) * 1000 / t for w, t in zip(weights, (900, 50, 30, 20))) - 2) < 1e-4


def test_pipeline(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    now = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, FOLDER).cache()
        assert now.columns == docs.columns and now.count() > 0, name
    ids = {r["doc_id"] for r in now.collect()}
    out = corpus_pipeline.run(spark, FOLDER)
    rows = out.collect()
    assert out.columns == ["doc_id", "lang", "source", "pieces", "n_pieces", "round_trip"]
    assert {r["doc_id"] for r in rows} == ids and all(r["round_trip"] for r in rows)


def test_pipeline_stages_on_odd_tables(spark):
    base = spark.read.parquet(f"{FOLDER}/documents.parquet")
    odd = spark.createDataFrame([(1, None, None, None, None), (None, "x y z", "en", None, 5), (2, "", "en", "s", 0), (2, "", "en", "s", 0),
                                 (3, "12 34", "en", "s", 5)], base.schema)
    for docs in (odd, base.limit(0), base.limit(30).unionByName(odd)):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, docs, FOLDER).count() >= 0
    kept = corpus_pipeline.known_language(spark, base.limit(30).unionByName(odd), FOLDER)
    assert {r["doc_id"] for r in kept.where("text is null or text in ('', '12 34')").collect()} == set()
