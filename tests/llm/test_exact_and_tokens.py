"""Exact dedup against a dictionary, token files against the tokenizers library."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tokenloom.llm import tokenbin
from tokenloom.llm.exact import exact_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
TEXTS = [None, "", "A b", "a B", "a b ", "É", "é", "x" * 300_000, "X" * 300_000, "same"] + ["hot Copy"] * 300


def expected(rows):
    groups = {}
    for key, text in rows:
        groups.setdefault((text or "").translate(LOWER), []).append(key)
    out = []
    for key, text in rows:
        norm = (text or "").translate(LOWER)
        best = max((k for k in groups[norm] if k is not None), default=None)
        out.append((key, best, len(groups[norm]), key == best, norm))
    return out


def check(spark, rows, **options):
    docs = spark.createDataFrame([(k, t, "z", 0) for k, t in rows], "doc_id long, text string, digest string, key int")
    got = [tuple(r) for r in exact_groups(docs, **options).collect()]
    return sorted(r[:4] for r in got), sorted(r[:4] for r in expected(rows)), got


def test_exact_groups(spark):
    rows = list(enumerate(TEXTS)) + [(3, "a B")]
    got, want, full = check(spark, rows)
    assert got == want
    digest = {k: bytes(d) for k, _, _, _, d in full}
    assert all(digest[k] == hashlib.sha256(norm.encode()).digest() for k, _, _, _, norm in expected(rows))


def test_contents_that_share_a_digest_stay_apart(spark):
    rows = list(enumerate(TEXTS))
    got, want, _ = check(spark, rows, digest=lambda content: bytes([len(content) % 3]), salts=4)
    assert got == want


def test_exact_null_keys_and_empty_tables(spark):
    docs = spark.createDataFrame([(None, "a"), (None, "a"), (None, "b"), (4, "b")], "doc_id long, text string")
    got = sorted(((r["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in exact_groups(docs).collect()), key=repr)
    assert got == sorted([(None, None, 2, True), (None, None, 2, True), (None, 4, 2, False), (4, 4, 2, True)], key=repr)
    assert exact_groups(docs.limit(0)).count() == 0


def tokens(spark, rows):
    docs = spark.createDataFrame([(k, t, "z") for k, t in rows], "doc_id long, text string, part string")
    parts, folder, kind = tokenbin.write_tokens(docs.repartition(3), public_tokenizers.path("word_bpe_49k.json"), 2)
    return sorted(map(tuple, tokenbin.read_tokens(parts, folder, kind).collect()), key=lambda r: r[1]), parts, folder, kind


def test_token_files(spark):
    odd = ["don't STOP!! it's 3,14€ (ok)... ΑΣ. ΟΔΟΣ", "été É. Å! İ.", "a b c\x1cd", "<|endoftext|> x<|startoftext|>.",
           "Straße. İstanbul, ǅ! 日本語。 no.1 ½. ª. ...! .a. a.b. 'S 's. x's, ͅ.", "word " * 50_000, "😀. a😀b, नमस्ते."]
    rows = [(i * 7 % 41, t) for i, t in enumerate(odd + TEXTS[:10])] + [(None, "first")]
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want, start = [], 0
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        want.append((key, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    got, parts, folder, kind = tokens(spark, rows)
    assert got == want and kind == "<u2"
    written = [np.array(tokenbin.array(f"{folder}/{r['name']}.ids", kind)) for r in parts.orderBy("part").collect()]
    assert sum(map(len, written)) == start


def test_repeated_keys_and_empty_table(spark):
    got, *_ = tokens(spark, [(1, "a"), (1, "a"), (1, "")])
    assert [r[0] for r in got] == [1, 1, 1] and sorted(r[2] for r in got) == [1, 2, 2]
    assert tokens(spark, [])[0] == []
