"""Tables of words stay bounded by bytes, and the smallest key is told apart from null."""

from __future__ import annotations

import numpy as np
import public_tokenizers
from tokenizers.normalizers import NFC, Lowercase, Replace, Sequence

from tokenloom.llm import pieces, tokenbin, words


def test_smallest_key_and_null(spark):
    least = -(2 ** 63)
    docs = spark.createDataFrame([(least, "a b"), (None, "c"), (None, "d e"), (0, "f")], "doc_id long, text string")
    parts, folder, kind = tokenbin.write_tokens(docs, public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    rows = tokenbin.read_tokens(parts, folder, kind).orderBy("start").collect()
    assert [r["key"] for r in rows] == [None, None, least, 0]


def test_token_tables_with_long_runs(monkeypatch):
    monkeypatch.setattr(tokenbin, "TABLE_BYTES", 1_000_000)
    encoder = tokenbin.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    short = encoder.encode([b"plain words, again"], b"")
    for block in range(30):
        encoder.encode([b" ".join(b"%d-%d-%s" % (block, i, b"x" * 400) for i in range(50)), b" ".join(b"w%dq%d" % (block, i) for i in range(500))], b"")
        assert sum(len(k) + len(v) + words.ENTRY_BYTES for t in (encoder.runs, encoder.pieces) for k, v in t.items()) <= 1_600_000
        assert max(map(len, encoder.runs)) <= words.LONG_WORD
    assert encoder.encode([b"plain words, again"], b"") == short


def test_word_and_piece_tables(monkeypatch):
    monkeypatch.setattr(words, "TABLE_BYTES", 100_000)
    table = words.WordTable()
    first = table.hashes([b"word"])[0]
    for i in range(5_000):
        table.hashes([b"w%d" % i, b"%d" % i + b"y" * 2_000])
        assert len(table) <= 520
    assert table.hashes([b"word"])[0] == first
    monkeypatch.setattr(pieces, "TABLE_BYTES", 100_000)
    model = pieces.Pieces(public_tokenizers.path("piece_bpe_32k.model"))
    text = " ".join(["z" * 500, *(f"run{i}" for i in range(2_000))])
    assert model.decode(model.encode(text)) == text and len(model.runs) <= 520 and max(map(len, model.runs)) <= words.LONG_WORD


def test_a_run_that_repeats_is_cut_once(monkeypatch):
    encoder, asked = tokenbin.Encoder(public_tokenizers.path("word_bpe_49k.json")), []
    cut = tokenbin.Encoder._parts
    monkeypatch.setattr(encoder, "_parts", lambda run: asked.append(run) or cut(run))
    once = encoder.encode([b"Two words, two words"], b"")[0]
    asked.clear()
    encoder.runs.clear()
    assert encoder.encode([b"Two words, two words", b"Two words, two words"], b"") == [once, once]
    assert sorted(asked) == [b"Two", b"two", b"words", b"words,"]


def test_new_pieces_are_asked_for_together_and_older_ones_kept(monkeypatch):
    encoder = tokenbin.Encoder(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["don't", "a<|endoftext|>b", "<|STARTOFTEXT|>", "\u0130x", "J\u030c", "\xc9t\xe9,", "'s", "12a3", "\uac00", "\u2168", "\ufb01N", "word)]", "\u65e5\u672c", "\0A", "A\u0345"]
    texts = [*odd, " ".join(odd), " ".join(f"{a}{b}" for a in odd for b in odd), ""]
    want = [np.array(encoder.tokenizer.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]

    class Asked:
        def __init__(self, inner):
            self.inner, self.calls = inner, 0

        def __getattr__(self, name):
            self.calls += name.startswith("encode")
            return getattr(self.inner, name)

        def encode_batch_fast(self, pieces, **options):
            assert len(pieces) == 1
            self.calls += 1
            return self.inner.encode_batch_fast(pieces, **options)

    asked = encoder.tokenizer = Asked(encoder.tokenizer)
    assert encoder.encode([t.encode() for t in texts], b"") == want
    monkeypatch.setattr(tokenbin, "TABLE_BYTES", 1)  # the tables are full before the next call
    asked.calls = 0
    assert encoder.encode([t.encode() for t in texts], b"") == want and asked.calls == 0
    assert encoder.encode([b"other"], b"") and encoder.encode([b"again"], b"")
    assert encoder.encode([t.encode() for t in texts], b"") == want and asked.calls > 0


def test_a_run_is_looked_up_once_a_slice():
    encoder, asked = tokenbin.Encoder(public_tokenizers.path("word_bpe_49k.json")), []

    class Counted(dict):
        def get(self, run, *other):
            asked.append(run)
            return super().get(run, *other)

        def __getitem__(self, run):
            asked.append(run)
            return super().__getitem__(run)

    texts = [b" One  two, " * 500, b"", b"two, one\x0bOne\x1cx " * 500, b" "]
    want = [np.array(encoder.tokenizer.encode(t.decode(), add_special_tokens=False).ids, "<u2").tobytes() + b"." for t in texts]
    encoder.runs = Counted()
    assert encoder.encode(texts, b".") == want and encoder.encode(texts, b".") == want and encoder.encode([], b".") == []
    assert sorted(set(asked)) == [b"", b"One", b"One\x1cx", b"one", b"two,"] and len(asked) <= 4 * len(set(asked))


def test_latin_words_are_asked_for_without_steps(tmp_path):
    path = public_tokenizers.path("word_bpe_49k.json")
    letters = [c for c in map(chr, range(256)) if c.isalpha()]
    latin = [w for c in letters for w in (c, f"a{c}", f"{c}S", f"x{c}{c.lower()}y.")] + ["don", "STRASSE,", "L\xc0", "endoftext"]
    other = ["İx", "ŉ", "ǅ", "ẞ", "Åa", "ΣΣ", "à", "ﬁ", "'s", "\xd7a", "a\xa0b", "x\xb2"]
    encoder = tokenbin.Encoder(path)
    full = encoder.tokenizer

    def want(texts):
        return [np.array(full.encode(t, add_special_tokens=False).ids, "<u2").tobytes() for t in texts]

    encoder.encode([b". ,"], b"")
    encoder.tokenizer = None  # Latin-1 words do without it
    assert encoder.encode([t.encode() for t in latin], b"") == want(latin)
    encoder.tokenizer = full
    mixed = [" ".join(latin + other), *other]
    assert encoder.encode([t.encode() for t in mixed], b"") == want(mixed)
    full.normalizer = Sequence([NFC(), Replace("de", "\xfc"), Lowercase()])  # steps that change some words
    full.save(str(tmp_path / "other.json"))
    assert tokenbin.Encoder(str(tmp_path / "other.json")).bare is None
    assert tokenbin.Encoder(str(tmp_path / "other.json")).encode([b"den Modem, de"], b"") == want(["den Modem, de"])
