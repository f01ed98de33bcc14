"""All five stages of the pipeline against plain Python, and stages on tables whose columns are named like their own."""

from __future__ import annotations

import math
import random
import re

import duckdb
import pytest

import corpus_pipeline
from tests.llm.test_neardup import LOWER
from tests.llm.test_whole_lines import plain as plain_lines
from tokenloom.llm import linetemplates, mixing, mixing_sql
from tokenloom.llm.neardup import near_duplicates, words_digest
from tokenloom.llm.pieces import Pieces

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {"en": "the cat house river green apple stone bread water light window garden summer winter friend letter story music silver cloud".split(),
         "de": "die katze haus fluss gruen apfel stein brot wasser licht fenster garten sommer winter freund brief geschichte musik silber wolke".split()}


def sentence(draw, lang, n):
    return " ".join(draw.choice(WORDS[lang]) + draw.choice(["", "", "n", "s", "er"]) for _ in range(n))


def planted():
    draw = random.Random(12)
    rows = [[key, sentence(draw, "de" if key % 3 else "en", draw.randint(25, 45)), "de" if key % 3 else "en", ["a", "b", None][key % 3 if key < 20 else 0]]
            for key in range(40)]
    near = lambda text: " ".join([*text.split()[:-1], "changed"])
    rows += [[60, near(rows[3][1]), "de", "b"], [61, rows[4][1].upper(), "de", "a"], [62, near(rows[6][1]), "en", "a"]]
    rows += [[5, near(rows[7][1]) + " x y", "de", "b"], [5, sentence(draw, "en", 40), "en", "b"]]  # one id with three texts
    rows += [[70, None, "en", "a"], [71, "12 34 !", "de", "a"], [72, "", None, "b"], [73, "Read more here now", "en", "a"]]
    for key in (10, 11, 12, 13):
        rows[key][1] += "\nRead more here now"
    return [(key, text, lang, source, len(text) if text is not None else None) for key, text, lang, source in rows]


def letters(text):
    out = []
    for c in text.lower():
        if c.isalpha():
            out.append(c)
        elif out and out[-1] != " ":
            out.append(" ")
    return "".join(out).strip(" ")


def phrases(sample, text):
    count = 0
    for low in range(0, len(text), 256):
        rest = text[low:low + 256]
        while rest:
            n = next((n for n in range(len(rest), 0, -1) if rest[:n] in sample), 1)
            count, rest = count + 1, rest[n:]
    return count


def plain_language(rows):
    texts = {}
    for key, text, lang, _, _ in sorted((r for r in rows if r[1] is not None and r[2] is not None and r[0] is not None), key=lambda r: (r[2], r[0], r[1])):
        texts.setdefault(lang, []).append(text[:400])
    samples = {lang: letters(" ".join(pieces)) for lang, pieces in texts.items()}
    out = []
    for key, text, _, source, chars in rows:
        own = letters(text or "")
        if own:
            cost = {lang: phrases(s, own) * math.log2(len(s) + 1) / len(own) for lang, s in samples.items() if s}
            out.append((key, text, min(sorted(cost), key=cost.get), source, chars))
    return out


def plain_new_lines(rows):
    """Here no key repeats a line within its texts, so lines are judged by key as the stage does."""
    shortened = {}
    for i, (key, text, *_) in enumerate(rows):
        shortened[i] = text
    merged = {}
    for key, text, *_ in rows:
        merged[key] = merged.get(key, "") + ("\n" if key in merged else "") + text
    kept = {key: set(text.split("\n")) for key, text in plain_lines(list(merged.items()), 3).items()}
    out = []
    for key, text, lang, source, _ in rows:
        lines = [line for line in text.split("\n") if line in kept[key] or not line.split()]
        if len(lines) == len(text.split("\n")) or "\n".join(lines).split():
            out.append((key, "\n".join(lines), lang, source, len("\n".join(lines))))
    return out


def plain_groups(rows):
    """Rows that stay: of each component of linked texts, those of the smallest key's text."""
    words = [tuple(re.findall(r"[^\x20\x09-\x0D]+", r[1].translate(LOWER))) for r in rows]
    sets = [{w[i:i + 5] for i in range(len(w) - 4)} if len(w) >= 5 else ({w} if w else set()) for w in words]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]) and group[i] != group[j]:
                group = [group[i] if g == group[j] else g for g in group]
    first = {g: min(rows[i][0] for i in range(len(rows)) if group[i] == g) for g in group}
    return [r for i, r in enumerate(rows) if not sets[i] or r[0] == first[group[i]]]


def test_every_stage_against_plain_python(spark, tmp_path):
    rows = planted()
    spark.createDataFrame(rows, COLUMNS).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    out = corpus_pipeline.run(spark, str(tmp_path))
    pieces = Pieces(corpus_pipeline.PIECES)
    got = sorted(((r["doc_id"], r["lang"], r["source"], pieces.decode(list(r["pieces"])), r["n_pieces"] == len(r["pieces"]) and r["round_trip"])
                  for r in out.collect()), key=repr)
    kept = plain_groups(plain_new_lines(plain_language(rows)))
    assert {5} <= {r[0] for r in kept} and 40 < len(plain_language(rows)) < len(rows)
    db = duckdb.connect()
    frame = spark.createDataFrame(kept, COLUMNS).toPandas()  # noqa: F841  read by the SQL below
    db.execute("CREATE TABLE documents AS SELECT * FROM frame")
    times = {}
    for key, source, *_ in db.execute(f"SELECT doc_id, source FROM ({mixing_sql.MIX})").fetchall():
        times[key, source if source == source else None] = times.get((key, source if source == source else None), 0) + 1
    want = []
    for key, text, lang, source, _ in kept:
        same = sum(r[0] == key and r[3] == source for r in kept)
        want += [(key, lang, source, text, True)] * (times.get((key, source), 0) // same)
    assert got == sorted(want, key=repr)


def test_two_texts_of_one_id(spark):
    base = [sentence(random.Random(i), "en", 60) for i in range(4)]
    rows = [(1, base[0]), (2, base[0] + " end"), (2, base[1]), (3, base[1] + " end"), (4, base[2]), (4, base[2] + " more"), (4, base[2] + " more"), (None, base[0])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = near_duplicates(docs).join(docs.select("text", words_digest(docs["text"]).alias("digest")).distinct(), "digest").collect()
    got = {(r["doc_id"], r["text"]): (r["component_id"], r["kept"], r["stays"]) for r in found}
    assert got[1, base[0]] == (1, True, True) and got[2, base[0] + " end"] == (1, False, False)
    assert got[2, base[1]] == (2, True, True) and got[3, base[1] + " end"] == (2, False, False)
    assert got[4, base[2]][:2] == got[4, base[2] + " more"][:2] == (4, True) and got[4, base[2]][2] != got[4, base[2] + " more"][2]
    stays = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert sorted((r["doc_id"], r["text"][:9]) for r in stays.where("doc_id < 4").collect()) == sorted([(1, base[0][:9]), (2, base[1][:9])])


NAMES = ["total", "quota", "whole", "blocks", "last_block", "_of", "rest", "upto_hash", "_source", "_key", "tokens", "hash", "block", "doc", "_hash",
         "_block", "_tokens", "_lines", "lines", "key", "line", "path", "_lang", "lang_pred", "_words", "_gone_id", "digest", "node", "size", "d.x"]


@pytest.mark.parametrize("stage", [name for name, _ in corpus_pipeline.STAGES])
def test_columns_named_like_internal_ones(spark, stage):
    plain = spark.createDataFrame(planted()[:45], COLUMNS)
    wide = plain.selectExpr("*", *[f"doc_id + {i} AS `{name}`" for i, name in enumerate(NAMES)], "'own' AS `Last_Block2`")
    run = dict(corpus_pipeline.STAGES)[stage]
    got, want = run(spark, wide, ""), run(spark, plain, "")
    if stage == "pieces":
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
        return
    assert got.columns == wide.columns
    assert sorted(map(repr, got.select(*plain.columns).collect())) == sorted(map(repr, want.collect()))
    assert got.where(" or ".join(f"`{name}` != doc_id + {i}" for i, name in enumerate(NAMES))).count() == 0


def test_mix_and_lines_with_clashing_columns(spark):
    plain = spark.createDataFrame(planted(), COLUMNS)
    wide = plain.selectExpr("*", *[f"'v' AS `{name}`" for name in NAMES], "7 AS epoch", "8 AS place", "9 AS n_lines")
    got = mixing.mix(wide)
    assert got.columns == [c for c in wide.columns if c not in ("epoch", "place")] + ["epoch", "place"]
    key = ["doc_id", "text", "epoch", "place"]
    assert sorted(map(repr, got.select(key).collect())) == sorted(map(repr, mixing.mix(plain).select(key).collect()))
    lines = linetemplates.without_repeated_lines(wide, **linetemplates.EVERY_LINE)
    assert lines.columns == [c for c in wide.columns if c != "n_lines"] + ["n_lines", "n_dropped"] and lines.where("path = 'v'").count() == len(planted())


def test_the_mixed_stream_lies_in_order(spark, tmp_path):
    plain = spark.createDataFrame(planted(), COLUMNS).where("text is not null")
    corpus_pipeline.mixed(spark, plain, "").write.parquet(f"{tmp_path}/stream")
    rows = spark.read.parquet(f"{tmp_path}/stream").selectExpr("doc_id", "text", "_metadata.file_name AS f", "_metadata.row_index AS i").collect()
    order = [(r["doc_id"], r["text"]) for r in sorted(rows, key=lambda r: (r["f"], r["i"]))]
    want = [(r["doc_id"], r["text"]) for r in sorted(mixing.mix(plain).collect(), key=lambda r: (r["place"], r["epoch"], r["doc_id"]))]
    assert order == want
