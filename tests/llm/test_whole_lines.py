"""Repeated lines of any length, and templates that do not depend on how the work is dealt."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from tokenloom.llm import linetemplates
from tokenloom.llm.queries import QUERIES


def test_short_and_rare_lines_go(spark, tmp_path):
    often = ["Read more", "Les.", "Page 7", "Log in to your account"]
    rows = [(key, "\n".join([*(line for line in often if key < 3), "Twice here" if key < 2 else "once", f"{key}{key}", f"{key} {key} {key}", "2024",
                             f"text{'abcd'[key]} alone", " "]), "en", "s", 5) for key in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r["n_dropped"] for r in QUERIES["op6_line_dedup"](spark, str(tmp_path)).collect()}
    assert got == {0: 0, 1: 5, 2: 5, 3: 1}
    kept = {r["doc_id"]: r["text"].split("\n") for r in corpus_pipeline.new_lines(spark, docs, "").collect()}
    assert kept[0] == rows[0][1].split("\n") and kept[3] == ["once", "33", "3 3 3", "textd alone", " "]
    assert kept[1] == ["Twice here", "11", "1 1 1", "textb alone", " "] and kept[2] == ["once", "22", "2 2 2", "textc alone", " "]


def plain(rows, min_docs):
    """Texts without recurring lines, by comparing each line with each other one of its path."""
    docs, group = {}, {}
    for key, text in rows:
        for line in text.split("\n"):
            docs.setdefault(line, set()).add(key)
            group[line] = line
    for a in docs:
        for b in docs:
            x, y = a.split(), b.split()
            if len(x) == len(y) and x[:3] == y[:3] and sum(map(str.__eq__, x, y)) / len(x) >= 0.7 and group[a] != group[b]:
                old = group[b]
                group = {line: group[a] if g == old else g for line, g in group.items()}
    met = {}
    for line, g in group.items():
        met.setdefault(g, set()).update(docs[line])
    gone = lambda key, line: len(met[group[line]]) >= min_docs and key != min(met[group[line]])
    return {key: "\n".join(line for line in text.split("\n") if not gone(key, line)) for key, text in rows}


def free_text(seed):
    """Lines of one opening and different ends, among them 'x5 Y0', 'x5 Y1' and others that end in Y1."""
    draw = random.Random(seed)
    rows = []
    for key in range(40):
        lines = [" ".join(["one", "same", "start", *(f"{place}{draw.choice('abcdefgh')}" for place in "pqrstuvw"[:n])]).replace("p", "P")
                 for n in (1, 2, 2, 3, 3, 4, 5, 6, 7)]
        rows.append((key, "\n".join([*lines, f"go on to x{'abcdefgh'[key % 8]} Y{'abc'[key % 3]}"])))
    return rows


@pytest.mark.parametrize("group", [1000, 7, 2])
def test_templates_do_not_depend_on_the_dealing(spark, monkeypatch, group):
    monkeypatch.setattr(linetemplates, "GROUP", group)
    rows = free_text(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for min_docs in (3, 10):
        got = {r["doc_id"]: r["text"] for r in linetemplates.without_repeated_lines(docs, min_docs=min_docs, min_tokens=1).collect()}
        want = plain(rows, min_docs)
        assert got == want and 0 < sum(a != b for a, b in zip(want.values(), dict(rows).values())) and any("same" in t for t in list(want.values())[5:])


def test_no_task_holds_a_path(spark, monkeypatch):
    """Lines of one opening and free ends go to tasks by two blocks at a time, long lines in smaller ones."""
    monkeypatch.setattr(linetemplates, "GROUP", 20)
    for tokens, most in ((6, 80), (640, 16)):
        rows = [(1, key, "one same start " + " ".join(["all", *(f"w{key}x{i}" for i in range(tokens - 4))]), key, 7, 400) for key in range(400)]
        frame = spark.createDataFrame(rows, "path long, line long, content string, root long, bucket long, n long")
        got = linetemplates.dealt(frame.drop("content"), frame).groupBy("one", "other").count().collect()
        assert len(got) > 100 and max(r["count"] for r in got) <= most
