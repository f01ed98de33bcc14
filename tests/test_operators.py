"""Operators against brute force and hand-made cases."""

from __future__ import annotations

import random
import unicodedata
from collections import Counter

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tokenloom.functions import arrays as A, noise as N, text as T, tokens as K
from tokenloom.operators import (filters as P, pairing, ranking as R, scoring, splits, stats, subword as B, tokentables,
                                 trees, vocab as V)
from tokenloom.plans import QUERIES
from tokenloom.plans.common import doc_counts
from tokenloom.session import fresh_path
from tokenloom.sources import readers as I, sinks as O
from tokenloom.streaming import jobs as J

C = F.col


def texts(spark, values, name="text"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"id long, {name} string")


def one(df):
    return [tuple(r) for r in df.collect()]


# --- tokenisers and cleaning ------------------------------------------------

def test_words_match_python_split(spark):
    cases = ["", " a  b ", "x y z\x1c\x85w", "\n\t tab\x0bvt", "one"]
    got = one(texts(spark, cases).select("id", K.words(C("text"))).orderBy("id"))
    assert [g[1] for g in got] == [c.split() for c in cases]


def test_code_parts(spark):
    got = texts(spark, ["camelCase HTTPServer snake_case_Name __x"]).select(K.code_parts(C("text"))).first()[0]
    assert got == ["camel", "Case", "HTTP", "Server", "snake", "case", "Name", "x"]


def test_alnum_runs(spark):
    got = one(texts(spark, [" a b", "", "x  y ", "a, b!"]).select("id", K.alnum_runs(C("text"))).orderBy("id"))
    assert [g[1] for g in got] == [[" ", "a", "b"], [], ["x", "  ", "y", " "], ["a", ", ", "b", "!"]]


def test_ngrams_and_predicate(spark):
    df = texts(spark, ["A b c", ""])
    got = one(df.select("id", K.ngrams(K.words(C("text")), 2, uncased=True)).orderBy("id"))
    assert got[0][1] == ["a", "a b", "b", "b c", "c"] and got[1][1] == []
    kept = df.select(K.ngrams(K.words(C("text")), 2, skip=lambda g: F.array_contains(g, "b"))).first()[0]
    assert kept == ["A", "c"]


def test_comment_literal(spark):
    cases = ["# see  aaaaaaaaa,  ok\n", "#!", "a#b 'x'\ttab"]
    got = one(texts(spark, cases).select("id", T.normalize_literal(C("text"), True)).orderBy("id"))
    assert got[0][1] == "# ▁ see ▁ aaaaa , ▁ ok ENDCOM"
    assert got[1][1] == ""
    assert got[2][1] == "a # b ▁ ' x ' TABSYMBOL tab"


def test_line_comments(spark):
    code = 'x = 1 # one\ny = "# no"\n# whole\n\nz'
    row = texts(spark, [code]).select(T.line_comments(C("text")), T.without_line_comments(C("text"))).first()
    assert row[0] == [" one", " whole"] and row[1] == 'x = 1\ny = \nz\n'
    kept = texts(spark, [code]).select(T.without_line_comments(C("text"), drop_char_before=False)).first()[0]
    assert kept == 'x = 1 \ny = "\nz\n'


def test_quoted_block(spark):
    block, rest = T.quoted_block(C("text"), [('"""', '"""'), ("'''", "'''")])
    got = one(texts(spark, ['a """ d """ b', "x '''q''' y", 'open """ only', "none"]).select("id", block, rest).orderBy("id"))
    assert [g[1:] for g in got] == [("d", "a  b"), ("q", "x  y"), (None, 'open """ only'), (None, "none")]


def test_first_sentence(spark):
    df = texts(spark, ["It's one. two", "no dot"])
    assert [r[0] for r in df.orderBy("id").select(T.first_sentence(C("text"))).collect()] == ["It s one .", "no do ."]
    assert df.where("id = 1").select(T.first_sentence(C("text"), exact=False)).first()[0] == "no dot ."


def test_signature_arguments(spark):
    sig = "int f ( int a , float [ ] b , g ( x ) ) { h ( ) }"
    got = texts(spark, [sig, "f ( )", "f ( ) x"]).select("id", T.argument_types_and_names(C("text")).alias("a")).orderBy("id").collect()
    assert [tuple(x) for x in got[0]["a"]] == [("int ", "a"), ("float [ ]", "b"), ("g ( x ", ")")]
    assert [tuple(x) for x in got[1]["a"]] == [("None", "None")] == [tuple(x) for x in got[2]["a"]]


def test_human_number(spark):
    df = spark.createDataFrame([(0, 0.0), (1, 999.0), (2, 1234.0), (3, 12345678.0), (4, 999999.0), (5, -1500.0), (6, 0.012345)], "id int, x double")
    got = [r[0] for r in df.orderBy("id").select(T.human_number(C("x"))).collect()]
    assert got == ["0", "999", "1.23K", "12.3M", "1M", "-1.5K", "0.0123"]


def test_byte_ids(spark):
    got = texts(spark, ["é", "abcdefgh"]).orderBy("id").select(T.byte_ids(C("text"), 6)).collect()
    assert got[0][0] == [256, 195, 169, 257, 258, 258] and got[1][0] == [256, 97, 98, 99, 100, 257]


def test_comments_above(spark):
    code = "# first\ndef a\n\n# second\ndef b\nx\n# third\ndef c"
    assert texts(spark, [code]).select(T.comments_above(C("text"), "def", "#")).first()[0] == ["# first", "# second"]


def test_nfd(spark):
    words = ["é", "Å", "plain", "한"]
    got = tokentables.normalise_nfd(texts(spark, words, "token")).orderBy("id").collect()
    assert [r["token"] for r in got] == [unicodedata.normalize("NFD", w) for w in words]


def test_offsets(spark):
    rows = tokentables.words_with_offsets(texts(spark, ["ab, c d"]), "id", "text").orderBy("start").collect()
    assert [(r["token"], r["start"], r["stop"]) for r in rows] == [("ab", 0, 2), (",", 2, 3), ("c", 4, 5), ("d", 6, 7)]


# --- sequences ---------------------------------------------------------------

def test_untokenised_keeps_white_space(spark):
    cells = K.words_with_gaps(C("text"))
    df = texts(spark, [" It is  so,\tok\n", "", None]).orderBy("id")
    assert one(df.select(K.untokenised(cells), K.untokenised(F.slice(cells, 2, 3)))) == [("It is  so,\tok", "is  so,"), ("", ""), (None, None)]


def test_sequences(spark):
    df = spark.createDataFrame([([5, 6, 7, 3, 3],)], "a array<int>")
    assert df.select(A.strip_tail(C("a"), [3])).first()[0] == [5, 6, 7]
    assert df.select(A.truncate_with_end(C("a"), 3, 1)).first()[0] == [5, 6, 1]
    assert df.select(A.cut_at(C("a"), 7)).first()[0] == [5, 6]
    assert df.select(A.relative_positions(F.lit(3), 1, True)).first()[0] == [[1, 2, 2], [0, 1, 2], [0, 0, 1]]
    assert df.select(A.length_mask(F.lit(2), F.lit(3))).first()[0] == [True, True, False]
    assert df.select(A.parse_matrix(F.lit('["a b c", "d"]'))).first()[0] == [["a", "b", "c"], ["d", "", ""], ["", "", ""]]


def test_schedule(spark):
    steps = spark.range(0, 40, 10)
    got = [r[0] for r in steps.orderBy("id").select(A.schedule_value("0:0,10:0,20:1", C("id"))).collect()]
    assert got == [0.0, 0.0, 1.0, 1.0]
    with pytest.raises(ValueError):
        A.schedule_value("5:0,5:1", C("id"))


# --- global positions under skew ----------------------------------------------

def test_positions_with_a_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"g{i % 7}", i % 5) for i in range(3000)]
    df = spark.createDataFrame(rows, "id long, grp string, n long").repartition(7)
    got = {r["id"]: r["position"] for r in R.with_global_position(df, ["id"]).collect()}
    assert got == {i: i for i in range(3000)}
    summed = {r["id"]: r["running"] for r in R.with_running_sum(df, ["id"], "n").collect()}
    total = 0
    for i, _, n in rows:
        total += n
        assert summed[i] == total
    seen: Counter = Counter()
    sums: Counter = Counter()
    place = {r["id"]: r["position"] for r in R.with_group_position(df, "grp", ["id"]).collect()}
    running = {r["id"]: r["running"] for r in R.with_group_running_sum(df, "grp", ["id"], "n").collect()}
    for i, g, n in rows:
        sums[g] += n
        assert place[i] == seen[g] and running[i] == sums[g]
        seen[g] += 1


@pytest.mark.parametrize("n_rows", [0, 1, 40, 900])
def test_groups_over_several_partitions(spark, n_rows):
    rows = [(i, None if i % 31 == 0 else "hot" if i % 10 else f"g{i % 3}", i % 5 - 2) for i in range(n_rows)]
    df = spark.createDataFrame(rows, "id long, grp string, n long").repartition(5)
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # keeps all shuffle partitions apart
    try:
        placed = R.with_group_position(df, "grp", ["id"])
        place = {r["id"]: r["position"] for r in placed.collect()}
        running = {r["id"]: r["running"] for r in R.with_group_running_sum(df, "grp", ["id"], "n").collect()}
        plan = placed._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert "SortMergeJoin [grp" not in plan
    seen, sums = Counter(), Counter()
    for i, g, n in rows:
        sums[g] += n
        assert place[i] == seen[g] and running[i] == sums[g]
        seen[g] += 1
    assert len(place) == len(running) == n_rows


def test_weighted_draws_follow_the_weights(spark):
    weights = spark.createDataFrame([("a", 1), ("b", 0), ("c", 3)], "name string, n long")
    drawn = Counter(r["name"] for r in splits.weighted_draws(weights, "name", "n", 4000, "s").collect())
    assert drawn["b"] == 0 and sum(drawn.values()) == 4000 and abs(drawn["c"] - 3000) < 150


def test_skewed_lookup_is_the_whole_join(spark):
    facts = spark.createDataFrame([(i, "hot" if i % 2 else f"k{i % 40}") for i in range(2000)], "id long, k string")
    table = spark.createDataFrame([("hot", 1000, "H")] + [(f"k{i}", i, f"v{i}") for i in range(0, 30)], "k string, w long, v string")
    for how in ("inner", "left"):
        want = sorted(map(str, facts.join(table, "k", how).select("id", "k", "w", "v").collect()))
        assert sorted(map(str, V.skewed_lookup(facts, table, "k", "w", how, hot=2).collect())) == want


def test_top_tokens_with_ties(spark, monkeypatch):
    monkeypatch.setattr(V, "FEW", 5)
    counts = spark.createDataFrame([(f"t{i:03d}", 1 + (i % 4)) for i in range(100)], "token string, n long")
    want = sorted(((f"t{i:03d}", 1 + (i % 4)) for i in range(100)), key=lambda x: (-x[1], x[0]))[:40]
    assert one(V.top_tokens(counts, 40)) == want
    assert V.top_tokens(counts, 500).count() == 100


def test_even_batches_sizes(spark):
    df = spark.range(203)
    sizes = [r["count"] for r in splits.even_batches(df, "id", ["id"], 32).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [29] * 7
    sizes = [r["count"] for r in splits.even_batches(spark.range(10), "id", ["id"], 4).groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [4, 3, 3]


def test_stream_layout(spark):
    rng = random.Random(5)
    docs = [[f"d{d}t{i}" for i in range(rng.choice([0, 1, 3, 50]))] for d in range(30)]
    df = spark.createDataFrame(list(enumerate(docs)), "id long, t array<string>")
    stream = [t for d in docs for t in [*d, "</s>"]]
    streams, steps = 3, 4
    batches = -(-len(stream) // (streams * steps))
    height = batches * steps
    padded = ["</s>"] * (height * streams - len(stream)) + stream
    columns = [["</s>", *padded[c * height:(c + 1) * height]] for c in range(streams)]
    want = {(b, c): columns[c][b * steps:(b + 1) * steps] for b in range(batches) for c in range(streams)}
    got = {(r["batch"], r["stream"]): r["tokens"] for r in splits.stream_batches(df, "id", "t", streams, steps).collect()}
    assert got == want


def test_exact_split_has_equal_shards(spark):
    parts = splits.train_valid_test(spark.range(107).withColumnRenamed("id", "k"), "k", "s", 10, exact=True)
    counts = {(r["split"], r["shard"]): r["count"] for r in parts.groupBy("split", "shard").count().collect()}
    assert counts == {("valid", None): 10, ("test", None): 10, **{("train", i): 10 for i in range(8)}}


def test_last_numbered_needs_enough(spark):
    names = spark.createDataFrame([("checkpoint1.pt",), ("checkpoint12.pt",), ("checkpoint_last.pt",)], "name string")
    assert [r["number"] for r in splits.last_numbered(names, "name", r"checkpoint(\d+)\.pt", 2).collect()] == [12, 1]
    with pytest.raises(Exception):
        splits.last_numbered(names, "name", r"checkpoint(\d+)\.pt", 3).collect()


def test_first_success_tally(spark):
    rows = [(1, 0, "error"), (1, 1, "success"), (1, 2, "success"), (2, 0, "timeout"), (2, 1, "error"), (3, 0, "success")]
    attempts = spark.createDataFrame(rows, "id long, try long, status string")
    results, beams = stats.attempt_tally(attempts, "id", ["try"], "status", "success")
    assert dict(one(results)) == {1: "success", 2: "timeout", 3: "success"}
    assert dict(one(beams)) == {0: 1, 1: 1}


def test_moving_mean_recurrence(spark):
    values = [[1.0, 2.0], [3.0, -1.0], [0.5, 4.0]]
    df = spark.createDataFrame([(i, "p", v) for i, v in enumerate(values)], "ckpt long, name string, v array<double>")
    want = values[0]
    for v in values[1:]:
        want = [x * 0.3 + y * 0.7 for x, y in zip(v, want)]
    got = {r["pos"]: r["value"] for r in stats.parameter_moving_mean(df, "name", "ckpt", "v", 0.3).collect()}
    assert [got[0], got[1]] == pytest.approx(want)


def test_uneven_parameters(spark):
    df = spark.createDataFrame([("m1", "w"), ("m1", "b"), ("m2", "w"), ("m2", "w"), ("m3", "w"), ("m3", "b")], "model string, name string")
    assert one(stats.uneven_parameters(df, "model", "name")) == [("b", 2)]
    assert one(stats.uneven_parameters(df.where("name = 'w'"), "model", "name")) == []


def test_statistics_union_and_sum(spark):
    df = spark.createDataFrame([("a", "x y"), ("a", "x"), ("b", "x z"), ("b", "")], "split string, text string")
    got = {r["split"]: r for r in stats.corpus_statistics(df, "split", K.words(C("text"))).collect()}
    full = got["Fullset"]
    assert (full["records"], full["tokens"], full["unique_tokens"], full["unique_union"]) == (4, 5, 4, 3)


# --- noise ---------------------------------------------------------------------

def test_noise_invariants(spark):
    df = spark.createDataFrame([(i, [f"w{j}" for j in range(i)]) for i in range(1, 60)], "id long, t array<string>")
    rows = df.select(
        "id", "t", N.shuffle_nearby(C("t"), C("id"), "s", 3.0).alias("s"), N.drop_tokens(C("t"), C("id"), "d", 0.95).alias("d"),
        N.mask_for_evaluation(C("t"), C("id"), "m", 0.01, "#").alias("m")).collect()
    again = df.repartition(5).select("id", N.shuffle_nearby(C("t"), C("id"), "s", 3.0).alias("s")).collect()
    assert {r["id"]: r["s"] for r in rows} == {r["id"]: r["s"] for r in again}
    for r in rows:
        assert sorted(r["s"]) == sorted(r["t"]) and r["s"][0] == "w0"
        assert all(abs(r["s"].index(w) - i) <= 3 for i, w in enumerate(r["t"]))
        assert len(r["d"]) >= 1 and [w for w in r["t"] if w in r["d"]] == r["d"]
        assert "#" in r["m"] and len(r["m"]) == len(r["t"])


def test_masking_never_touches_padding(spark):
    df = spark.createDataFrame([(i, [9, 2, 20, 21, 22, 2]) for i in range(300)], "id long, ids array<long>")
    cells = df.select(F.explode(N.mask_for_prediction(C("ids"), C("id"), "m", 0.5, 5, 30, 2)).alias("c"), "id").select("c.*").collect()
    assert all(c["target"] not in (2, 9) for c in cells)
    chosen = [c for c in cells if c["target"] is not None]
    masked = sum(c["input"] == 5 for c in chosen) / len(chosen)
    assert 0.35 < len(chosen) / (300 * 3) < 0.65 and 0.7 < masked < 0.9


def test_document_frequency(spark):
    values = ["a b a c", "", None, "b b b", "c stop a", "stop"]
    got = one(stats.document_frequency(texts(spark, values), "id", K.words(C("text")), 2, ["stop"]))
    split = [[t for t in (v or "").split() if t != "stop"] for v in values]
    seen, every = Counter(t for w in split for t in set(w)), Counter(t for w in split for t in w)
    assert sorted(got) == sorted((t, k, every[t]) for t, k in seen.items() if k >= 2)


# --- subwords --------------------------------------------------------------------

TOY = {"low": 5, "lower": 2, "newest": 6, "widest": 3}


def slow_merges(counts, n):
    words = {w: [*w, "</w>"] for w in counts}
    out = []
    for _ in range(n):
        pairs: Counter = Counter()
        for w, parts in words.items():
            for p in zip(parts, parts[1:]):
                pairs[p] += counts[w]
        if not pairs:
            break
        best = min(pairs, key=lambda p: (-pairs[p], p))
        out.append(best)
        for w in words:
            words[w] = apply_pair(words[w], best)
    return out, words


def apply_pair(parts, pair):
    out, i = [], 0
    while i < len(parts):
        if tuple(parts[i:i + 2]) == pair:
            out.append(parts[i] + parts[i + 1])
            i += 2
        else:
            out.append(parts[i])
            i += 1
    return out


def counts_frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "token string, n long")


def test_toy_merges(spark):
    assert B.learn_merges(counts_frame(spark, TOY), 10) == slow_merges(TOY, 10)[0]


@pytest.mark.parametrize("seed, candidates", [(1, 8), (2, 8), (3, 2048)])
def test_batched_learning_equals_one_at_a_time(spark, seed, candidates):
    rng = random.Random(seed)
    counts = {"".join(rng.choice("aabcde") for _ in range(rng.randint(1, 7))): rng.randint(1, 9) for _ in range(60)}
    want, words = slow_merges(counts, 25)
    merges = B.learn_merges(counts_frame(spark, counts), 25, candidates=candidates, most=5)
    assert merges == want
    got = {r["token"]: r["pieces"] for r in B.segment(counts_frame(spark, counts), merges).collect()}
    for word, parts in words.items():
        assert "".join(got[word]) == word
        joined = "".join(parts)
        assert joined == word + "</w>"


def test_many_merges_of_the_documents(spark):
    counts = {r["token"]: r["n"] for r in doc_counts(spark, "/root/testdata/sf0.001").collect()}
    assert B.learn_merges(counts_frame(spark, counts), 60, candidates=64) == slow_merges(counts, 60)[0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.sampled_from("ab"), st.sampled_from("abc")), unique=True, max_size=5), st.text("abc", min_size=1, max_size=12))
def test_encoding_takes_lowest_rank_first(merges, word):
    ranks = {p: i for i, p in enumerate(merges)}
    parts = [*word, "</w>"]
    while True:
        found = [p for p in zip(parts, parts[1:]) if p in ranks]
        if not found:
            break
        parts = apply_pair(parts, min(found, key=ranks.get))
    parts = [p.removesuffix("</w>") for p in parts]
    assert B._pieces(word, ranks) == (parts[:-1] if parts[-1] == "" else parts)


def test_constrained_pieces(spark):
    merges = [("a", "b"), ("ab", "c"), ("d", "</w>")]
    segmented = B.segment(counts_frame(spark, {"abcd": 3, "ab": 1}), merges)
    vocabulary = spark.createDataFrame([("ab@@", 5), ("c@@", 5)], "piece string, n long")
    got = {r["token"]: r["pieces"] for r in B.constrain(segmented, merges, vocabulary).collect()}
    # the last piece 'd' came from the end mark itself, whose other half is empty
    assert got["abcd"] == ["ab", "c", "d", ""]
    # a last piece needs the unmarked form in the vocabulary; 'ab' is taken apart only by its '</w>' merge, and has none
    assert got["ab"] == ["ab"]


def test_isolate_terms(spark):
    got = texts(spark, ["redKMblueKMKM", "KM", "plain", "7KM"]).orderBy("id").select(B.isolate_terms(C("text"), "KM")).collect()
    assert [r[0] for r in got] == [["red", "KM", "blue", "KM", "KM"], ["KM"], ["plain"], ["7", "KM"]]


def test_splits_keep_every_row(spark):
    for n in (0, 1, 6, 7, 9, 20, 25, 30):
        df = spark.range(n).withColumnRenamed("id", "k")
        split = splits.train_valid_test(df, "k", "s", 10).collect()
        assert len(split) == n and all(r["shard"] is None or 0 <= r["shard"] < 8 for r in split)
        ranges = [r["worker"] for r in splits.worker_ranges(df, "k", 7).orderBy("k").collect()]
        sizes = sorted((ranges.count(w) for w in range(7)), reverse=True)
        assert ranges == sorted(ranges) and sizes == [ranges.count(w) for w in range(7)] and sizes[0] - sizes[-1] <= 1 and sum(sizes) == n


def test_encoded_texts_restore(spark):
    df = texts(spark, ["low lower newest", "widest low"])
    merges = B.learn_merges(counts_frame(spark, TOY), 4)
    encoded = B.encode_texts(df.select("id", K.words(C("text")).alias("t")), "id", "t", B.segment(counts_frame(spark, TOY), merges))
    assert dict(one(encoded.select("id", T.restore_subwords(C("text"))))) == {0: "low lower newest", 1: "widest low"}


# --- scores -----------------------------------------------------------------------

def slow_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], max(row[j + 1], row[j], last + 1 if x == y else 0)
    return row[-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=12), st.lists(st.sampled_from("abcd"), max_size=12))
def test_common_subsequence(a, b):
    assert scoring.common_subsequence(a, b) == slow_lcs(a, b)


def test_rouge(spark):
    df = spark.createDataFrame([(1, "a b c", ["a x c", "b"]), (2, "q", ["z"])], "id long, hyp string, refs array<string>")
    got = dict(one(scoring.rouge_l(df)))
    p, r = 2 / 3, 1.0
    assert got[1] == pytest.approx((1 + 1.44) * p * r / (r + 1.44 * p)) and got[2] == 0.0


def test_ngram_counting_shuffles_texts_once(spark):
    df = spark.createDataFrame([(1, "a b", ["a b"])], "id long, hyp string, refs array<string>").repartition(3)
    plan = scoring.ngram_counts(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1


def test_ngrams_of_an_id_are_counted_where_its_texts_lie(spark):
    """One shuffle of texts; no n-gram is a row of an aggregation or a join, and rows of one id count together."""
    rows = [(1, "a b a b", ["a b a", "b b a b c"]), (1, "a a", ["a a a", None]), (2, None, ["x"]), (3, "x y", None),
            (3, "x y", ["x y y"]), (None, "a b", ["a b"]), (None, "a c", ["a b"]), (6, "a  b c d", ["a b c d", "d c"]), (7, "", [""])]
    df = spark.createDataFrame(rows, "id long, hyp string, refs array<string>").repartition(3)
    found = scoring.overlap_statistics(df)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("hashpartitioning") == 1 and "Aggregate" not in plan and "Join" not in plan
    got = sorted(map(str, map(tuple, found.select("id", "hyp_len", "shortest", "closest", "average", *[f"match{n}" for n in scoring.ORDERS]).collect())))
    assert got == sorted(map(str, [
        (1, 4, 3, 3, 4.0, 6, 3, 2, 0), (1, 2, 3, None, None, 6, 3, 2, 0), (2, None, 1, 1, 1.0, 0, 0, 0, 0),
        (3, 2, None, None, None, 2, 1, 0, 0), (3, 2, 3, 3, 3.0, 2, 1, 0, 0), (None, 2, 2, 2, 2.0, 0, 0, 0, 0),
        (None, 2, 2, 2, 2.0, 0, 0, 0, 0), (6, 4, 2, 4, 3.0, 4, 3, 2, 1), (7, 0, 0, 0, 0.0, 0, 0, 0, 0)]))
    counts = {tuple(r) for r in scoring.ngram_counts(df).where("id = 3").collect()}
    assert counts == {(3, 1, "x", 1, 1), (3, 1, "y", 1, 2), (3, 2, "x y", 1, 1), (3, 2, "y y", 0, 1), (3, 3, "x y y", 0, 1)}


def test_perfect_prediction(spark):
    text = "the cat sat on the mat"
    df = spark.createDataFrame([(1, text, [text, "other words"])], "id long, hyp string, refs array<string>")
    s = scoring.overlap_statistics(df)
    assert s.select(scoring.bleu(True)).first()[0] == pytest.approx(1.0)
    assert scoring.token_f1(df).first()["f1"] == pytest.approx(1.0)


# --- trees --------------------------------------------------------------------------

PAGE = "<div><ul><li><a>x y</a></li><li>z</li></ul><h1>t</h1><div></div></div><footer>f</footer>"


def page_nodes(spark):
    return trees.nodes(trees.events(spark.createDataFrame([(7, PAGE)], "page long, html string"), "page", "html"))


def test_node_table(spark):
    rows = page_nodes(spark).orderBy("node_id").collect()
    assert [(r["label"] or r["value"], r["level"], r["parent"], r["first_leaf"], r["last_leaf"]) for r in rows] == [
        ("div", 0, None, 0, 2), ("ul", 1, 0, 0, 1), ("li", 2, 1, 0, 0), ("a", 3, 2, 0, 0), ("x y", 4, 3, 0, 0), ("li", 2, 1, 1, 1),
        ("z", 3, 5, 1, 1), ("h1", 1, 0, 2, 2), ("t", 2, 7, 2, 2), ("div", 1, 0, 3, 2), ("footer", 0, None, 3, 3), ("f", 1, 10, 3, 3)]


def outline(spark, html):
    df = spark.createDataFrame([(1, html)], "page long, html string")
    rows = trees.nodes(trees.events(df, "page", "html")).orderBy("node_id").collect()
    assert all(r["last_node"] is not None and r["last_leaf"] is not None for r in rows)
    return " ".join(str(r["level"]) + (r["label"] or repr(r["value"])) for r in rows)


@pytest.mark.parametrize("html, expected", [
    ("<table><tr><td>x", "0table 1tr 2td 3'x'"),
    ("<TABLE><TR><TD>a<td>b<tr><td>c</TABLE>d", "0table 1tr 2td 3'a' 2td 3'b' 1tr 2td 3'c' 0'd'"),
    ("<ul><li>a<li><ul><li>b</ul>c<li>d</ul>", "0ul 1li 2'a' 1li 2ul 3li 4'b' 2'c' 1li 2'd'"),
    ("<p><b>x<br>y<p>z</p></p>w", "0p 1b 2'x' 2br 2'y' 0p 1'z' 0'w'"),
    ("<html><head><meta a=b><title>t</title><body>x", "0html 1head 2meta 2title 3't' 1body 2'x'"),
    ("</div>a < b<x-y q='1'>c</nope></x-y>", "0'a' 0'< b' 0x-y 1'c'"),
    ("<dl><dt>k<dd>v<dt>l</dl><select><option>1<option>2</select>", "0dl 1dt 2'k' 1dd 2'v' 1dt 2'l' 0select 1option 2'1' 1option 2'2'"),
    ("<!DOCTYPE html><SCRIPT>var t='<p>'</SCRIPT><!-- <i> -->t<em", "0't' 0'<em'"),
])
def test_pages_that_are_not_well_formed(spark, html, expected):
    assert outline(spark, html) == expected


def test_page_balance(spark):
    df = spark.createDataFrame([(1, "<div><p>a<p>b<br></div></i>"), (2, ""), (3, None)], "page long, html string")
    rows = {r["doc"]: (r["opened"], r["implied"], r["ignored"]) for r in trees.balance_report(df, "page", "html").collect()}
    assert rows[1] == (3, 2, 1) and rows[2] == rows[3] == (0, 0, 0)


def test_words_of_longer_leaves_are_split(spark):
    df = spark.createDataFrame([(1, "<a>lower lower</a><b>lower</b>")], "page long, html string")
    merged = trees.merge_trees(trees.split_trees(trees.nodes(trees.events(df, "page", "html"))))
    known = spark.createDataFrame([("lower", 3, ["low", "er"])], "token string, n long, pieces array<string>")
    got = sorted(tuple(r) for r in trees.subword_children(merged, known, K.words).select("node_id", "word_no", "piece", "label").collect())
    assert got == [(2, 0, "er", "a_bpe"), (2, 0, "low", "a_bpe"), (2, 1, "er", "a_bpe"), (2, 1, "low", "a_bpe"),
                   (4, 0, "er", "b_bpe"), (4, 0, "low", "b_bpe")]


def test_covered_leaves(spark):
    merged = trees.merge_trees(trees.split_trees(page_nodes(spark)))
    got = {r["node_id"]: (r["leaves"], r["total"]) for r in trees.covered_leaves(merged, F.length).collect()}
    assert got[0] == (4, 6) and got[1] == (3, 5) and got[2] == (2, 4) and 10 not in got


def test_tree_summary_and_merge_order(spark):
    merged = trees.merge_trees(trees.split_trees(page_nodes(spark)))
    row = trees.leaves_labels_spans(merged).first()
    assert row["leaves"] == ["x y", "z", "t", "f"] and row["pos_tags"] == ["footer", "h1", "li", "a"]
    assert row["labels"] == ["ROOT", "div", "ul", "li"] and row["spans"] == [[0, 3], [0, 2], [0, 1], [0, 0]]
    steps = [(r["left"], r["right"], r["parent"]) for r in trees.merge_order(merged).orderBy("step").collect()]
    assert steps == [(0, 1, 4), (4, 2, 5), (5, 3, 6)]  # ((("x y" z) t) f)


def test_unary_chains(spark):
    merged = trees.merge_trees(trees.split_trees(page_nodes(spark)))
    labels = [r["label"] for r in trees.collapse_unary(merged, True, join="+").orderBy("node_id").collect()]
    assert labels == ["ROOT", "div", "ul", "li+a", "li", "h1", "div", "footer"]
    last = [r["label"] for r in trees.collapse_unary(merged, True).orderBy("node_id").collect()]
    assert last[3] == "a"


def test_edges(spark):
    row = trees.edge_check(page_nodes(spark)).first()
    assert (row["edges"], row["matched"], row["repeated"]) == (10, 10, 0)


# --- files and streams -----------------------------------------------------------------

def test_numbered_lines_over_splits_and_files(spark):
    root = fresh_path(spark, "lines")
    lines = [f"line {i} " + "x" * (i % 17) for i in range(4000)]
    df = spark.createDataFrame(list(enumerate(lines)), "i long, value string").repartitionByRange(3, "i").sortWithinPartitions("i")
    O.write_text_lines(df.select("value"), root)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        got = {r["line_no"]: r["line"] for r in I.read_numbered_lines(spark, root).collect()}
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert [got[i] for i in range(4000)] == lines


def test_source_tree_marks_bad_bytes(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.py").write_text("x = 1\n")
    (tmp_path / "sub" / "b.py").write_bytes(b"\xff\xfe bad")
    (tmp_path / "c.txt").write_text("no")
    rows = {r["path"].rsplit("/", 1)[1]: (r["content"], r["valid"]) for r in I.read_source_tree(spark, str(tmp_path)).collect()}
    assert rows == {"a.py": ("x = 1\n", True), "b.py": (None, False)}


def lines_frame(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_no long, line string")


def test_vocabulary_lines(spark):
    lines = ["the 9", "bad", "a b c", "the 4", "<unk> 3", "cat 2", "x  1"]
    got = I.parse_vocabulary(lines_frame(spark, lines), A.CORPUS_IDS, 14).orderBy("id").collect()
    assert [tuple(r) for r in got] == [("the", 9, 14), ("cat", 2, 15)]


def test_merge_lines(spark):
    lines = ["#version: 0.2", "a b", "c d", "a b", "e f"]
    got = sorted(one(I.parse_merges(lines_frame(spark, lines), 3)))
    assert got == [("a", "b", 0), ("c", "d", 1)]
    with pytest.raises(Exception):
        I.parse_merges(lines_frame(spark, ["a b", "abc"])).collect()


def test_unequal_parallel_files(spark):
    paths = {}
    for name, n in (("src", 5), ("tgt", 4)):
        paths[name] = fresh_path(spark, name)
        O.write_text_lines(spark.range(n).coalesce(1).select(C("id").cast("string")), paths[name])
    rows = I.read_parallel(spark, paths)
    assert [r["line_no"] for r in I.unequal_lines(rows, ["src", "tgt"]).collect()] == [4]


def test_ingest_takes_only_new_files(spark):
    source, output, state = (fresh_path(spark, n) for n in ("in", "out", "state"))
    schema = "doc_id long, source string, text string"
    seen = []
    for i in range(2):
        spark.createDataFrame([(i, "s", "a b c")], schema).write.mode("append").parquet(source)
        J.ingest_new_files(J.file_stream(spark, source, spark.read.parquet(source).schema), output, state)
        seen.append(sorted(r["doc_id"] for r in spark.read.parquet(output).collect()))
    assert seen == [[0], [0, 1]]


def test_code_parts_cut_whole_texts(spark):
    values = ["parseHTTPUrl _my_var__x aB_cD", "  \u2003HTTPServer\u00a0fooBar\x1cx ", "", None, "_", "\U0001d54faB"]
    df = texts(spark, values)
    by_token = F.flatten(F.transform(F.flatten(F.transform(K.words(C("text")), K.snake_parts)), K.camel_parts))
    camel = F.flatten(F.transform(K.words(C("text")), K.camel_parts))
    found = df.select(K.code_parts(C("text")).alias("both"), by_token.alias("b"), K.code_parts(C("text"), snake=False).alias("camel"), camel.alias("c"))
    for r in found.collect():
        assert (r.both, r.camel) == (r.b, r.c)
    assert "lambda" not in found.select("both")._jdf.queryExecution().optimizedPlan().toString().lower()  # no pattern per token


def test_words_are_those_of_python(spark):
    values = ["".join(f"a{c}{c}b" for c in K.BLANKS) + "\u200b \u180e\n", "\u00e9\U0001d54f x", " ", "", None]
    got = [r.w for r in texts(spark, values).orderBy("id").select(K.words(C("text")).alias("w")).collect()]
    assert got == [None if v is None else v.split() for v in values]
    assert K.SPACE not in texts(spark, values).select(K.words(C("text")))._jdf.queryExecution().optimizedPlan().toString()  # no pattern


@pytest.mark.parametrize("files", [1, 3])
def test_ingest_of_a_table_of_one_or_several_files(spark, tmp_path, files):
    rows = spark.createDataFrame([(i, "s", "a b c") for i in range(6)], "doc_id long, source string, text string")
    path = f"{tmp_path}/documents.parquet"
    if files == 1:
        rows.toPandas().to_parquet(path)
    else:
        rows.repartition(files).write.parquet(path)
    spark.createDataFrame([(9, "s", "x")], rows.schema).write.parquet(f"{tmp_path}/others.parquet")
    assert sorted(one(QUERIES["t01_incremental_ingest"](spark, str(tmp_path)))) == [(i, "s", 3) for i in range(6)]


def test_filters(spark):
    df = spark.createDataFrame([(1, "a b", "x"), (2, "", "y"), (3, "a b c", "")], "id long, s string, t string")
    kept = P.drop_empty(df, K.words(C("s")), K.words(C("t"))).collect()
    assert [r["id"] for r in kept] == [1]
    assert P.drop_long(df, 0, K.words(C("s"))).count() == 3 and P.drop_long(df, 2, K.words(C("s"))).count() == 2
    good, bad = P.quarantine(df.withColumn("f", F.when(C("id") == 1, F.lit(False)).when(C("id") == 2, F.lit(True))), C("f"))
    assert (good.count(), bad.count()) == (1, 2)


def test_next_turn_pairs(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (1, 3, "user", "v"), (2, 0, "user", "w")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert one(pairing.next_turn_pairs(df)) == [(1, 1, "u", "a")]
