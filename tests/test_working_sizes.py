"""Operators at working size and under repetition: many merges, long texts, many tasks, restarted streams."""

from __future__ import annotations

import os
import random
import re
import tracemalloc
from collections import Counter, defaultdict
from urllib.parse import unquote

import pytest
from pyspark.sql import functions as F

from tests.test_operators import apply_pair, counts_frame
from tokenloom import session
from tokenloom.functions import arrays as A, tokens as K
from tokenloom.functions.hashing import permuted
from tokenloom.operators import merges as M, scoring, stats, subword as B, vocab as V
from tokenloom.plans import QUERIES
from tokenloom.plans.common import doc_counts
from tokenloom.session import placed_by
from tokenloom.sources import readers as I, sinks as O
from tokenloom.streaming import jobs as J

C = F.col
FOLDER = "/root/testdata/sf0.001"


# --- merges ----------------------------------------------------------------------

def plain_learner(counts, merges):
    """One merge at a time; pair counts are kept up to date over the words that hold the pair."""
    words = {w: [*w, "</w>"] for w in counts}
    totals, where = Counter(), defaultdict(set)
    for w, parts in words.items():
        for p in zip(parts, parts[1:]):
            totals[p] += counts[w]
            where[p].add(w)
    out = []
    for _ in range(merges):
        best = min((p for p in totals if totals[p] > 0), key=lambda p: (-totals[p], p), default=None)
        if best is None:
            break
        out.append(best)
        for w in list(where[best]):
            was, now = words[w], apply_pair(words[w], best)
            for p in zip(was, was[1:]):
                totals[p] -= counts[w]
            for p in zip(now, now[1:]):
                totals[p] += counts[w]
                where[p].add(w)
            words[w] = now
    return out


@pytest.fixture(scope="module")
def document_words(spark):
    return {r["token"]: r["n"] for r in doc_counts(spark, FOLDER).collect()}


@pytest.fixture(scope="module")
def thousand(document_words):
    return plain_learner(document_words, 1000)


@pytest.mark.parametrize("candidates", [4096, 150])
def test_a_thousand_merges(spark, document_words, thousand, candidates):
    asked = 1000 if candidates > 1000 else 500
    assert M.learn_merges(counts_frame(spark, document_words), asked, candidates=candidates) == thousand[:asked]


@pytest.mark.parametrize("seed", range(4))
def test_merges_to_the_end(spark, seed):
    """Few letters, so that pairs repeat inside words, results of different pairs coincide, and counts tie."""
    rng = random.Random(seed)
    counts = {"".join(rng.choice("ab" if seed % 2 else "abc</w>") for _ in range(rng.randint(1, 9))): rng.randint(1, 3) for _ in range(40)}
    counts["a"] = 2
    assert M.learn_merges(counts_frame(spark, counts), 10_000, candidates=6, most=7) == plain_learner(counts, 10_000)


def test_no_words(spark):
    assert M.learn_merges(spark.createDataFrame([], "token string, n long"), 5) == []
    assert M.learn_merges(spark.createDataFrame([(None, 3), ("", 2)], "token string, n long"), 5) == []


def slow_pieces(word, ranks):
    parts = [*word, "</w>"]
    while True:
        found = [p for p in zip(parts, parts[1:]) if p in ranks]
        if not found:
            break
        parts = apply_pair(parts, min(found, key=ranks.get))
    parts = [p.removesuffix("</w>") if i == len(parts) - 1 else p for i, p in enumerate(parts)]
    return parts[:-1] if parts[-1] == "" else parts


def test_a_thousand_merges_encoded(spark, document_words, thousand):
    ranks = {p: i for i, p in enumerate(thousand)}
    got = {r["token"]: list(r["pieces"]) for r in B.segment(counts_frame(spark, document_words), thousand).collect()}
    assert got == {w: slow_pieces(w, ranks) for w in document_words}


def test_encoding_shuffles_texts_not_tokens(spark):
    """Null, repeated and empty rows, against a plain loop; the tokens of a text stay where the text is (F1)."""
    rows = [(1, "low lower newest"), (2, None), (3, " "), (None, "widest w"), (1, "newest zq é low"), (None, "low"), (4, "low " * 500), (5, "lower"), (1, "n")]
    split = {"low": ["lo", "w"], "lower": ["l", "ow", "er"], "newest": ["new", "est"], "w": ["w"], "n": ["n"]}
    segmented = session.staged(spark.createDataFrame([(t, 9 - len(t), p) for t, p in split.items()], "token string, n bigint, pieces array<string>"), "segmented")
    frame = spark.createDataFrame(rows, "id bigint, text string").repartition(3)
    want = defaultdict(list)
    for key, text in rows:
        for place, word in enumerate((text or "").split()):
            want[key].append((place, "@@ ".join(split.get(word, [word]))))
    want = sorted(((key, " ".join(out for _, out in sorted(cells))) for key, cells in want.items()), key=repr)
    for df, tokens in ((frame, K.words(F.col("text"))), (frame.select("id", K.words(F.col("text")).alias("t")), "t")):
        encoded = B.encode_texts(df, "id", tokens, segmented)
        assert encoded.columns == ["id", "text"]
        assert sorted(map(tuple, encoded.collect()), key=repr) == want
        plan = encoded._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" not in plan and "collect_list" not in plan


def test_learning_lets_its_shuffles_go(spark, monkeypatch):
    """Shuffles of earlier steps are let go at each rebuild of the shards and at the end (F2)."""
    calls = []
    monkeypatch.setattr(M, "release", calls.append)
    assert len(M.learn_merges(doc_counts(spark, FOLDER), 60)) == 60 and len(calls) > 1


def test_lowest_rank_first_on_random_lists():
    rng = random.Random(9)
    for _ in range(3000):
        pairs = [("".join(rng.choice("ab") for _ in range(rng.randint(1, 2))), "".join(rng.choice("ab") for _ in range(rng.randint(1, 2))))
                 for _ in range(rng.randint(0, 7))]
        ranks = {p: i for i, p in enumerate(dict.fromkeys(pairs))}
        parts = word = [rng.choice("ab") for _ in range(rng.randint(1, 14))]
        while found := [p for p in zip(parts, parts[1:]) if p in ranks]:
            parts = apply_pair(parts, min(found, key=ranks.get))
        assert B.lowest_rank_first(word, ranks) == parts


def test_long_word_is_encoded_fast():
    ranks = {("a" * k, "a" * k): i for i, k in enumerate((1, 2, 4, 8, 16))}
    assert B.lowest_rank_first(["a"] * 200_000, ranks) == ["a" * 32] * 6250


def test_merge_file_round_trip(spark, thousand, tmp_path):
    path = B.saved_merges(thousand, spark, f"{tmp_path}/merges")
    assert B.loaded_merges(spark, path) == thousand and B.loaded_merges(spark, path, 7) == thousand[:7]


def test_a_thousand_merges_constrained(spark, document_words, thousand):
    halves = {l + r: (l, r) for l, r in thousand}
    segmented = B.segment(counts_frame(spark, document_words), thousand)
    kept = {r["piece"] for r in B.piece_vocabulary(segmented, 60).collect()}

    def taken_apart(piece, final):
        if (piece if final else piece + "@@") in kept:
            return [piece]
        pair = halves.get(piece + "</w>" if final else piece)
        if pair is None:
            return [piece]
        left, right = pair
        return taken_apart(left, False) + taken_apart(right.removesuffix("</w>") if final else right, final)

    vocabulary = spark.createDataFrame([(p,) for p in kept], "piece string")
    got = {r["token"]: list(r["pieces"]) for r in B.constrain(segmented, thousand, vocabulary).collect()}
    for r in segmented.collect():
        want = [q for i, p in enumerate(r["pieces"]) for q in taken_apart(p, i == len(r["pieces"]) - 1)]
        assert got[r["token"]] == want


# --- order, long texts ----------------------------------------------------------

def test_permuted_is_one_to_one(spark):
    places = {}
    for n in (1, 2, 3, 7, 64, 1000):
        rows = spark.range(n).select("id", permuted(C("id"), F.lit(n).cast("long"), "s").alias("p"), permuted(C("id"), F.lit(n).cast("long"), "t").alias("q")).collect()
        assert sorted(r["p"] for r in rows) == sorted(r["q"] for r in rows) == list(range(n))
        places[n] = [r["p"] for r in sorted(rows)], [r["q"] for r in sorted(rows)]
    p, q = places[1000]
    assert p != q and sum(a == b for a, b in zip(p, q)) < 12 and sum(abs(a - i) for i, a in enumerate(p)) / 1000 > 250


def test_common_subsequence_of_long_texts():
    rng = random.Random(1)
    left = [f"w{i}" for i in range(20_000)]
    right = left[::2] + [f"x{i}" for i in range(10_000)]
    tracemalloc.start()
    assert scoring.common_subsequence(left, right) == 10_000
    assert tracemalloc.get_traced_memory()[1] < 50_000_000
    tracemalloc.stop()
    a, b = ([rng.choice("abc") for _ in range(9000)] for _ in range(2))
    whole = scoring.common_subsequence(a, b)
    scoring.COLUMNS, was = 17, scoring.COLUMNS
    try:
        assert scoring.common_subsequence(a, b) == whole
    finally:
        scoring.COLUMNS = was


def test_relative_runs_expand_to_the_matrix(spark):
    lengths = spark.range(14).select(C("id").cast("int").alias("n"))
    for limit in (0, 1, 3, 20):
        for signed in (True, False):
            for r in lengths.select("n", A.relative_positions(C("n"), limit, signed).alias("m"), A.relative_runs(C("n"), limit, signed).alias("r")).collect():
                rows = [[] for _ in range(r["n"])]
                for run in r["r"]:
                    rows[run["row"]] += [run["value"]] * run["times"]
                assert rows == [list(x) for x in r["m"]] and len(r["r"]) <= r["n"] * (2 * limit + 1)


# --- scans and sinks ------------------------------------------------------------

def test_numbered_lines_are_not_shuffled(spark, tmp_path):
    spark.range(0, 5000, 1, 7).selectExpr("concat('line ', id) AS value").write.text(f"{tmp_path}/lines")
    lines = I.read_numbered_lines(spark, f"{tmp_path}/lines")
    assert [r["line"] for r in lines.orderBy("line_no").collect()] == [f"line {i}" for i in range(5000)]
    plan = lines._jdf.queryExecution().executedPlan().toString()
    scan_side = plan.split("BroadcastExchange")[0]  # the block table's own sums are below it
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in scan_side and "SortMergeJoin" not in plan


def files_below(folder):
    return {d: len([f for f in names if f.startswith("part-")]) for d, _, names in os.walk(folder) if any(f.startswith("part-") for f in names)}


def test_sinks_write_files_of_even_size(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 200).select(
        "id", F.when(C("id") % 3 > 0, 0).otherwise(C("id") % 8).cast("int").alias("shard"), F.lit("train").alias("split"), F.sha2(C("id").cast("string"), 512).alias("text"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        O.write_shards(rows, f"{tmp_path}/shards")
        O.write_text_lines(rows.select("text", F.concat(F.lit("k"), "shard").alias("kind")), f"{tmp_path}/kinds", "kind")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    for folder in ("shards", "kinds"):
        found = files_below(f"{tmp_path}/{folder}")
        hot = max(found.values())
        assert sum(found.values()) <= 40 and 3 <= hot <= 20, found  # not 200 tasks x 8 folders, and the hot shard is in several files
    assert spark.read.parquet(f"{tmp_path}/shards").count() == 40_000 and spark.read.text(f"{tmp_path}/kinds").count() == 40_000


@pytest.mark.parametrize("bad", ["id < 0", "id % 7 = 0", "id >= 0", "nullif(id % 2, 1) = 1"])
def test_quarantine_counts_in_one_pass(spark, tmp_path, bad):
    rows = spark.range(500).withColumn("_failed", F.lit("own"))
    good, failed, counted = O.write_quarantined(rows, F.expr(bad), f"{tmp_path}/q")
    want = [i for i in range(500) if (bad == "id >= 0") or (bad == "id % 7 = 0" and i % 7 == 0) or (bad.startswith("null") and i % 2)]
    assert sorted(r["id"] for r in failed.collect()) == want and counted == {"rows": 500, "failed": len(want)}
    assert sorted(r["id"] for r in good.collect()) == sorted(set(range(500)) - set(want)) and good.columns == rows.columns


# --- streams --------------------------------------------------------------------

def arrivals(spark, folder, groups, number):
    spark.createDataFrame([(g, "word " * n) for g, n in groups], "source string, text string").coalesce(1).write.mode("append").parquet(f"{folder}/in{number}")


def test_counters_while_it_runs(spark, tmp_path):
    for number in range(3):
        spark.range(number * 100, number * 100 + 100).coalesce(1).write.parquet(f"{tmp_path}/in/{number}")
    schema = spark.range(1).schema
    for bad, share in (("id < 0", 0), ("id % 4 = 0", 75), ("id >= 0", 300)):
        told = []
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        out = f"{tmp_path}/out{share}"
        last = J.prepare_counted(stream, F.expr(bad), out, f"{out}-state", told.append)
        assert last == {"rows": 300, "failed": share} and [t["rows"] for t in told] == [100, 200, 300]
        assert spark.read.parquet(out).where("failed = 'true'").count() == share


def test_running_statistics_restart_and_repeat(spark, tmp_path):
    schema = spark.createDataFrame([], "source string, text string").schema
    source, output, state = f"{tmp_path}/in", f"{tmp_path}/out", f"{tmp_path}/state"
    want = defaultdict(lambda: [0, 0, 0])
    rng = random.Random(5)
    for day in range(7):
        groups = [(rng.choice(["a", "b", "c", None] if day else ["a"]), rng.randint(0, 60)) for _ in range(20)] if day != 3 else [("b", 5)]
        spark.createDataFrame([(g, "word " * n) for g, n in groups], "source string, text string").coalesce(1).write.parquet(f"{source}/{day}")
        for g, n in groups:
            want[g][0] += 1
            want[g][1] += n
            want[g][2] += n < 30
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", "true").parquet(source)
        J.running_statistics(stream, "source", output, state, compact_every=3)  # each day is a restart
        got = {r["source"]: [r["records"], r["tokens"], r["rejected"]] for r in J.latest_statistics(spark, output).collect()}
        assert got == dict(want)
        if day == 3:
            assert spark.read.parquet(f"{output}/changes/batch=3").count() == 1  # changed groups only
    assert len(J._batches(spark, output)) <= 6 and len(J._bases(spark, output)) == 2
    # a batch that runs again replaces its own folder
    batch = spark.read.parquet(f"{output}/changes/batch=6")
    spark.createDataFrame(batch.collect(), batch.schema).write.mode("overwrite").parquet(f"{output}/changes/batch=6")
    assert {r["source"]: [r["records"], r["tokens"], r["rejected"]] for r in J.latest_statistics(spark, output).collect()} == dict(want)


# --- sketches and filters -------------------------------------------------------

def test_length_density_error_bound(spark):
    rows = spark.range(0, 50_000, 1, 16).select((C("id") % 2).alias("g"), F.floor(F.pow(F.lit(1.0002), C("id") % 45_000)).alias("l"))
    sketches = stats.length_sketches(rows, "g", C("l"))
    edges = stats.quantile_edges(sketches, 10).first()["edges"]
    lengths = sorted(r["l"] for r in rows.collect())
    spans = [(sum(x < edge for x in lengths) / 50_000, sum(x <= edge for x in lengths) / 50_000) for edge in edges]
    for i in range(11):  # equal quantiles are one edge
        assert any(low - 0.01 <= i / 10 <= high + 0.01 for low, high in spans)
    bins = stats.length_density(rows, "g", C("l"), stats.quantile_edges(sketches, 10)).collect()
    for g in (0, 1):
        mine = [r for r in bins if r["g"] == g]
        assert sum(r["n"] for r in mine) == 25_000
        assert abs(sum(r["density"] * max(1, r["high"] - r["low"]) for r in mine) - 1) < 1e-9


def test_membership_filter_has_no_misses(spark):
    keys = spark.range(20_000).select(C("id").cast("string").alias("k"))
    found = spark.range(40_000).select("id", V.may_hold(V.membership_filter(keys, "k"), C("id").cast("string")).alias("m")).collect()
    assert all(r["m"] for r in found if r["id"] < 20_000)
    assert sum(r["m"] for r in found if r["id"] >= 20_000) < 400


# --- placement -------------------------------------------------------------------

def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_index_shuffles_texts_not_tokens(spark):
    df = spark.createDataFrame([(1, "a b a"), (2, ""), (3, None), (1, "c b")], "doc long, text string")
    vocab = spark.createDataFrame([("a", 9, 4), ("b", 3, 5)], "token string, n long, id long")
    found = V.index(df, "doc", K.words(C("text")), vocab, 0)
    assert {r["doc"]: sorted(r["ids"]) for r in found.collect()} == {1: [0, 4, 4, 5, 5], 2: [], 3: []}
    shuffles = [line for line in plan(found).splitlines() if "hashpartitioning(doc" in line]
    assert shuffles and all("REPARTITION_BY_NUM" in line for line in shuffles)


def test_more_bytes_make_more_partitions(spark, tmp_path, monkeypatch):
    rows = spark.range(5000).select("id", F.md5(C("id").cast("string")).alias("text"))
    rows.repartition(3).write.parquet(f"{tmp_path}/a table")
    given = int(spark.conf.get("spark.sql.shuffle.partitions"))
    read = spark.read.parquet(f"{tmp_path}/a table")
    assert placed_by(read, "id").rdd.getNumPartitions() == given == placed_by(rows, "id").rdd.getNumPartitions()
    size = sum(os.path.getsize(unquote(f.removeprefix("file://"))) for f in read.inputFiles())
    monkeypatch.setattr(session, "PLACED_BYTES", size // 10)
    placed = placed_by(read, "id")
    assert 10 <= placed.rdd.getNumPartitions() <= 12 and placed.count() == 5000
    one_file = spark.read.parquet(unquote(read.inputFiles()[0]))
    assert given <= placed_by(one_file, "id").rdd.getNumPartitions() <= 5


def test_every_batch_of_arrivals_has_a_file_a_core(spark, monkeypatch):
    seen, plain = [], J.file_stream

    def noted(spark, folder, schema, glob="*.parquet", files_per_batch=None):
        seen.append((len(spark.read.parquet(folder).inputFiles()), files_per_batch))
        return plain(spark, folder, schema, glob, files_per_batch)

    monkeypatch.setattr(J, "file_stream", noted)
    QUERIES["t02_running_statistics"](spark, FOLDER)
    cores = spark.sparkContext.defaultParallelism
    assert seen == [(4 * cores, cores)]


@pytest.mark.parametrize("name", ["w30_noise_chain", "x12_words_with_offsets", "w31_mask_for_prediction"])
def test_rows_are_sorted_by_their_order_not_by_a_lambda(spark, name):
    assert "array_sort(" not in QUERIES[name](spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()


def test_scores_of_sequences_shuffle_texts_for_counts(spark):
    shown = re.sub(r"#\d+L?", "", plan(QUERIES["a27_sequence_score"](spark, FOLDER)))
    assert "hashpartitioning(doc_id, token" not in shown
