"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1); BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import time

from tokenloom.plans import QUERIES
from tokenloom.session import local_session

HEADLINE = [
    "a01_corpus_statistics", "a02_token_counts", "a05_learn_merges", "a05_learn_100_merges", "a14_document_frequency", "a18_corpus_bleu",
    "a22_mean_rouge_l", "a23_mean_token_f1", "a24_weighted_mean", "a25_result_tally", "a27_sequence_score",
    "f13_dialect", "f17_has_text", "j02_positional_zip", "j04_vocabulary_lookup", "m02_pad_batch", "s16_shard_sink",
    "t01_incremental_ingest", "u03_multiset_union", "w02_train_valid_test", "w07_token_batches", "w13_stream_batches",
    "w14_vocabulary_ids", "w15_top_vocabulary", "w22_leaves_labels_spans", "w31_mask_for_prediction",
    "a06_apply_merges", "a07_vocabulary_constrained", "j06_subword_lookup", "w25_subword_children", "w27_merge_order",
    "x03_clean_comment", "x11_camel_code_parts", "x12_words_with_offsets", "x19_literal_tokens",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores)
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/documents.parquet").selectExpr("sum(length(text))").collect()  # start the JVM and codegen
    times = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({"metric": "headline query seconds", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/"))}))
    spark.stop()


if __name__ == "__main__":
    main()
