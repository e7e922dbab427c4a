"""Times the headline queries; prints one JSON line.

A light query warms the session up; then each query runs ``BENCH_RUNS`` times
(once by default) and the median counts. The whole result is computed and thrown
away.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from codecorpus.plans import catalog  # noqa: E402
from codecorpus.session import local_session  # noqa: E402

HEADLINE = [
    "nonblank_lines", "code_tokens", "clean_reject_reason", "dedup_exact", "append_new_anti", "cap_after_clean",
    "collection_counters", "repo_url_lookup", "extract_functions", "find_statements", "mask_drop", "mask_keep",
    "split_exact", "mask_tokens", "validate_pretrain", "word_frequencies", "pair_counts", "learn_merges",
    "encode_decode", "prepare_pairs", "statement_model", "predict_topk", "token_perplexity", "similarity",
    "evaluation_metrics", "benchmark", "worst_best_topk", "score_histogram", "csv_round_trip",
]


def timed(query, spark, folder: str) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench", memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    timed(catalog.QUERIES["map_batches"], spark, folder)
    seconds = {}
    for name in names:
        query = catalog.QUERIES[name]
        seconds[name] = round(statistics.median(timed(query, spark, folder) for _ in range(runs)), 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    spark.stop()
    print(json.dumps(line), flush=True)


if __name__ == "__main__":
    main()
