"""Benchmark the headline queries.

Runs each query at ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) on
``local[$BENCH_CPUS]`` (default 8); every result is fully computed through the
``noop`` sink.  Prints one JSON line:
{"metric": "total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}
"""

from __future__ import annotations

import json
import os
import re
import sys
import time

HEADLINE = [
    "discriminative_terms", "clean_text", "clean_stop_general", "clean_stem", "tokenize_words", "ngrams",
    "tfidf", "tfidf_sublinear", "tfidf_transform", "stratified_split", "stratified_kfold", "roc_auc",
    "roc_curve", "cv_summary", "duplicate_groups", "top_tokens_by_class", "length_describe",
    "fit_logreg", "predict_blind", "cv_auc",
]


def main() -> int:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    keys = sys.argv[1:] or HEADLINE
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from lexis.plans.registry import QUERIES, load_all
    from lexis.session import build_session

    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(8, cpus * 2))
    load_all()
    # warm the JVM once so the first query does not carry start-up cost
    spark.range(1000).selectExpr("sum(id)").collect()
    times = {}
    for k in keys:
        t0 = time.time()
        df = QUERIES[k](spark, sf_dir)
        df.write.format("noop").mode("overwrite").save()
        times[k] = round(time.time() - t0, 3)
        print(f"{k}: {times[k]}s", file=sys.stderr, flush=True)
    m = re.search(r"sf([0-9.]+)$", sf_dir)
    out = {"metric": "total_sec", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
           "sf": float(m.group(1)) if m else sf_dir, "cpus": cpus}
    print(json.dumps(out))
    spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main())
