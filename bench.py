"""Benchmark: the headline queries end to end at $BENCH_SF_DIR on
local[$BENCH_CPUS]; prints one JSON line.

Queries run in pipeline order on one session, so each timing is the work that
query adds: ``dictionary_topk`` fits the dictionary, ``tf_train`` builds the
TF rows, ``gd_history`` runs gradient descent, the ``*_metrics`` queries
build vectors and fit / evaluate one Spark ML model each. Every result is
forced with the ``noop`` sink, so nothing is collected to the driver.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "word_count",
    "dictionary_topk",
    "tf_train",
    "tf_test",
    "token_pairs",
    "feature_stats",
    "variance_topm",
    "tf_reduced_train",
    "gd_history",
    "gd_confusion",
    "class_metrics_gd",
    "lr_full_metrics",
    "svm_full_metrics",
    "lr_reduced_metrics",
    "svm_reduced_metrics",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    from termflow.plans.catalog import QUERIES
    from termflow.session import build_session

    t0 = time.perf_counter()
    spark = build_session(f"local[{cpus}]", shuffle_partitions=max(8, cpus))
    startup = time.perf_counter() - t0

    # JVM / code-generation warm-up on a tiny job over the same table, reported
    # separately so the first headline query is not charged for it.
    t0 = time.perf_counter()
    spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").limit(10).collect()
    warmup = time.perf_counter() - t0

    timings: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
        print(f"# {name}: {timings[name]}s", file=sys.stderr, flush=True)

    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({
        "metric": "headline_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
        "startup_sec": round(startup, 3),
        "warmup_sec": round(warmup, 3),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
