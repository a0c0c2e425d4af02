"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs to completion through the ``noop`` sink (the whole plan executes, nothing is collected).
Before timing, the flagship query runs once on the smallest scale (sf0.001): it warms the JVM (class loading,
JIT of the tree learner, codegen) the way a long-lived cluster session is warm; no data of the timed scale is
cached by it.
"""

from __future__ import annotations

import json
import os
import sys
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)

HEADLINE = (
    "featurize",
    "features_job",
    "training_join",
    "stratified_split",
    "median_impute",
    "binary_metrics",
    "roc_auc",
    "apply_promotion",
    "train_score",
    "train_job",
)
# Scoring with a model that is already promoted: the daily job. Training happens before its timing starts.
DAILY_SCORING = "daily_scoring"
# The forest is timed on the quality label (as in earlier rounds), which it cannot learn exactly: deep trees.
FLAGSHIP = "train_score"


def daily_scoring(spark, sf_dir):
    """The scoring job over existing tables and an already promoted model; returns the part to time."""
    from scorebook.config import InferenceConfig
    from scorebook.plans import queries as Q
    from scorebook.plans.pipelines import batch_inference, train
    from scorebook.session import scratch_path, unique_name
    from scorebook.sources.tables import read_table

    cfg, registry = Q._doc_tables(spark, sf_dir), Q._registry(spark)
    train(spark, cfg, registry)
    out = f"{unique_name('bench')}.predictions"
    job = InferenceConfig(cfg.model_name, cfg.labels_table.name, cfg.feature_table.name, Q.DOC_KEY, out,
                          output_location=scratch_path(spark, "bench-predictions"))
    return lambda s, _: read_table(s, batch_inference(s, job, registry))


def main() -> None:
    from scorebook.session import local_session
    from scorebook.plans.queries import QUERIES, flagship

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or [*HEADLINE, DAILY_SCORING]
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, app="scorebook-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # Warm-up outside the timings, on the smallest scale only.
    warm_dir = os.path.join(os.path.dirname(sf_dir), "sf0.001")
    if not os.path.isdir(warm_dir):
        warm_dir = sf_dir
    flagship(spark, warm_dir).write.format("noop").mode("overwrite").save()

    timings = {}
    for name in names:
        query = daily_scoring(spark, sf_dir) if name == DAILY_SCORING else flagship if name == FLAGSHIP else QUERIES[name]
        t0 = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf}))


if __name__ == "__main__":
    main()
