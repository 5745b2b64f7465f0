"""Headline-query benchmark.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=8 python bench.py

Runs each headline query to completion (a full write to the no-op sink, so
every row is computed without collecting it), median of BENCH_RUNS runs,
and prints ONE JSON line.  ``value`` is the sum of the per-query medians.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from rankfold.plans.registry import QUERIES, load_all  # noqa: E402
from rankfold.session import get_spark  # noqa: E402

HEADLINE = [
    "explode_label", "join_articles", "rank_list", "submission", "hist_features_joined",
    "user_lag_lead", "article_lag_lead", "rolling_global_3", "counts_user_clock",
    "pivot_clock_stats", "pivot_median", "freq_encode", "encode_sequence", "user_sequences",
    "sample_table", "auc", "gauc", "ndcg_5", "blend_norm", "avg_pool", "dot_topk",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    scratch = tempfile.mkdtemp(prefix="rankfold-bench-")
    spark = get_spark(f"local[{cpus}]", app="rankfold-bench", shuffle_partitions=cpus * 2, conf={
        "spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "16g"),
        "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": scratch,
        "spark.sql.files.maxPartitionBytes": str(64 * 1024 * 1024),
    })
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(os.path.join(scratch, "ckpt"))
    load_all()
    times: dict[str, float] = {}
    for name in names:
        samples = []
        for _ in range(runs):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "headline_queries_total_median", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": cpus, "runs": runs}))
    spark.stop()


if __name__ == "__main__":
    main()
