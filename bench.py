"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query is executed in full into Spark's ``noop`` sink (no collection to
the driver): one warm-up run, then the median of $BENCH_REPS timed runs.
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from kiln.session import checkpoint_root, get_session  # noqa: E402
from kiln.plans import all_queries  # noqa: E402

HEADLINE = [
    "t4_best_sellers", "t5_top_rate", "t6_first_in_cart", "t7_loyal_users",
    "g9_multi_group", "g10_hierarchy", "g16_monthly_trend", "u3_visit_cohorts",
    "j3_natural_left_join", "w2_share_within", "w6_fraction_split",
    "p4_skim", "p5_histograms", "p7_corr_matrix",
    "f7_factor", "f22_dummies",
    "r1_baskets", "r5_rules", "r10_prune_rules",
    "q2_vocab", "q5_lane_batches", "q7_bigram_perplexity",
    "g13_vector_sum", "q8_affine", "m12_evaluate",
]


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    reps = int(os.environ.get("BENCH_REPS", "3"))
    only = [q for q in os.environ.get("BENCH_QUERIES", "").split(",") if q]
    spark = get_session(f"local[{cpus}]", shuffle_partitions=int(cpus) * 2, app="kiln-bench")
    checkpoint_root(spark)  # the cluster's spark.checkpoint.dir, else a local temporary folder
    qs = all_queries()
    names = only or HEADLINE
    times = {}
    for name in names:
        fn = qs[name]
        runs = []
        for i in range(reps + 1):
            t0 = time.perf_counter()
            fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
            if i > 0:
                runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    sf_txt = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    try:
        sf = float(sf_txt)
    except ValueError:
        sf = sf_txt
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": sf, "cpus": int(cpus), "reps": reps}))


if __name__ == "__main__":
    main()
