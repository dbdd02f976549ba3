"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS set the data and the number of task slots.  Every
query's rows are written to the no-op sink, so all columns are computed.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tidewater.plans import PLANS  # noqa: E402
from tidewater.session import local_session  # noqa: E402

HEADLINE = [
    "economy_by_nation", "join_chain", "join_merge", "align_years", "word_count", "hourly_distinct", "pivot_wide",
    "running_score", "line_runs", "affine_index_join", "split_stratified", "extract_links", "link_adjacency",
    "tokenize_words", "bow_presence", "nb_presence", "gnb_predict", "gnb_rounds", "mixed_nb", "eval_weighted_prf",
    "join_contains", "fuzzy_join_distance", "fuzzy_join_ratio", "pr_curve", "knn_exact", "knn_classify", "dbscan",
    "snn_cluster", "kmeans", "histogram_bins", "src_tsv_typed", "stream_running_score",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    only = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8, name="bench")
    PLANS["group_size"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the workers
    took = {}
    for key in only:
        begin = time.perf_counter()
        PLANS[key](spark, sf_dir).write.format("noop").mode("overwrite").save()
        took[key] = round(time.perf_counter() - begin, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries",
                "value": round(sum(took.values()), 3),
                "unit": "sec",
                "queries": took,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
