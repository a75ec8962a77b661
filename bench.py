"""Time the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from fraudspark.plans.catalog import QUERIES  # noqa: E402
from fraudspark.session import build_session  # noqa: E402

HEADLINE = [
    "clean_transactions",
    "profile_numeric",
    "one_hot",
    "fraud_by_dimension",
    "kendall_amount_age",
    "kendall_matrix",
    "kmeans_labels",
    "silhouette_fixed_clusters",
    "iforest_scores",
    "iforest_sweep",
    "scored_transactions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.driver.memory": "12g",
            "spark.log.level": "ERROR",
            "spark.checkpoint.dir": os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"),
        },
    )
    QUERIES["label_totals"](spark, folder).collect()  # start the JVM and the workers
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
