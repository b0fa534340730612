"""Benchmark: the headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints one JSON line. ``queries`` holds the median of three runs, ``cold`` the first of them. Results
are computed in full and thrown away (noop sink). Name queries as arguments to time those instead;
``all`` stands for every query but the model training, ``training`` for that, which runs once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import pyspark

from wardmill import catalog
from wardmill.session import local_session

TRAINING = ["ml_train_rf", "ml_train_gbt"]
PREFIXES = ("v_", "mv_", "q0", "q1", "q2", "clean_", "ri_", "dq_summary")
HEADLINE = [n for n in catalog.BUILDERS if n.startswith(PREFIXES)] + [
    "load_dedup", "constraint_report", "sheet_kpi_cards", "dax_mtd", "dax_rolling_3m", "dax_doctor_rank",
    "viz_noshow_heatmap", "viz_revenue_drill", "ml_features", "ml_metrics", "fuzzy_doctor_name",
]
SETS = {"all": [n for n in catalog.BUILDERS if n not in TRAINING], "training": TRAINING}


def timed(query, spark, root: str) -> float:
    start = time.perf_counter()
    query(spark, root).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    root = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE", "8")))
    queries = catalog.queries()
    wanted = [n for a in sys.argv[1:] for n in SETS.get(a, [a])] or HEADLINE
    timed(queries["v_monthly_kpis"], spark, root)  # start the JVM's compilers; not counted
    cold, median = {}, {}
    for name in wanted:
        runs = [timed(queries[name], spark, root) for _ in range(1 if name in TRAINING else 3)]
        cold[name], median[name] = runs[0], statistics.median(runs)
    print(
        json.dumps(
            {
                "metric": "total_query_seconds",
                "value": round(sum(median.values()), 3),
                "unit": "sec",
                "queries": median,
                "cold": cold,
                "sf": os.path.basename(root.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": pyspark.__version__,
            }
        )
    )


if __name__ == "__main__":
    main()
