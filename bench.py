"""Time the headline queries warm and print one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` choose the data and the cores, ``BENCH_RUNS`` the timed
runs per query (the median counts).
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayscope import workload  # noqa: E402
from stayscope.operators.cohort import build_cohort  # noqa: E402
from stayscope.workload import roles  # noqa: E402

HEADLINE = """
    flagship latest_episode cohort_build cohort_grid asof_events diag_counts med_counts lab_means
    med_counts_grid lab_means_grid latest_scores unpivot_scores unpivot_flags feature_dictionary
    feature_indexing feature_matrix feature_store libsvm_roundtrip feature_stddev scaled_features
    auc roc_curve clean_text term_counts vocabulary note_vectors concat_notes load_lab_events
    load_notes join_quoted_lines lr_scores
""".split()
#: Long training runs, timed once and cold.
LONG = "svm_scores cv_grid note_topics".split()


def twelve_cohorts(spark, sf_dir):
    """The cohort grid built cohort by cohort, for comparison with ``cohort_grid``."""
    people, stays = roles.entities(spark, sf_dir), roles.episodes(spark, sf_dir)
    merged = None
    for c in roles.SPECS:
        one = build_cohort(people, stays, c.outcome, c.hours)
        merged = one if merged is None else merged.unionByName(one)
    return merged


def timed(run, spark, sf_dir) -> float:
    started = time.perf_counter()
    run(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cores)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Call-site capture costs milliseconds per column expression while a plan is built.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    wanted = sys.argv[1:] or HEADLINE + LONG
    seconds = {}
    for name in wanted:
        run = workload.QUERIES[name]
        if name in LONG:
            seconds[name] = round(timed(run, spark, sf_dir), 3)
            continue
        timed(run, spark, sf_dir)
        seconds[name] = round(statistics.median(timed(run, spark, sf_dir) for _ in range(runs)), 3)
    if "cohort_grid" in wanted:
        timed(twelve_cohorts, spark, sf_dir)
        seconds["twelve_cohorts"] = round(timed(twelve_cohorts, spark, sf_dir), 3)
    total = round(sum(seconds[n] for n in wanted), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
