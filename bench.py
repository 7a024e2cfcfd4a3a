"""Headline queries, timed.  Prints one JSON line.

BENCH_SF_DIR: directory of the tables; BENCH_CPUS: local cores.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "contingency", "coverage_matrix", "rule_match", "predict_class", "regression_contingency", "binned_candidates",
    "numeric_candidates", "best_condition", "measures_all", "kaplan_meier", "log_rank", "predict_survival",
    "integrated_brier_score", "rule_stats", "prune_rule", "grow_rule", "learn_classification", "learn_regression",
    "learn_survival", "contrast_sets",
]


def main() -> None:
    from pyspark.sql import SparkSession

    from premisa.catalog import QUERIES

    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["contingency"](spark, SF_DIR).write.format("noop").mode("overwrite").save()  # start-up is not timed
    times = {}
    # A whole fit on 150 rows, as published figures give it: three classes, four numeric columns.
    from premisa import RuleClassifier
    from premisa.catalog.tasks import cls

    few = cls(spark, SF_DIR).orderBy("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber").limit(150).cache()
    few.count()
    columns = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    for name, measure in (("fit_150_rows", "Correlation"), ("fit_150_rows_full_coverage", "FullCoverage")):
        began = time.monotonic()
        RuleClassifier(
            induction_measure=measure, pruning_measure=measure, voting_measure=measure, max_rule_count=3
        ).fit(few, label="y", features=columns)
        times[name] = round(time.monotonic() - began, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    for name in HEADLINE:
        began = time.monotonic()
        QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
        times[name] = round(time.monotonic() - began, 3)
        print(name, times[name], file=sys.stderr, flush=True)
    print(
        json.dumps(
            {
                "metric": "headline_total",
                "value": round(sum(times[name] for name in HEADLINE), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
