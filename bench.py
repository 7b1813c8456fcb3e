"""Time the headline queries and print one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from offerlens.queries import QUERIES  # noqa: E402
from offerlens.session import local_session  # noqa: E402
from offerlens.sources.panel import staged_panel  # noqa: E402

# The panel comes first: the other queries read it as the stage before them left it.
HEADLINE = (
    "target_distribution", "null_report", "duplicate_rows", "describe_all", "validation_summary",
    "csv_scan", "csv_inferred_types", "content_fingerprint", "log1p_features", "impute_stats", "impute_all", "one_hot",
    "feature_table", "stratified_split", "stratified_folds", "smote_neighbours", "smote_rows",
    "binary_metrics", "monthly_metrics", "roc_curve", "classification_report", "score_histogram",
    "cv_summary", "train_tree", "score_batch", "train_forest", "ledger_params",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()  # start the JVM's executor before the clock
    seconds = {}
    started = time.time()
    staged_panel(spark, folder)
    seconds["panel"] = round(time.time() - started, 3)
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        started = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - started, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds,
                      "sf": Path(folder).name.removeprefix("sf")}))


if __name__ == "__main__":
    main()
