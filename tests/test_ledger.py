from concurrent.futures import ThreadPoolExecutor

from offerlens.operators import ledger as L
from offerlens.sources import files
from pyspark.sql import functions as F


def test_only_listed_numbers_are_metrics(spark):
    rows = [("accuracy", "0.9"), ("recall", "high"), ("n_test", "12"), ("other", "1"), ("f1", "true"), ("roc_auc", None)]
    table = spark.createDataFrame(rows, "metric string, value string")
    assert {tuple(r) for r in L.ledger_metrics(table).collect()} == {("accuracy", 0.9), ("n_test", 12.0)}


def test_parameters_are_flat_and_complete(spark):
    runs = spark.range(1).select(
        F.lit("RandomForest").alias("model_type"), F.lit(42).alias("random_state"), F.lit(87556).alias("rows"),
        F.array(F.lit("decision_tree"), F.lit("random_forest")).alias("models_trained"),
        F.create_map(F.lit("max_depth"), F.lit("10")).alias("params"))
    params = {r["param"]: r["value"] for r in L.ledger_params(runs).collect()}
    assert params == {
        "target": "FLAG_VENTA", "best_model": "RandomForest", "model_type": "RandomForest", "selection_metric": "unknown",
        "random_state": "42", "test_size": "unknown", "rows": "87556", "columns": "unknown", "n_features": "unknown",
        "models_trained": "decision_tree,random_forest", "param_max_depth": "10",
    }
    bare = {r["param"] for r in L.ledger_params(spark.range(1)).collect()}
    assert bare == {"target", "best_model", "model_type", "selection_metric", "random_state", "test_size"}


def test_versions_grow_per_name(spark, tmp_path):
    metrics = spark.createDataFrame([("accuracy", "0.85"), ("f1", "0.77")], "metric string, value string")
    path, ledger = str(tmp_path / "runs"), None
    for run, name in (("r1", "a"), ("r2", "a"), ("r3", "b"), ("r4", "a")):
        L.append_run(L.run_row(metrics, run, ledger, name), path)
        ledger = spark.read.parquet(path)
    assert {r["run_id"]: r["version"] for r in ledger.collect()} == {"r1": 1, "r2": 2, "r3": 1, "r4": 3}
    row = ledger.where("run_id = 'r4'").first()
    assert row["metrics"]["accuracy"] == 0.85 and row["metrics"]["recall"] is None
    numbered = L.model_versions(ledger.drop("version"))
    assert {r["run_id"]: r["version"] for r in numbered.collect()} == {"r1": 1, "r2": 2, "r3": 1, "r4": 3}


def test_versions_claimed_at_once_differ(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        claimed = list(pool.map(lambda _: L.claim_version(spark, str(tmp_path / "claims"), "a b/c"), range(24)))
    assert sorted(claimed) == list(range(1, 25))
    assert L.claim_version(spark, str(tmp_path / "claims"), "a b/c", known=40) == 41
    assert L.claim_version(spark, str(tmp_path / "claims"), "other") == 1


def test_only_one_writer_creates_a_file(spark, tmp_path):
    with ThreadPoolExecutor(8) as pool:
        told = list(pool.map(lambda _: files.create_if_absent(spark, f"{tmp_path}/deep/er/claim"), range(32)))
    assert told.count(True) == 1
