"""A whole run through files, from a delimited extract to the ledger."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from offerlens.contract import ModelSpec
from offerlens.operators import gates, profile
from offerlens.operators.gates import GateError, Watch
from offerlens.plans import stages as G
from offerlens.sources import files
from offerlens.sources.panel import staged_panel

SMALL = [ModelSpec("decision_tree", {"criterion": ("gini",), "max_depth": (3,), "min_samples_split": (2,)})]


@pytest.fixture(scope="module")
def run(spark, folder, tmp_path_factory):
    root = tmp_path_factory.mktemp("campaign")
    source = str(root / "extract.csv")
    files.write_delimited(staged_panel(spark, folder), source)
    path = str(root / "run")
    row = G.run_all(spark, source, path, str(root / "ledger"), SMALL, require_gate=False).first()
    return path, str(root / "ledger"), row


def report(spark, run, name):
    return spark.read.option("header", True).csv(f"{run}/{name}")


def test_every_artifact_is_there(spark, run):
    path, _, _ = run
    assert spark.read.parquet(f"{path}/raw").count() == 1350
    assert report(spark, path, "describe_report").count() == 22
    assert report(spark, path, "null_report").first()["column"] == "Uso_Linea"
    record = json.loads(spark.read.text(f"{path}/training_record").first()[0])["record"]
    sizes = json.loads(record)["class_distribution"]
    assert sizes["train/0"] + sizes["test/0"] == sizes["total/0"]
    summary = json.loads(spark.read.text(f"{path}/validation_summary").first()[0])
    assert summary["rows"] == 1350 and summary["columns"] == 22
    assert spark.read.parquet(f"{path}/scored").count() == 405


def test_metrics_of_both_stages_are_merged(spark, run):
    path, _, _ = run
    metrics = {r["metric"]: r["value"] for r in G.metrics(spark, path).collect()}
    assert metrics["best_model"] == "decision_tree" and metrics["n_test"] == "405"
    assert set(metrics) >= {"accuracy", "roc_auc", "cv_best_score", "threshold", "n_train", "model_type"}


def test_gate_holds_back_a_weak_model(spark, run):
    path, ledger, _ = run
    assert not G.gate(spark, path)
    with pytest.raises(GateError):
        G.register(spark, path, ledger)


def test_ledger_has_the_run_and_counts_versions(spark, run):
    path, ledger, row = run
    assert row["version"] == 1 and row["best_model"] == "decision_tree"
    again = G.register(spark, path, ledger, require_gate=False).first()
    assert again["version"] == 2
    params = {r["param"]: r["value"] for r in spark.read.parquet(f"{ledger}/params").where(F.col("run_id") == row["run_id"]).collect()}
    assert set(params) >= {"target", "param_max_depth", "selection_metric"}
    assert (params["rows"], params["models_trained"]) == ("1350", "decision_tree") and int(params["columns"]) > 20
    assert spark.read.parquet(f"{ledger}/examples").where(F.col("run_id") == row["run_id"]).count() == 5
    assert spark.read.parquet(f"{ledger}/signatures").where(F.col("run_id") == row["run_id"]).count() == 1
    names = {r["name"] for r in spark.read.parquet(f"{ledger}/artifacts").collect()}
    assert names >= {"metrics", "feature_importance", "split"}


def test_registrations_at_once_get_versions_of_their_own(spark, run):
    path, ledger, _ = run
    before = spark.read.parquet(f"{ledger}/runs").agg(F.max("version")).first()[0]
    with ThreadPoolExecutor(2) as pool:
        rows = list(pool.map(lambda _: G.register(spark, path, ledger, require_gate=False).first(), range(2)))
    assert sorted(r["version"] for r in rows) == [before + 1, before + 2]
    versions = [r["version"] for r in spark.read.parquet(f"{ledger}/runs").select("version").collect()]
    assert len(versions) == len(set(versions))


def test_metrics_of_several_writers_are_all_kept(spark, tmp_path):
    def upsert(i):
        G._upsert(spark, str(tmp_path), spark.createDataFrame([(f"m{i}", str(i)), ("last", str(i))], G.METRIC_SHAPE))

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(upsert, range(4)))
    assert {r["metric"] for r in G.metrics(spark, str(tmp_path)).collect()} == {"m0", "m1", "m2", "m3", "last"}
    files.create_if_absent(spark, f"{tmp_path}/metric_claims/4")  # a writer that failed
    G._upsert(spark, str(tmp_path), spark.createDataFrame([("late", "1")], G.METRIC_SHAPE), patience=0.5)
    assert G.metrics(spark, str(tmp_path)).count() == 6


def test_gates_need_no_second_read(spark, run, tmp_path):
    """Facts of a watched write equal those of the gates that read the table."""
    path, _, _ = run
    raw = spark.newSession().read.parquet(f"{path}/raw")
    watch = Watch(raw, "FLAG_VENTA", negatives=["Ahorro_Sldo_Bco_T1", "absent"])
    watch.df.write.parquet(str(tmp_path / "t"))
    assert watch.final_gate().collect() == gates.final_gate(raw).collect()
    assert watch.label_gate().collect() == gates.label_gate(raw).collect()
    assert watch.negative_counts().collect() == profile.negative_counts(raw, ["Ahorro_Sldo_Bco_T1"]).collect()
    assert watch.rows() == 1350
    with pytest.raises(GateError):
        Watch(raw, "absent")


def test_fitting_on_train_rows_only(spark, run, tmp_path):
    path, _, _ = run
    other = str(tmp_path / "run")
    spark.read.parquet(f"{path}/raw").write.parquet(f"{other}/raw")
    split = G.build_features(spark, other, fit_on="train")
    assert {r["split"]: r["count"] for r in split.groupBy("split").count().collect()} == {"train": 945, "test": 405}
    means = [G.load_feature_builder(p).fitted()["uniform"]["Meses_oferta"]["mean"] for p in (path, other)]
    assert means[0] != means[1]


def test_stages_name_what_has_to_run_first(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="ingest stage"):
        G.validate(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError, match="train and evaluate"):
        G.metrics(spark, str(tmp_path))
    with pytest.raises(FileNotFoundError):
        G.ingest(spark, str(tmp_path / "absent.csv"), str(tmp_path))
