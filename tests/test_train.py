import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from offerlens.contract import BOOSTED_SPEC, MODEL_SPECS, ModelSpec
from offerlens.operators import evaluate as E
from offerlens.operators.gates import GateError
from offerlens.operators.oversample import as_points
from offerlens.operators.split import stratified_split
from offerlens.plans import rows
from offerlens.plans import train as T
from offerlens.session import stage

SMALL = [ModelSpec("decision_tree", {"criterion": ("gini",), "max_depth": (2, None), "min_samples_split": (10,)}),
         ModelSpec("random_forest", {"max_depth": (3,), "min_samples_split": (5,), "n_estimators": (5,)})]


@pytest.fixture(scope="module")
def split(spark):
    """A rare label that follows the first feature."""
    rng = np.random.default_rng(7)
    rows = []
    for i in range(900):
        y = int(rng.random() < 0.1)
        rows.append((i % 9, i, y, float(rng.normal(2 * y)), float(rng.normal()), int(rng.integers(0, 2))))
    table = spark.createDataFrame(rows, "MES int, CLIENTE int, FLAG_VENTA int, a double, `b c` double, d int")
    return stage(stratified_split(table, ["MES", "CLIENTE"]), "test-split")


@pytest.fixture(scope="module")
def done(split):
    return T.train(split, specs=SMALL)


def test_grids():
    sets = T.parameter_sets(MODEL_SPECS)
    assert len(sets) == 20 and [name for name, _ in sets].count("decision_tree") == 16
    assert sets[0][1] == {"criterion": "gini", "max_depth": 4, "min_samples_split": 2}
    assert len(T.parameter_sets([BOOSTED_SPEC])) == 8


def test_estimators(spark):
    tree = T.make_estimator("decision_tree", {"criterion": "entropy", "max_depth": None, "min_samples_split": 10})
    assert (tree.getMaxDepth(), tree.getMinInstancesPerNode(), tree.getImpurity()) == (30, 5, "entropy")
    forest = T.make_estimator("random_forest", {"n_estimators": 200, "max_depth": 10, "min_samples_split": 5})
    assert (forest.getNumTrees(), forest.getFeatureSubsetStrategy(), forest.getWeightCol()) == (200, "sqrt", "weight")
    boosted = T.make_estimator("boosted_trees", T.parameter_sets([BOOSTED_SPEC])[0][1])
    assert (boosted.getMaxIter(), boosted.getSubsamplingRate()) == (200, 0.8)
    with pytest.raises(ValueError):
        T.make_estimator("other", {})


def test_shallow_boosted_trees_keep_no_nodes(spark):
    kept = {name: T.make_estimator(name, params).getCacheNodeIds() for name, params in T.parameter_sets([*MODEL_SPECS, BOOSTED_SPEC])}
    assert kept == {"decision_tree": True, "random_forest": True, "boosted_trees": False}


def test_parts_grow_with_rows_only_when_they_are_full():
    """Every part sends the statistics of all nodes, so more rows first fill the parts."""
    assert [rows.partitions(n) for n in (0, 20_000, 20_001, 114_000)] == [1, 1, 2, 6]
    assert [rows.partitions(n) for n in (650_000, 1_500_000, 1_500_001, 7_000_000, 42_000_000)] == [6, 6, 7, 28, 168]


def test_rows_of_a_fit_are_made_once(split):
    points = as_points(split.where("split = 'train'"), ["MES", "CLIENTE"], T.feature_names(split), "FLAG_VENTA")
    table, seen = T.training_rows(stage(points, "points")), []

    class Inner:
        def fit(self, given):
            seen.append(given.storageLevel.useMemory)
            return "model"

    assert rows.fit_kept(Inner(), table) == "model"
    assert seen == [True] and not table.storageLevel.useMemory


def test_training_rows_are_balanced_by_weight(split):
    points = as_points(split.where("split = 'train'"), ["MES", "CLIENTE"], T.feature_names(split), "FLAG_VENTA")
    rows = T.training_rows(stage(points, "points"))
    sums = {r["label"]: (r["n"], r["w"]) for r in rows.groupBy("label").agg(F.count("*").alias("n"), F.sum("weight").alias("w")).collect()}
    assert sums[1.0][0] == int(0.3 * sums[0.0][0])
    assert sums[0.0][1] == pytest.approx(sums[1.0][1])


def test_search_has_every_fold_split_and_metric(done):
    assert done.search.results.count() == 3 * 3 * 2 * 4
    table = T.cv_table(done.search).orderBy("position").collect()
    assert [r["position"] for r in table] == [0, 1, 2]
    for r in table:
        folds = [r[f"split{f}_test_roc_auc"] for f in range(3)]
        assert r["mean_test_roc_auc"] == pytest.approx(np.mean(folds))
        assert r["std_test_roc_auc"] == pytest.approx(np.std(folds))
    deep = table[1]
    assert deep["mean_train_roc_auc"] > deep["mean_test_roc_auc"]
    assert {r["rank_test_f1"] for r in table if r["model_name"] == "random_forest"} == {1}


def test_winner_has_the_best_mean(done):
    means = {r["model_name"]: r["best_cv_score"] for r in done.search.best_by_family().collect()}
    assert done.cv_score == max(means.values()) and means[done.family] == done.cv_score


def test_model_learns_and_survives_saving(done, split, tmp_path):
    test = split.where("split = 'test'")
    scored = T.score_checked(done.model, test)
    done.model.write().overwrite().save(str(tmp_path / "m"))
    again = T.score_checked(PipelineModel.load(str(tmp_path / "m")), test)
    assert again.orderBy("CLIENTE").collect() == scored.orderBy("CLIENTE").collect()
    assert scored.where(~F.col("probability").between(0, 1)).isEmpty()
    auc = E.roc_auc(scored.select(F.col("FLAG_VENTA").alias("label"), F.col("probability").alias("score"))).first()[0]
    assert auc > 0.75
    top = T.feature_importance(done.model, T.feature_names(split)).first()
    assert top["feature"] == "a"


def test_scoring_contract(done, split):
    with pytest.raises(GateError, match="no_missing_features: a"):
        T.score_checked(done.model, split.drop("a"))
    with pytest.raises(GateError, match="no_extra_features: z"):
        T.score_checked(done.model, split.withColumn("z", F.lit(1)))


def test_signature(done):
    signature = T.model_signature(done.model, done.family)
    assert signature["inputs"] == ["MES", "a", "b c", "d"] and signature["n_features"] == 4
    assert T.model_type(done.model).endswith("ClassificationModel")


def test_models_without_probability_give_a_sigmoid(split):
    data = VectorAssembler(inputCols=["a", "d"], outputCol="x").transform(split)
    svm = LinearSVC(featuresCol="x", labelCol="FLAG_VENTA", maxIter=5).fit(data)
    scored = T.score(svm, data)
    assert scored.where(~F.col("probability").between(0, 1)).isEmpty()
    assert scored.select("probability").distinct().count() > 100
    assert T.feature_importance(svm, ["a", "d"]).isEmpty()


def test_the_longest_fits_of_all_folds_begin_first(spark, monkeypatch):
    rows = [(f"k{i}", int(i % 6 == 0), [float(i % 7), float(i % 6 == 0) + i % 3]) for i in range(120)]
    points = spark.createDataFrame(rows, "key string, label int, features array<double>")
    specs = [ModelSpec("decision_tree", {"criterion": ("gini",), "max_depth": (2,)}),
             ModelSpec("random_forest", {"max_depth": (2, 3), "n_estimators": (3,)})]
    begun = []
    make = T.make_estimator
    monkeypatch.setattr(T, "make_estimator", lambda family, params, seed: begun.append((family, params["max_depth"])) or make(family, params, seed))
    search = T.grid_search(points, specs, folds=2, parallelism=1)
    assert begun == [("random_forest", 3)] * 2 + [("random_forest", 2)] * 2 + [("decision_tree", 2)] * 2
    assert search.results.select("position", "model_name", "params", "fold").distinct().count() == 6
    assert {(r["position"], r["model_name"]) for r in search.results.collect()} == {(0, "decision_tree"), (1, "random_forest"), (2, "random_forest")}
