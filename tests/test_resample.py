"""The resampling estimator in a pipeline, in a cross-validation, and after saving and loading."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LogisticRegression
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from offerlens.plans import resample as R
from offerlens.plans.resample import ResampledClassifier


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(11)
    rows = [(f"k{i}", int(i % 9 == 0), *rng.normal(1.5 * (i % 9 == 0), 1, 2).tolist()) for i in range(540)]
    return spark.createDataFrame(rows, "id string, y int, a double, b double").cache()


def assembler():
    return VectorAssembler(inputCols=["a", "b"], outputCol="v")


def test_rows_inside_the_fit(table):
    inner = LogisticRegression(featuresCol="v", labelCol="y", weightCol="w")
    rows = ResampledClassifier(estimator=inner, keyCol="id", ratio=0.5, neighbours=3).resampled(assembler().transform(table))
    seen = {r["y"]: (r["n"], r["w"]) for r in rows.groupBy("y").agg(F.count("*").alias("n"), F.sum("w").alias("w")).collect()}
    assert {k: n for k, (n, _) in seen.items()} == {0.0: 480, 1.0: 240}
    assert seen[0.0][1] == pytest.approx(seen[1.0][1]) == pytest.approx(360)


def test_in_a_pipeline_it_leaves_the_inner_model(table, tmp_path):
    pipeline = Pipeline(stages=[assembler(), ResampledClassifier(estimator=LogisticRegression(featuresCol="v", labelCol="y"), keyCol="id")])
    pipeline.write().overwrite().save(str(tmp_path / "p"))
    again = Pipeline.load(str(tmp_path / "p"))
    loaded = again.getStages()[1]
    assert isinstance(loaded, ResampledClassifier) and loaded.getOrDefault("keyCol") == "id" and loaded.uid == pipeline.getStages()[1].uid
    assert loaded.getEstimator().getFeaturesCol() == "v"
    model, other = pipeline.fit(table), again.fit(table)
    assert type(model.stages[1]).__name__ == "LogisticRegressionModel"
    assert model.stages[1].coefficients == other.stages[1].coefficients
    model.write().overwrite().save(str(tmp_path / "m"))
    scored = PipelineModel.load(str(tmp_path / "m")).transform(table)
    assert scored.count() == 540  # rows to score are not resampled


def test_cross_validation_resamples_once_per_fold(table, monkeypatch):
    calls = []
    rows = R.training_rows
    monkeypatch.setattr(R, "training_rows", lambda *a: calls.append(a[1:]) or rows(*a))
    tree = DecisionTreeClassifier(featuresCol="v", labelCol="y", seed=1)
    sampled = ResampledClassifier(estimator=tree, keyCol="id")
    grid = ParamGridBuilder().addGrid(tree.maxDepth, [1, 4]).build()
    search = CrossValidator(estimator=sampled, estimatorParamMaps=grid, evaluator=BinaryClassificationEvaluator(labelCol="y"), numFolds=3, seed=2)
    fitted = search.fit(assembler().transform(table))
    assert len(calls) == 3 + 1  # folds, and the refit of the winner
    assert fitted.bestModel.getMaxDepth() in (1, 4) and min(fitted.avgMetrics) > 0.6 and len(set(fitted.avgMetrics)) == 2
    calls.clear()
    both = ParamGridBuilder().addGrid(sampled.ratio, [0.2, 0.6]).addGrid(tree.maxDepth, [2, 3]).build()
    models = dict(sampled.fitMultiple(assembler().transform(table), both))
    assert sorted(models) == [0, 1, 2, 3] and {m.getMaxDepth() for m in models.values()} == {2, 3}
    assert sorted(c[0] for c in calls) == [0.2, 0.6]


def test_copies_are_apart(table):
    tree = DecisionTreeClassifier(featuresCol="v", labelCol="y")
    one = ResampledClassifier(estimator=tree, keyCol="id")
    two = one.copy({one.ratio: 0.7, tree.maxDepth: 9})
    assert (one.getOrDefault("ratio"), two.getOrDefault("ratio")) == (0.3, 0.7)
    assert (tree.getMaxDepth(), one.getEstimator().getMaxDepth(), two.getEstimator().getMaxDepth()) == (5, 5, 9)


def test_arrays_do_as_features(table):
    frame = table.select("id", "y", F.array("a", "b").alias("v"))
    rows = ResampledClassifier(estimator=LogisticRegression(featuresCol="v", labelCol="y"), keyCol="id").resampled(frame)
    assert rows.columns == ["y", "v"] and rows.count() == 480 + 144
