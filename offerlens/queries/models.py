"""Registered queries: fitted models. These are checked by properties, as SQL has no trees."""

from __future__ import annotations

import json

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.contract import BOOSTED_SPEC, CUSTOMER, MODEL_SPECS, MONTH, TARGET, THRESHOLD
from offerlens.functions.scalars import classify, col
from offerlens.operators import evaluate as E
from offerlens.operators import gates as G
from offerlens.operators.oversample import as_points
from offerlens.operators.split import split_distribution
from offerlens.plans import reports as R
from offerlens.plans import train as T
from offerlens.plans.resample import ResampledClassifier
from offerlens.plans.rows import fit_kept
from offerlens.queries.features import ALL_LOGGED, FEATURE_CTE, FEATURES
from offerlens.queries.inputs import KEY, feature_split, once, rounded
from offerlens.queries.panel_sql import over_panel
from offerlens.queries.sampling import GROWN, SPLIT_CTES
from offerlens.session import new_path, stage

TREE = ("decision_tree", {"criterion": "entropy", "max_depth": 6, "min_samples_split": 2})
FOREST = ("random_forest", {"max_depth": 10, "min_samples_split": 5, "n_estimators": 200})
BOOSTED = T.parameter_sets([BOOSTED_SPEC])[0]


def train_points(spark, folder) -> DataFrame:
    def make() -> DataFrame:
        split = feature_split(spark, folder)
        features = T.feature_names(split)
        return stage(as_points(split.where(F.col("split") == "train"), KEY, features, TARGET), "train-points")

    return once(spark, folder, "train_points", make)


def _fit_rows(spark, folder) -> DataFrame:
    return once(spark, folder, "fit_rows", lambda: T.training_rows(train_points(spark, folder)))


def fitted(spark, folder, family: str, params: dict) -> PipelineModel:
    """A model fitted on the oversampled train rows, saved and loaded again."""
    features = T.feature_names(feature_split(spark, folder))
    model = fit_kept(T.make_estimator(family, params), _fit_rows(spark, folder))
    path = new_path(spark, family)
    PipelineModel([T.VectorAssembler(inputCols=features, outputCol="x"), model]).write().overwrite().save(path)
    return PipelineModel.load(path)


def tree_model(spark, folder) -> PipelineModel:
    return once(spark, folder, "tree", lambda: fitted(spark, folder, *TREE))


def scored_test(spark, folder, model: PipelineModel) -> DataFrame:
    test = feature_split(spark, folder).where(F.col("split") == "test")
    return T.score_checked(model, test).select(
        MONTH, CUSTOMER, col(TARGET).cast("int").alias("label"), F.col("probability").alias("score"))


def _evaluated(spark, folder, model: PipelineModel) -> DataFrame:
    split = feature_split(spark, folder)
    rows = split.groupBy().agg(F.count_if(F.col("split") == "train").alias("train"), F.count_if(F.col("split") == "test").alias("test")).first()
    features = model.stages[0].getInputCols()
    return R.evaluation_record(scored_test(spark, folder, model), T.model_type(model), rows["train"], rows["test"], len(features))


def train_tree(spark, folder) -> DataFrame:
    return _evaluated(spark, folder, tree_model(spark, folder))


def train_forest(spark, folder) -> DataFrame:
    return _evaluated(spark, folder, fitted(spark, folder, *FOREST))


def train_gbt(spark, folder) -> DataFrame:
    return _evaluated(spark, folder, fitted(spark, folder, *BOOSTED))


def _search(spark, folder) -> T.Search:
    return once(spark, folder, "search", lambda: T.grid_search(train_points(spark, folder)))


def cv_search(spark, folder) -> DataFrame:
    return T.cv_table(_search(spark, folder))


def score_batch(spark, folder) -> DataFrame:
    scored = scored_test(spark, folder, tree_model(spark, folder))
    return scored.withColumn("prediction", classify(F.col("score"), THRESHOLD))


def model_roc_auc(spark, folder) -> DataFrame:
    return E.roc_auc(scored_test(spark, folder, tree_model(spark, folder)))


def feature_importance(spark, folder) -> DataFrame:
    model = tree_model(spark, folder)
    return T.feature_importance(model, model.stages[0].getInputCols())


def model_signature(spark, folder) -> DataFrame:
    signature = T.model_signature(tree_model(spark, folder), TREE[0])
    return spark.createDataFrame([(signature["model_name"], signature["prediction_type"], signature["target"],
                                   signature["inputs"], signature["outputs"], signature["n_features"])],
                                 "model_name string, prediction_type string, target string, inputs array<string>, "
                                 "outputs map<string,string>, n_features int")


def signature_check(spark, folder) -> DataFrame:
    """Test rows scored through the contract: as they are, and with one feature gone and one too many."""
    model, test = tree_model(spark, folder), feature_split(spark, folder).where(F.col("split") == "test")
    parts = []
    for case, frame in (("as_fitted", test), ("changed", test.drop("EDAD").withColumn("EXTRA", F.lit(1)))):
        features = frame.select(*[col(c) for c in T.feature_names(frame)])
        try:
            scored = T.score_checked(model, frame).agg(F.count("probability")).first()[0]
        except G.GateError:
            scored = 0
        verdicts = G.signature_gate(features, model.stages[0].getInputCols())
        parts.append(verdicts.select(F.lit(case).alias("case"), "check", "passed", "detail", F.lit(scored).cast("long").alias("scored")))
    return parts[0].unionByName(parts[1])


def resampled_rows(spark, folder) -> DataFrame:
    """Rows and weights per class that an estimator fitted on the train rows sees, from inside the fit."""
    inner = T.make_estimator(*FOREST)
    table = train_points(spark, folder).withColumnRenamed("features", "x")
    rows = ResampledClassifier(estimator=inner).resampled(table)
    return rounded(rows.groupBy(F.col("label").cast("long").alias("class")).agg(
        F.count("*").alias("rows"), F.avg("weight").alias("weight"), F.count_if(F.size(vector_to_array("x")) == len(T.feature_names(
            feature_split(spark, folder)))).alias("complete")))


def input_example(spark, folder) -> DataFrame:
    """The first five test rows by key: the example stored with a model (a top-k report)."""
    return rounded(feature_split(spark, folder).where(F.col("split") == "test").orderBy(MONTH, CUSTOMER).limit(5))


INPUT_EXAMPLE_SQL = over_panel("SELECT " + ", ".join(
    f'round("{c}", 6) AS "{c}"' if ALL_LOGGED.get(c) == "double" else f'"{c}"' for c in ("CLIENTE", *FEATURES)
) + """, split FROM features JOIN (SELECT "MES", "CLIENTE", split FROM split) USING ("MES", "CLIENTE")
WHERE split = 'test' ORDER BY "MES", "CLIENTE" LIMIT 5""", FEATURE_CTE + ", " + SPLIT_CTES)


def training_record(spark, folder) -> DataFrame:
    """Shapes, class counts, and the best parameters per family, as one row."""
    split, search = feature_split(spark, folder), _search(spark, folder)
    counts = split_distribution(split)
    position, family, params, value = search.best()
    best = search.best_by_family().select(F.col("model_name").alias("k"), F.struct("best_cv_score", "best_params").alias("v"))
    results = F.map_from_entries(best.agg(F.array_sort(F.collect_list(F.struct("k", "v")))).scalar())
    classes = F.map_from_entries(counts.agg(F.array_sort(F.collect_list(
        F.struct(F.concat_ws("/", "split", F.col("class").cast("string")).alias("k"), F.col("count").alias("v"))))).scalar())
    return split.agg(F.count("*").alias("rows")).select(
        F.lit(TARGET).alias("target"), "rows", F.lit(len(split.columns) - 2).alias("columns"),
        F.lit(len(T.feature_names(split))).alias("n_features"), classes.alias("class_distribution"),
        F.array(*[F.lit(s.name) for s in MODEL_SPECS]).alias("models_trained"), results.alias("results_by_model"),
        F.lit(family).alias("best_model"), F.lit(json.dumps(params)).alias("best_params"),
        F.lit(value).alias("cv_best_score"),
    )


QUERIES = {
    "train_tree": train_tree,
    "train_forest": train_forest,
    "train_gbt": train_gbt,
    "cv_search": cv_search,
    "score_batch": score_batch,
    "model_roc_auc": model_roc_auc,
    "feature_importance": feature_importance,
    "model_signature": model_signature,
    "signature_check": signature_check,
    "resampled_rows": resampled_rows,
    "input_example": input_example,
    "training_record": training_record,
}

ORACLES = {
    "input_example": INPUT_EXAMPLE_SQL,
    "signature_check": over_panel("""SELECT * FROM (VALUES ('as_fitted', 'no_missing_features', true, ''), ('as_fitted', 'no_extra_features', true, ''),
 ('changed', 'no_missing_features', false, 'EDAD'), ('changed', 'no_extra_features', false, 'EXTRA')) AS t("case", "check", passed, detail),
 LATERAL (SELECT CASE WHEN "case" = 'as_fitted' THEN count(*) ELSE 0 END AS scored FROM split WHERE split = 'test')""", SPLIT_CTES),
    "resampled_rows": over_panel("""SELECT class, n AS "rows", round(CAST((SELECT sum(n) FROM grown) AS DOUBLE) / (2 * n), 6) AS weight, n AS complete
FROM grown""", SPLIT_CTES + ", " + GROWN.replace("FROM panel", "FROM split WHERE split = 'train'")),
}
