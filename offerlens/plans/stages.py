"""The seven stages of a campaign run, each reading what earlier ones wrote.

ingest -> validate -> build features -> train -> evaluate -> gate -> register.
A run lives in one folder on a shared file system. Every artifact is written by
Spark, so stages may run in separate applications.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from offerlens.contract import (
    CUSTOMER,
    GATE_MINIMUMS,
    MODEL_SPECS,
    MONTH,
    REGISTERED_MODEL_NAME,
    SELECTION_METRIC,
    TARGET,
    FeatureSpec,
    ModelSpec,
)
from offerlens.functions.scalars import col
from offerlens.operators import evaluate as E
from offerlens.operators import gates as G
from offerlens.operators import ledger as L
from offerlens.operators import profile as P
from offerlens.operators.columns import rename_columns
from offerlens.operators.metrics import merge_metrics
from offerlens.operators.split import split_distribution, stratified_split
from offerlens.plans import reports as R
from offerlens.plans import train as T
from offerlens.plans.features import FeatureBuilder, FeatureBuilderModel
from offerlens.sources import files

KEY = (MONTH, CUSTOMER)
METRIC_SHAPE = "metric string, value string"
ARTIFACTS = ("metrics", "feature_importance", "model_signature", "training_record", "split",
             "classification_report", "model_report")


def _at(run: str, name: str) -> str:
    return f"{run.rstrip('/')}/{name}"


def _write(df: DataFrame, run: str, name: str) -> DataFrame:
    df.write.mode("overwrite").parquet(_at(run, name))
    return df.sparkSession.read.parquet(_at(run, name))


def _read(spark: SparkSession, run: str, name: str, hint: str) -> DataFrame:
    try:
        return spark.read.parquet(_at(run, name))
    except AnalysisException as error:
        raise FileNotFoundError(f"{name} not found in {run}: run the {hint} stage first") from error


def _report(df: DataFrame, run: str, name: str, small: bool = True) -> None:
    """A delimited report; a small one (a row per column, class or bin) as one file."""
    files.write_delimited(df.coalesce(1) if small else df, _at(run, name), ",")


def ingest(spark: SparkSession, source: str, run: str) -> DataFrame:
    """Read the delimited file, gate it, record it, hand it on as Parquet."""
    table = files.read_delimited(spark, source)
    G.enforce(G.dataset_gate(table))
    table = _write(table, run, "raw")
    files.write_document(P.ingest_record(table, source, files.content_md5(spark, source)), _at(run, "ingest_record"))
    return table


def validate(spark: SparkSession, run: str) -> DataFrame:
    """Profile the raw table: distributions, missing values, duplicates, describe."""
    table = rename_columns(_read(spark, run, "raw", "ingest"))
    _report(P.target_distribution(table), run, "target_distribution")
    _report(P.null_report(table), run, "null_report")
    _report(P.month_distribution(table), run, "mes_distribution")
    _report(P.describe_all(table), run, "describe_report")
    _report(P.null_patterns(table), run, "null_patterns", small=False)
    files.write_document(P.validation_summary(table, _at(run, "raw")), _at(run, "validation_summary"))
    return table


def build_features(spark: SparkSession, run: str, spec: FeatureSpec = FeatureSpec(), fit_on: str = "all") -> DataFrame:
    """Fit and apply the feature builder, gate the result, and split it.

    ``fit_on="train"`` fits on the train rows only, so nothing leaks from the
    test rows into imputed values; ``"all"`` fits on every row.
    """
    raw = _read(spark, run, "raw", "ingest")
    if fit_on == "train":
        raw = _write(stratified_split(raw, KEY, spec.target, seed=spec.seed), run, "raw_split")
        model = FeatureBuilder.of(spec).fit(raw.where(F.col("split") == "train").drop("split"))
    else:
        model = FeatureBuilder.of(spec).fit(raw)
    model.write().overwrite().save(_at(run, "feature_builder"))
    kept = [CUSTOMER, "split"] if fit_on == "train" else [CUSTOMER]
    # Observed in a session of its own: Spark cannot ship a session that has observed to tasks, which forests do.
    source = _read(spark.newSession(), run, "raw_split" if fit_on == "train" else "raw", "ingest")
    watch = G.Watch(model.keeping(CUSTOMER).transform(source), spec.target, kept, spec.floor_at_zero)
    _write(watch.df, run, "features")
    features = _read(spark, run, "features", "build features")
    shown = features.drop(*kept)
    G.enforce(watch.final_gate())
    G.enforce(watch.label_gate())
    files.write_document(model.imputations(spark), _at(run, "imputations"))
    files.write_document(spark.createDataFrame([(json.dumps(model.record(shown, _at(run, "raw"))),)], "record string"),
                         _at(run, "feature_record"))
    split = features if fit_on == "train" else stratified_split(features, KEY, spec.target, seed=spec.seed)
    split.write.mode("overwrite").partitionBy("split").parquet(_at(run, "split"))
    return spark.read.parquet(_at(run, "split"))


def train(spark: SparkSession, run: str, specs: Sequence[ModelSpec] = MODEL_SPECS, parallelism: int = 4) -> T.Training:
    """Search, refit, and write the model with its signature, importances and records."""
    split = _read(spark, run, "split", "build features")
    done = T.train(split, KEY, specs=specs, parallelism=parallelism)
    features = done.model.stages[0].getInputCols()
    done.model.write().overwrite().save(_at(run, "model"))
    _report(T.feature_importance(done.model, features), run, "feature_importance")
    _report(T.cv_table(done.search), run, "cv_results")
    signature = T.model_signature(done.model, done.family)
    files.write_document(spark.createDataFrame([(json.dumps(signature),)], "signature string"), _at(run, "model_signature"))
    best = {r["model_name"]: [r["best_cv_score"], r["best_params"]] for r in done.search.best_by_family().collect()}
    sizes = {f"{r['split']}/{r['class']}": r["count"] for r in split_distribution(split).collect()}
    record = {
        "rows": sum(n for k, n in sizes.items() if k.startswith("total/")), "columns": len(features) + 1,
        "n_features": len(features), "class_distribution": sizes, "models_trained": [s.name for s in specs],
        "results_by_model": best, "best_model": done.family, "best_params": done.params,
    }
    files.write_document(spark.createDataFrame([(json.dumps(record),)], "record string"), _at(run, "training_record"))
    facts = [("best_model", done.family), ("selection_metric", SELECTION_METRIC), ("cv_best_score", f"{done.cv_score:.4f}"),
             ("params", json.dumps(done.params)), ("rows", str(record["rows"])), ("columns", str(record["columns"])),
             ("models_trained", ",".join(record["models_trained"]))]
    _upsert(spark, run, spark.createDataFrame(facts, METRIC_SHAPE))
    return done


def _upsert(spark: SparkSession, run: str, new: DataFrame, patience: float = 60.0) -> DataFrame:
    """Merge metrics into those of the run, as the next version of their table.

    A version is claimed before it is written. Who finds it claimed waits until it is
    there and merges into that one; a claim without a table after ``patience`` seconds is passed over.
    """
    waited, skip = 0.0, 0
    while True:
        last, table = _newest_metrics(spark, run)
        version = last + 1 + skip
        if files.create_if_absent(spark, _at(run, f"metric_claims/{version}")):
            path = _at(run, f"metrics/version={version}")
            (merge_metrics(table, new) if table is not None else new).coalesce(1).write.mode("overwrite").parquet(path)
            return spark.read.parquet(path)
        if waited >= patience:
            waited, skip = 0.0, skip + 1
        else:
            time.sleep(0.25)
            waited += 0.25
            if _newest_metrics(spark, run)[0] > last:
                waited, skip = 0.0, 0


def _newest_metrics(spark: SparkSession, run: str) -> tuple[int, DataFrame | None]:
    """The highest written version of the metrics and its table; -1 without any."""
    try:
        found = spark.read.schema(f"{METRIC_SHAPE}, version int").parquet(_at(run, "metrics"))
    except AnalysisException:
        return -1, None
    last = found.agg(F.max("version")).first()[0]
    return (-1, None) if last is None else (last, spark.read.schema(METRIC_SHAPE).parquet(_at(run, f"metrics/version={last}")))


def metrics(spark: SparkSession, run: str) -> DataFrame:
    _, table = _newest_metrics(spark, run)
    if table is None:
        raise FileNotFoundError(f"metrics not found in {run}: run the train and evaluate stages first")
    return table


def evaluate(spark: SparkSession, run: str) -> DataFrame:
    """Score the test rows, write every report, and merge the metrics."""
    split = _read(spark, run, "split", "build features")
    if not {"train", "test"} <= {r["split"] for r in split.select("split").distinct().limit(3).collect()}:
        raise ValueError("the split table needs train and test rows")
    model = PipelineModel.load(_at(run, "model"))
    test = split.where(F.col("split") == "test")
    scored = _write(T.score_checked(model, test).select(
        *KEY, col(TARGET).cast("int").alias("label"), F.col("probability").alias("score")), run, "scored")
    n_train = split.where(F.col("split") == "train").agg(F.count("*")).scalar()
    record = _write(R.evaluation_record(scored, T.model_type(model), n_train, scored.agg(F.count("*")).scalar(),
                                        len(model.stages[0].getInputCols())), run, "evaluation_record")
    _report(E.classification_report(scored), run, "classification_report")
    _report(E.roc_curve(scored), run, "roc_curve", small=False)
    _report(E.score_histogram(scored), run, "score_histogram")
    _report(R.report_rows(record), run, "model_report")
    texts = record.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("metric"), F.col(c).cast("string").alias("value"))
        for c in record.columns if c != "confusion_matrix"
    ])))
    return _upsert(spark, run, texts)


def gate(spark: SparkSession, run: str) -> bool:
    """Does the evaluated model reach every minimum?"""
    verdicts = _write(G.quality_gate(metrics(spark, run)), run, "quality_gate")
    return verdicts.select("approved").first()["approved"]


def register(spark: SparkSession, run: str, ledger: str, name: str = REGISTERED_MODEL_NAME, require_gate: bool = True) -> DataFrame:
    """Append the run to the ledger with the next version of its name, claimed before anything is written."""
    if require_gate and not gate(spark, run):
        raise G.GateError(f"the model misses a minimum: {GATE_MINIMUMS}")
    table = metrics(spark, run)
    run_id = uuid.uuid4().hex
    version = L.claim_version(spark, _at(ledger, "versions"), name)
    facts = {r["metric"]: r["value"] for r in table.where(F.col("metric").isin(
        "best_model", "model_type", "selection_metric", "random_state", "test_size", "params", "n_features", "rows", "columns",
        "models_trained")).collect()}
    trained = facts.pop("models_trained", "").split(",")
    row = L.run_row(table, run_id, name=name, claimed=version, best_model=facts.get("best_model"), model_path=_at(run, "model"))
    own = {k: json.dumps(v) if isinstance(v, (dict, list)) else str(v) for k, v in json.loads(facts.pop("params", "{}")).items()}
    pairs = [F.lit(v).alias(k) for k, v in facts.items()]
    params = F.create_map(*[F.lit(x) for pair in own.items() for x in pair]) if own else F.create_map().cast("map<string,string>")
    facts_row = spark.range(1).select(F.lit(run_id).alias("run_id"), *pairs, params.alias("params"),
                                      F.array(*[F.lit(name) for name in trained]).alias("models_trained"))
    L.append_run(L.ledger_metrics(table).withColumn("run_id", F.lit(run_id)), _at(ledger, "metrics"))
    L.append_run(L.ledger_params(facts_row, ["run_id"]), _at(ledger, "params"))
    L.append_run(files.artifact_manifest(spark, run, ARTIFACTS, digest=False).withColumn("run_id", F.lit(run_id)), _at(ledger, "artifacts"))
    split = _read(spark, run, "split", "build features")
    example = split.where(F.col("split") == "test").orderBy(*KEY).limit(5).select(F.to_json(F.struct("*")).alias("row"))
    L.append_run(example.withColumn("run_id", F.lit(run_id)), _at(ledger, "examples"))
    L.append_run(spark.read.text(_at(run, "model_signature")).withColumn("run_id", F.lit(run_id)), _at(ledger, "signatures"))
    L.append_run(row, _at(ledger, "runs"))
    return L.read_ledger(spark, _at(ledger, "runs")).where(F.col("run_id") == run_id)


def load_feature_builder(run: str) -> FeatureBuilderModel:
    return FeatureBuilderModel.load(_at(run, "feature_builder"))


def run_all(
    spark: SparkSession, source: str, run: str, ledger: str, specs: Sequence[ModelSpec] = MODEL_SPECS,
    require_gate: bool = True, parallelism: int = 4,
) -> DataFrame:
    """All stages in order; raises at the first failed gate."""
    ingest(spark, source, run)
    validate(spark, run)
    build_features(spark, run)
    train(spark, run, specs, parallelism)
    evaluate(spark, run)
    return register(spark, run, ledger, require_gate=require_gate)
