"""The run ledger: metrics, parameters, runs and model versions as tables."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerlens.contract import EXPERIMENT_NAME, LEDGER_METRICS, REGISTERED_MODEL_NAME, TARGET
from offerlens.sources.files import create_if_absent

UNKNOWN = "unknown"
TRAINING_FACTS = ("rows", "columns", "n_features", "models_trained")
RUN_METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def ledger_metrics(metrics: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """The listed metrics that hold a number; ``value`` may be text."""
    number = F.col("value").try_cast("double")
    return metrics.where(F.col("metric").isin(*LEDGER_METRICS) & number.isNotNull()).select(
        *keys, "metric", number.alias("value")
    )


def ledger_params(runs: DataFrame, keys: Sequence[str] = (), target: str = TARGET) -> DataFrame:
    """Parameters of each run as rows (param, value); what is missing reads ``unknown``.

    ``runs`` may have best_model, model_type, selection_metric, random_state,
    test_size, rows, columns, n_features (scalars), models_trained (array) and
    params (map). Map entries become ``param_<name>``.
    """
    def text(name: str, *others: str) -> Column:
        there = [F.col(c).cast("string") for c in (name, *others) if c in runs.columns]
        return F.coalesce(*there, F.lit(UNKNOWN))

    fixed = {
        "target": F.lit(target),
        "best_model": text("best_model", "model_type"),
        "model_type": text("model_type"),
        "selection_metric": text("selection_metric"),
        "random_state": text("random_state"),
        "test_size": text("test_size"),
    }
    if set(TRAINING_FACTS) & set(runs.columns):
        fixed.update({name: text(name) for name in TRAINING_FACTS[:3]})
        trained = F.array_join("models_trained", ",") if "models_trained" in runs.columns else F.lit("")
        fixed["models_trained"] = trained
    pairs = F.array(*[F.struct(F.lit(k).alias("param"), v.alias("value")) for k, v in fixed.items()])
    if "params" in runs.columns:
        own = F.transform(F.map_entries("params"), lambda e: F.struct(
            F.concat(F.lit("param_"), e["key"]).alias("param"), e["value"].cast("string").alias("value")))
        pairs = F.concat(pairs, F.coalesce(own, F.array().cast("array<struct<param:string,value:string>>")))
    return runs.select(*keys, F.inline(pairs))


def model_versions(runs: DataFrame) -> DataFrame:
    """Version 1, 2, ... of each registered name in order of time.

    One row per registration, so the windows are as small as the ledger.
    """
    order = Window.partitionBy("registered_model_name").orderBy("timestamp_utc", "run_id")
    return runs.withColumn("version", F.row_number().over(order))


def next_version(ledger: DataFrame, name: str = REGISTERED_MODEL_NAME) -> Column:
    """One more than the highest version of ``name``, as a scalar."""
    known = ledger.where(F.col("registered_model_name") == name)
    return F.coalesce(known.agg(F.max("version")).scalar(), F.lit(0)) + 1


def claim_version(spark: SparkSession, path: str, name: str = REGISTERED_MODEL_NAME, known: int = 0) -> int:
    """The next version of ``name``, claimed by a file under ``path`` that only one writer can create.

    ``known`` is the highest version seen. Who finds a version taken tries the next one, so
    registrations at once get versions of their own. A version whose writer fails stays unused.
    """
    version = known + 1
    while not create_if_absent(spark, f"{path.rstrip('/')}/{quote(name, safe='')}/{version}"):
        version += 1
    return version


def run_row(
    metrics: DataFrame, run_id: str, ledger: DataFrame | None = None, name: str = REGISTERED_MODEL_NAME,
    experiment: str = EXPERIMENT_NAME, best_model: str | None = None, model_path: str | None = None, claimed: int | None = None,
) -> DataFrame:
    """The registration record of one run: identity, time, version and main metrics.

    A ``claimed`` version holds among several writers; without one the version is the next of ``ledger``.
    """
    version = F.lit(claimed) if claimed is not None else next_version(ledger, name) if ledger is not None else F.lit(1)
    values = {m: F.max(F.when(F.col("metric") == m, F.col("value").try_cast("double"))) for m in RUN_METRICS}
    return metrics.agg(*[v.alias(m) for m, v in values.items()]).select(
        F.lit(run_id).alias("run_id"),
        F.lit(experiment).alias("experiment_name"),
        F.lit(name).alias("registered_model_name"),
        version.cast("int").alias("version"),
        F.current_timestamp().alias("timestamp_utc"),
        F.lit(model_path).cast("string").alias("model_path"),
        F.lit(best_model).cast("string").alias("best_model"),
        F.struct(*[F.col(m) for m in RUN_METRICS]).alias("metrics"),
    )


def append_run(row: DataFrame, path: str) -> None:
    """Add rows in a folder of their own, as appends at once to one folder disturb each other."""
    row.write.parquet(f"{path.rstrip('/')}/append=u-{uuid.uuid4().hex}")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All rows that were added to a table of the ledger."""
    return spark.read.parquet(path).drop("append")
