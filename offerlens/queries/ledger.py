"""Registered queries: the run ledger, fed with the monthly evaluations of the panel."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.contract import LEDGER_METRICS, MONTH, TARGET
from offerlens.operators import evaluate as E
from offerlens.operators import ledger as L
from offerlens.queries.evaluation import _METRICS, _MONTH_TOTALS, _auc_ctes
from offerlens.queries.inputs import once, scored
from offerlens.queries.panel_sql import over_scored
from offerlens.session import new_path, stage
from offerlens.sources import files

NAMES = ("accuracy", "precision", "recall", "f1", "roc_auc")


def monthly(spark, folder) -> DataFrame:
    """One evaluation per month: the runs of the ledger."""
    def make() -> DataFrame:
        metrics = E.binary_metrics(scored(spark, folder), [MONTH])
        run = F.concat(F.lit("run-"), F.col(MONTH).cast("string"))
        return stage(metrics.withColumn("run_id", run).withColumn("n_test", F.expr("tn + fp + fn + tp")), "monthly")

    return once(spark, folder, "monthly", make)


def metric_texts(spark, folder) -> DataFrame:
    """All recorded values of all runs as text, numbers or not."""
    return monthly(spark, folder).select("run_id", F.inline(F.array(*[
        F.struct(F.lit(m).alias("metric"), v.cast("string").alias("value")) for m, v in {
            **{n: F.col(n) for n in NAMES}, "n_test": F.col("n_test"), "tp": F.col("tp"),
            "threshold": F.lit("half"), "n_train": F.lit("true"),
        }.items()
    ])))


_MONTHLY = _MONTH_TOTALS + "," + _auc_ctes("scored", ('"MES"',)) + """,
monthly AS (SELECT 'run-' || "MES" AS run_id, "MES", tn, fp, fn, tp, tn + fp + fn + tp AS n_test, """ + ", ".join(
    f"round({x}, 4) AS {n}" for n, x in _METRICS.items()) + """, round(roc_auc, 4) AS roc_auc FROM totals JOIN auc USING ("MES"))"""


def ledger_metrics(spark, folder) -> DataFrame:
    return L.ledger_metrics(metric_texts(spark, folder), ["run_id"])


LEDGER_METRICS_SQL = over_scored(" UNION ALL ".join(
    f"SELECT run_id, '{n}' AS metric, CAST({n} AS DOUBLE) AS value FROM monthly" for n in (*NAMES, "n_test") if n in LEDGER_METRICS
), _MONTHLY)


def ledger_params(spark, folder) -> DataFrame:
    runs = monthly(spark, folder).select(
        "run_id", F.lit("hash_score").alias("best_model"), F.when(F.col("tp") > 0, "HashScore").alias("model_type"),
        F.lit(42).alias("random_state"), F.col("n_test").alias("rows"),
        F.array(F.lit("alpha"), F.lit("beta")).alias("models_trained"),
        F.create_map(F.lit("month"), F.col(MONTH).cast("string"), F.lit("hits"), F.col("tp").cast("string")).alias("params"))
    return L.ledger_params(runs, ["run_id"])


_PARAMS = {
    "target": f"'{TARGET}'", "best_model": "'hash_score'",
    "model_type": "coalesce(CASE WHEN tp > 0 THEN 'HashScore' END, 'unknown')", "selection_metric": "'unknown'",
    "random_state": "'42'", "test_size": "'unknown'", "rows": "CAST(n_test AS VARCHAR)", "columns": "'unknown'",
    "n_features": "'unknown'", "models_trained": "'alpha,beta'", "param_month": 'CAST("MES" AS VARCHAR)',
    "param_hits": "CAST(tp AS VARCHAR)",
}


def run_ledger(spark, folder) -> DataFrame:
    """The evaluations of all months registered one after the other."""
    path = new_path(spark, "runs")
    ledger = None
    for run in [r["run_id"] for r in monthly(spark, folder).select("run_id").orderBy("run_id").collect()]:
        metrics = metric_texts(spark, folder).where(F.col("run_id") == run)
        L.append_run(L.run_row(metrics, run, ledger, best_model="hash_score"), path)
        ledger = L.read_ledger(spark, path)
    return ledger.select("run_id", "registered_model_name", "version", "best_model", "metrics.*")


def claimed_versions(spark, folder) -> DataFrame:
    """The evaluations of all months registered at once by several writers: every version is given once."""
    path, claims = new_path(spark, "runs"), new_path(spark, "claims")
    runs = [r["run_id"] for r in monthly(spark, folder).select("run_id").collect()]  # one per month

    def register(run: str) -> None:
        metrics = metric_texts(spark, folder).where(F.col("run_id") == run)
        L.append_run(L.run_row(metrics, run, best_model="hash_score", claimed=L.claim_version(spark, claims)), path)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(register, runs))
    return L.read_ledger(spark, path).groupBy("registered_model_name", "version").agg(F.count("*").alias("runs"))


def model_versions(spark, folder) -> DataFrame:
    """Registrations alternate between two names."""
    month = F.col(MONTH)
    runs = monthly(spark, folder).select(
        "run_id", F.when(month % 2 == 0, "even").otherwise("odd").alias("registered_model_name"),
        F.make_date((month / 100).cast("int"), (month % 100).cast("int"), F.lit(1)).cast("string").alias("timestamp_utc"))
    return L.model_versions(runs)


def artifact_manifest(spark, folder) -> DataFrame:
    """The artifacts of an evaluation that were asked for and exist."""
    path = new_path(spark, "artifacts")
    files.write_document(monthly(spark, folder), f"{path}/metrics")
    files.write_delimited(metric_texts(spark, folder), f"{path}/metric_rows")
    return files.artifact_manifest(spark, path, ["metrics", "metric_rows", "absent"])


QUERIES = {
    "ledger_metrics": ledger_metrics,
    "ledger_params": ledger_params,
    "run_ledger": run_ledger,
    "claimed_versions": claimed_versions,
    "model_versions": model_versions,
    "artifact_manifest": artifact_manifest,
}

ORACLES = {
    "ledger_metrics": LEDGER_METRICS_SQL,
    "ledger_params": over_scored(" UNION ALL ".join(
        f"SELECT run_id, '{p}' AS param, {v} AS value FROM monthly" for p, v in _PARAMS.items()), _MONTHLY),
    "run_ledger": over_scored(f"""SELECT run_id, 'campaign_response_model' AS registered_model_name,
 CAST(row_number() OVER (ORDER BY run_id) AS INTEGER) AS version, 'hash_score' AS best_model, {", ".join(NAMES)}
 FROM monthly""", _MONTHLY),
    "claimed_versions": over_scored("""SELECT 'campaign_response_model' AS registered_model_name,
 CAST(row_number() OVER (ORDER BY run_id) AS INTEGER) AS version, 1 AS runs FROM monthly""", _MONTHLY),
    "model_versions": over_scored("""SELECT run_id, CASE WHEN "MES" % 2 = 0 THEN 'even' ELSE 'odd' END AS registered_model_name,
 printf('%d-%02d-01', "MES" // 100, "MES" % 100) AS timestamp_utc,
 CAST(row_number() OVER (PARTITION BY "MES" % 2 ORDER BY "MES") AS INTEGER) AS version FROM monthly""", _MONTHLY),
}
