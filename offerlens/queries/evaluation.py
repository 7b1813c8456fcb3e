"""Registered queries: scoring thresholds, metrics, curves, gate and cross-validation tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.contract import GATE_MINIMUMS, MONTH, N_FOLDS, SEARCH_METRICS, SEED, TARGET, THRESHOLD
from offerlens.functions.hashing import uniform
from offerlens.functions.scalars import classify, col, sigmoid
from offerlens.operators import evaluate as E
from offerlens.operators import gates as G
from offerlens.operators import metrics as M
from offerlens.operators.split import stratified_folds
from offerlens.plans import reports as R
from offerlens.queries.inputs import KEY, KEY_SQL, once, panel, rounded, scored
from offerlens.queries.panel_sql import digest_sql, over_panel, over_scored, uniform_sql
from offerlens.session import stage
from offerlens.sources.panel import read_table


def threshold_predict(spark, folder) -> DataFrame:
    return scored(spark, folder).select(*KEY, classify(F.col("score"), THRESHOLD).alias("prediction"))


def sigmoid_score(spark, folder) -> DataFrame:
    margin = (col("Nro_Entidades") - 6) / F.lit(5.0) + col("Dif_Entidades") / F.lit(2.0)
    return rounded(panel(spark, folder).select(*KEY, sigmoid(margin).alias("probability")))


SIGMOID_SQL = over_panel("""
SELECT "MES", "CLIENTE", round(1 / (1 + exp(-(("Nro_Entidades" - 6) / CAST(5 AS DOUBLE)
  + "Dif_Entidades" / CAST(2 AS DOUBLE)))), 6) AS probability FROM panel""")

_CUT = f"CAST({THRESHOLD} AS DOUBLE)"
_TOTALS = f"""
totals AS (SELECT count(*) FILTER (label = 0 AND score < {_CUT}) AS tn, count(*) FILTER (label = 0 AND score >= {_CUT}) AS fp,
  count(*) FILTER (label = 1 AND score < {_CUT}) AS fn, count(*) FILTER (label = 1 AND score >= {_CUT}) AS tp FROM scored)"""


def _ratio(a: str, b: str) -> str:
    return f"CASE WHEN {b} = 0 THEN 0 ELSE ({a}) / CAST({b} AS DOUBLE) END"


_METRICS = {
    "accuracy": _ratio("tp + tn", "(tn + fp + fn + tp)"),
    "precision": _ratio("tp", "(tp + fp)"),
    "recall": _ratio("tp", "(tp + fn)"),
    "f1": _ratio("2 * tp", "(2 * tp + fp + fn)"),
}


def _auc_ctes(source: str, groups: tuple[str, ...] = ()) -> str:
    """SQL of the exact area under the curve, per group, as CTE ``auc``."""
    g = "".join(f"{c}, " for c in groups)
    part = f"PARTITION BY {', '.join(groups)} " if groups else ""
    group = f"GROUP BY {', '.join(groups)}" if groups else ""
    return f"""
per_score AS (SELECT {g}score, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM {source} GROUP BY {g}score),
ranked AS (SELECT *, sum(pos) OVER ({part}ORDER BY score DESC) AS upto_pos, sum(neg) OVER ({part}ORDER BY score DESC) AS upto_neg
  FROM per_score),
auc AS (SELECT {g}CASE WHEN sum(pos) * sum(neg) > 0 THEN CAST(sum(neg * (2 * upto_pos - pos)) AS DOUBLE) / 2
  / CAST(sum(pos) * sum(neg) AS DOUBLE) END AS roc_auc FROM ranked {group})"""


def confusion_matrix(spark, folder) -> DataFrame:
    return E.confusion_matrix(scored(spark, folder))


CONFUSION_SQL = over_scored("""
SELECT 0 AS actual, 0 AS predicted, tn AS count FROM totals UNION ALL SELECT 0, 1, fp FROM totals
UNION ALL SELECT 1, 0, fn FROM totals UNION ALL SELECT 1, 1, tp FROM totals""", _TOTALS)


def binary_metrics(spark, folder) -> DataFrame:
    return E.binary_metrics(scored(spark, folder), digits=6)


METRICS_SQL = over_scored("SELECT tn, fp, fn, tp, " + ", ".join(
    f"round({x}, 6) AS {n}" for n, x in _METRICS.items()
) + ", round(roc_auc, 6) AS roc_auc FROM totals, auc", _TOTALS + "," + _auc_ctes("scored"))


def monthly_metrics(spark, folder) -> DataFrame:
    return E.binary_metrics(scored(spark, folder), [MONTH], digits=6)


_MONTH_TOTALS = _TOTALS.replace("SELECT count(*) FILTER (label = 0 AND score <", 'SELECT "MES", count(*) FILTER (label = 0 AND score <', 1
                                ).replace("FROM scored)", 'FROM scored GROUP BY "MES")')
MONTHLY_SQL = over_scored('SELECT "MES", tn, fp, fn, tp, ' + ", ".join(
    f"round({x}, 6) AS {n}" for n, x in _METRICS.items()
) + ', round(roc_auc, 6) AS roc_auc FROM totals JOIN auc USING ("MES")', _MONTH_TOTALS + "," + _auc_ctes("scored", ('"MES"',)))


def label_quality(spark, folder) -> DataFrame:
    """Does a document's length tell its quality label: area under the curve."""
    documents = read_table(spark, folder, "documents").select("doc_id", "n_chars")
    labels = read_table(spark, folder, "labels").select("doc_id", F.col("quality").alias("label"))
    return rounded(E.roc_auc(labels.join(documents, "doc_id").withColumn("score", F.col("n_chars").cast("double"))))


QUALITY_SQL = f"""WITH s AS (SELECT quality AS label, CAST(n_chars AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)),
{_auc_ctes("s")} SELECT round(roc_auc, 6) AS roc_auc FROM auc"""


def roc_auc(spark, folder) -> DataFrame:
    return rounded(E.roc_auc(scored(spark, folder)))


def roc_curve(spark, folder) -> DataFrame:
    return rounded(E.roc_curve(scored(spark, folder)))


ROC_SQL = over_scored("""
SELECT score AS threshold, round(upto_neg / CAST(all_neg AS DOUBLE), 6) AS fpr, round(upto_pos / CAST(all_pos AS DOUBLE), 6) AS tpr
FROM (SELECT *, sum(pos) OVER () AS all_pos, sum(neg) OVER () AS all_neg,
        row_number() OVER (ORDER BY score DESC) AS place, lead(pos) OVER (ORDER BY score DESC) AS next_pos,
        lead(neg) OVER (ORDER BY score DESC) AS next_neg FROM ranked)
WHERE place = 1 OR next_pos IS NULL OR pos <> next_pos OR neg <> next_neg
UNION ALL SELECT CAST('inf' AS DOUBLE), 0.0, 0.0""", _auc_ctes("scored"))


def classification_report(spark, folder) -> DataFrame:
    return rounded(E.classification_report(scored(spark, folder)))


def _report_sql() -> str:
    zero = [_ratio("tn", "(tn + fn)"), _ratio("tn", "(tn + fp)"), _ratio("2 * tn", "(2 * tn + fn + fp)"), "CAST(tn + fp AS DOUBLE)"]
    one = [_ratio("tp", "(tp + fp)"), _ratio("tp", "(tp + fn)"), _ratio("2 * tp", "(2 * tp + fp + fn)"), "CAST(tp + fn AS DOUBLE)"]
    n = "CAST(tn + fp + fn + tp AS DOUBLE)"
    rows = {
        "0": zero, "1": one, "accuracy": [_METRICS["accuracy"]] * 4,
        "macro avg": [f"(({a}) + ({b})) / 2" for a, b in zip(zero[:3], one[:3])] + [n],
        "weighted avg": [f"(({a}) * (tn + fp) + ({b}) * (tp + fn)) / {n}" for a, b in zip(zero[:3], one[:3])] + [n],
    }
    return over_scored(" UNION ALL ".join(
        f"SELECT '{name}' AS class, " + ", ".join(
            f"round({v}, 6) AS {c}" for v, c in zip(values, ("precision", "recall", "f1", "support"))) + " FROM totals"
        for name, values in rows.items()), _TOTALS)


def score_histogram(spark, folder) -> DataFrame:
    return rounded(E.score_histogram(scored(spark, folder)))


HISTOGRAM_SQL = over_scored(f"""
SELECT label, bin, round(lo + (bin - 1) * (hi - lo) / {E.N_BINS}, 6) AS bin_from, round(lo + bin * (hi - lo) / {E.N_BINS}, 6) AS bin_to,
       coalesce(n, 0) AS count
FROM (SELECT *, CAST(unnest(range(1, {E.N_BINS} + 1)) AS INTEGER) AS bin FROM span) LEFT JOIN filled USING (label, bin)""", f"""
span AS (SELECT label, min(score) AS lo, max(score) AS hi FROM scored GROUP BY 1),
filled AS (SELECT label, CAST(least(floor((score - lo) / (hi - lo) * {E.N_BINS}) + 1, {E.N_BINS}) AS INTEGER) AS bin, count(*) AS n
           FROM scored JOIN span USING (label) GROUP BY 1, 2)""")


def _metric_table(spark, folder) -> DataFrame:
    return E.metric_rows(E.binary_metrics(scored(spark, folder)), ("accuracy", "precision", "recall", "f1", "roc_auc"))


def quality_gate(spark, folder) -> DataFrame:
    return G.quality_gate(_metric_table(spark, folder))


_ROWS = " UNION ALL ".join(
    f"SELECT '{n}' AS metric, round({x}, 4) AS value FROM totals" for n, x in _METRICS.items()
) + " UNION ALL SELECT 'roc_auc', round(roc_auc, 4) FROM auc"
_METRIC_CTES = _TOTALS + "," + _auc_ctes("scored") + f", metrics AS ({_ROWS})"
GATE_SQL = over_scored("""
SELECT metric, value, minimum, value >= minimum AS passed, bool_and(value >= minimum) OVER () AS approved
FROM limits JOIN metrics USING (metric)""", _METRIC_CTES + ", limits AS (SELECT * FROM (VALUES " + ", ".join(
    f"('{m}', CAST({v} AS DOUBLE))" for m, v in GATE_MINIMUMS.items()) + ") AS t(metric, minimum))")


def metrics_merge(spark, folder) -> DataFrame:
    """This month's metrics over those of the whole period."""
    whole = E.metric_rows(E.binary_metrics(scored(spark, folder)), ("accuracy", "precision", "recall"))
    last = scored(spark, folder).where(F.col(MONTH) == 199709)
    return M.merge_metrics(whole, E.metric_rows(E.binary_metrics(last), ("recall", "f1")))


MERGE_SQL = over_scored(f"""
SELECT 'accuracy' AS metric, round({_METRICS['accuracy']}, 4) AS value FROM totals
UNION ALL SELECT 'precision', round({_METRICS['precision']}, 4) FROM totals
UNION ALL SELECT 'recall', round({_METRICS['recall']}, 4) FROM last UNION ALL SELECT 'f1', round({_METRICS['f1']}, 4) FROM last""",
    _TOTALS + "," + _TOTALS.replace("totals AS", "last AS").replace("FROM scored)", 'FROM scored WHERE "MES" = 199709)'))


def evaluation_record(spark, folder) -> DataFrame:
    table = scored(spark, folder)
    return R.evaluation_record(table, "HashScore", 0, table.agg(F.count("*")).scalar(), 2).select(
        "accuracy", "precision", "recall", "f1", "roc_auc", "tn", "fp", "fn", "tp", "threshold", "test_size",
        "random_state", "target", "recall_minimum", "roc_auc_minimum", "f1_minimum", "model_type", "n_train",
        "n_test", "n_features")


RECORD_SQL = over_scored("SELECT " + ", ".join(f"round({x}, 4) AS {n}" for n, x in _METRICS.items()) + f""",
  round(roc_auc, 4) AS roc_auc, tn, fp, fn, tp, {_CUT} AS threshold, CAST(0.3 AS DOUBLE) AS test_size, {SEED} AS random_state,
  '{TARGET}' AS target, {", ".join(f"CAST({v} AS DOUBLE) AS {m}_minimum" for m, v in GATE_MINIMUMS.items())},
  'HashScore' AS model_type, 0 AS n_train, tn + fp + fn + tp AS n_test, 2 AS n_features FROM totals, auc""",
    _TOTALS + "," + _auc_ctes("scored"))


def report_rows(spark, folder) -> DataFrame:
    table = scored(spark, folder)
    return R.report_rows(R.evaluation_record(table, "HashScore", 0, table.agg(F.count("*")).scalar(), 2))


def _report_rows_sql() -> str:
    number = "CAST({x} AS VARCHAR)"
    setup = [("model", "'HashScore'"), ("train_rows", "'0'"), ("test_rows", number.format(x="(tn + fp + fn + tp)")),
             ("features", "'2'"), ("test_size", "'0.3'"), ("seed", f"'{SEED}'"), ("threshold", f"'{THRESHOLD}'")]
    metrics = [(n, f"printf('%.4f', round({x}, 4))") for n, x in _METRICS.items()] + [("roc_auc", "printf('%.4f', round(roc_auc, 4))")]
    minimums = [(m, f"'{v:.4f}'") for m, v in GATE_MINIMUMS.items()]
    matrix = [(c, number.format(x=c)) for c in ("tn", "fp", "fn", "tp")]
    parts = {"setup": setup, "metrics": metrics, "minimums": minimums, "confusion_matrix": matrix}
    return over_scored(" UNION ALL ".join(
        f"SELECT '{section}' AS section, '{item}' AS item, {value} AS value FROM totals, auc"
        for section, rows in parts.items() for item, value in rows), _TOTALS + "," + _auc_ctes("scored"))


# Stand-ins for fitted parameter sets: (family, position, weight of the label, own parameter).
SCORERS = (
    ("alpha", 0, 0.10, "depth", 4), ("alpha", 1, 0.30, "depth", 6),
    ("beta", 2, 0.20, "trees", 100), ("beta", 3, 0.25, "trees", 200),
)


def fold_scores(spark, folder) -> DataFrame:
    """Every panel row scored by every stand-in, with its fold."""
    rows = stratified_folds(panel(spark, folder).select(*KEY, TARGET), KEY)
    scorers = F.array(*[
        F.struct(F.lit(p).alias("position"), F.lit(f).alias("model_name"), F.lit(f"{n}={v}").alias("params"),
                 F.round(uniform(p, "scorer", KEY) * (1 - w) + col(TARGET) * w, 4).alias("score"))
        for f, p, w, n, v in SCORERS
    ])
    return rows.select(F.col("fold"), col(TARGET).cast("int").alias("label"), F.inline(scorers))


def fold_metrics(spark, folder) -> DataFrame:
    """One row per stand-in, fold and metric: what a search leaves behind."""
    def make() -> DataFrame:
        groups = ["model_name", "position", "params", "fold"]
        metrics = E.binary_metrics(fold_scores(spark, folder), groups, digits=None)
        return stage(E.metric_rows(metrics, SEARCH_METRICS, groups), "fold-metrics")

    return once(spark, folder, "fold_metrics", make)


_SCORES = " UNION ALL ".join(
    f"""SELECT fold, label, {p} AS position, '{f}' AS model_name, '{n}={v}' AS params,
    round({uniform_sql(p, 'scorer', KEY_SQL)} * CAST({1 - w} AS DOUBLE) + label * CAST({w} AS DOUBLE), 4) AS score FROM folded"""
    for f, p, w, n, v in SCORERS
)
_G = ("model_name", "position", "params", "fold")
_FOLD_CTES = f"""
folded AS (SELECT "MES", "CLIENTE", "FLAG_VENTA" AS label, CASE WHEN place <= q0 THEN 0 WHEN place <= q0 + q1 THEN 1 ELSE 2 END AS fold
  FROM (SELECT *, row_number() OVER (PARTITION BY "FLAG_VENTA" ORDER BY {digest_sql(SEED, 'fold', KEY_SQL)}) AS place FROM panel)
  JOIN (SELECT cls, count(*) FILTER ((first + i) % {N_FOLDS} = 0) AS q0, count(*) FILTER ((first + i) % {N_FOLDS} = 1) AS q1
        FROM (SELECT cls, n, CAST(coalesce(sum(n) OVER (ORDER BY cls ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS first
              FROM (SELECT "FLAG_VENTA" AS cls, count(*) AS n FROM panel GROUP BY 1)), LATERAL (SELECT unnest(range(n)) AS i)
        GROUP BY 1) ON cls = "FLAG_VENTA"),
fold_scores AS ({_SCORES}),
totals AS (SELECT {", ".join(_G)}, count(*) FILTER (label = 0 AND score < {_CUT}) AS tn, count(*) FILTER (label = 0 AND score >= {_CUT}) AS fp,
  count(*) FILTER (label = 1 AND score < {_CUT}) AS fn, count(*) FILTER (label = 1 AND score >= {_CUT}) AS tp FROM fold_scores GROUP BY ALL),
{_auc_ctes("fold_scores", _G)},
fold_metrics AS (SELECT {", ".join(_G)}, metric, value FROM (
  {" UNION ALL ".join(f"SELECT {', '.join(_G)}, '{m}' AS metric, {_METRICS[m]} AS value FROM totals" for m in SEARCH_METRICS if m in _METRICS)}
  UNION ALL SELECT {", ".join(_G)}, 'roc_auc', roc_auc FROM auc)),
summary AS (SELECT model_name, position, params, metric, avg(value) AS mean, stddev_pop(value) AS std, count(*) AS folds
  FROM fold_metrics GROUP BY ALL)"""


def _summary(spark, folder) -> DataFrame:
    return M.cv_summary(fold_metrics(spark, folder), ("model_name", "position", "params", "metric"))


def cv_rank(spark, folder) -> DataFrame:
    """Ranks over means of four decimals, so that ties occur."""
    ranked = M.cv_rank(_summary(spark, folder).withColumn("mean", F.round("mean", 4)))
    return ranked.select("model_name", "params", "metric", "mean", "rank")


def cv_union(spark, folder) -> DataFrame:
    """Families with parameters of their own under each other."""
    parts = []
    for family, name in (("alpha", "depth"), ("beta", "trees")):
        own = _summary(spark, folder).where(F.col("model_name") == family)
        value = F.element_at(F.split("params", "="), 2).cast("int")
        parts.append(own.select("model_name", "metric", "mean", value.alias(f"param_{name}")))
    return rounded(M.union_results(parts))


def best_model(spark, folder) -> DataFrame:
    return rounded(M.best_model(_summary(spark, folder), "roc_auc"))


QUERIES = {
    "threshold_predict": threshold_predict,
    "sigmoid_score": sigmoid_score,
    "confusion_matrix": confusion_matrix,
    "binary_metrics": binary_metrics,
    "monthly_metrics": monthly_metrics,
    "roc_auc": roc_auc,
    "label_quality_auc": label_quality,
    "roc_curve": roc_curve,
    "classification_report": classification_report,
    "score_histogram": score_histogram,
    "quality_gate": quality_gate,
    "metrics_merge": metrics_merge,
    "evaluation_record": evaluation_record,
    "report_rows": report_rows,
    "cv_summary": lambda s, d: rounded(_summary(s, d)),
    "cv_rank": cv_rank,
    "cv_union": cv_union,
    "best_model": best_model,
}

ORACLES = {
    "threshold_predict": over_scored(f'SELECT "MES", "CLIENTE", CAST(score >= {_CUT} AS INTEGER) AS prediction FROM scored'),
    "sigmoid_score": SIGMOID_SQL,
    "confusion_matrix": CONFUSION_SQL,
    "binary_metrics": METRICS_SQL,
    "monthly_metrics": MONTHLY_SQL,
    "roc_auc": over_scored("SELECT round(roc_auc, 6) AS roc_auc FROM auc", _auc_ctes("scored")),
    "label_quality_auc": QUALITY_SQL,
    "roc_curve": ROC_SQL,
    "classification_report": _report_sql(),
    "score_histogram": HISTOGRAM_SQL,
    "quality_gate": GATE_SQL,
    "metrics_merge": MERGE_SQL,
    "evaluation_record": RECORD_SQL,
    "report_rows": _report_rows_sql(),
    "cv_summary": over_panel("""SELECT model_name, position, params, metric, round(mean, 6) AS mean, round(std, 6) AS std, folds
FROM summary""", _FOLD_CTES),
    "cv_rank": over_panel("""SELECT model_name, params, metric, mean,
 CAST(rank() OVER (PARTITION BY model_name, metric ORDER BY mean DESC) AS INTEGER) AS rank
 FROM (SELECT model_name, params, metric, round(mean, 4) AS mean FROM summary)""", _FOLD_CTES),
    "cv_union": over_panel("""SELECT model_name, metric, round(mean, 6) AS mean,
 CASE WHEN model_name = 'alpha' THEN CAST(split_part(params, '=', 2) AS INTEGER) END AS param_depth,
 CASE WHEN model_name = 'beta' THEN CAST(split_part(params, '=', 2) AS INTEGER) END AS param_trees FROM summary""", _FOLD_CTES),
    "best_model": over_panel("""SELECT model_name, params, round(mean, 6) AS best_cv_score FROM summary WHERE metric = 'roc_auc'
 ORDER BY mean DESC, position LIMIT 1""", _FOLD_CTES),
}
