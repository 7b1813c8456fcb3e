import numpy as np
import pytest
from frames import twelve_rows
from pyspark.sql import functions as F

from offerlens.functions.scalars import classify, sigmoid
from offerlens.operators import evaluate as E
from offerlens.operators import gates as G
from offerlens.operators import metrics as M
from offerlens.plans import reports as R


def scored_from_matrix(spark, tn, fp, fn, tp):
    rows = [(0, 0.1, tn), (0, 0.9, fp), (1, 0.1, fn), (1, 0.9, tp)]
    table = spark.createDataFrame(rows, "label int, score double, n int")
    return table.withColumn("i", F.explode(F.expr("sequence(1, n)"))).drop("n", "i")


def test_published_matrix_gives_published_metrics(spark):
    scored = scored_from_matrix(spark, 23174, 2045, 891, 157)
    row = E.binary_metrics(scored).first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (0.8882, 0.0713, 0.1498, 0.0966)
    report = {r["class"]: r for r in E.classification_report(scored).collect()}
    expected = {
        "0": (0.9629752752960732, 0.9189103453745192, 0.9404269133998864, 25219.0),
        "1": (0.07129881925522252, 0.14980916030534353, 0.09661538461538462, 1048.0),
        "accuracy": (0.8882247687212091,) * 4,
        "macro avg": (0.5171370472756478, 0.5343597528399313, 0.5185211490076355, 26267.0),
        "weighted avg": (0.9273991940560834, 0.8882247687212091, 0.9067605456317301, 26267.0),
    }
    for name, values in expected.items():
        assert tuple(report[name])[1:] == pytest.approx(values, rel=1e-12)
    cells = {(r["actual"], r["predicted"]): r["count"] for r in E.confusion_matrix(scored).collect()}
    assert cells == {(0, 0): 23174, (0, 1): 2045, (1, 0): 891, (1, 1): 157}


@pytest.mark.parametrize("value", [None, float("nan"), float("inf")])
def test_scores_must_be_finite(spark, value):
    scored = spark.createDataFrame([(1, 0.5), (0, value)], "label int, score double")
    for metric in (E.roc_auc, E.confusion_matrix):
        with pytest.raises(Exception, match="missing or not finite"):
            metric(scored).collect()


def pairs_auc(labels, scores):
    pos, neg = scores[labels == 1], scores[labels == 0]
    return ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / (len(pos) * len(neg))


@pytest.fixture(scope="module")
def sample(spark):
    """Scores with ties; a third of all rows share one score, and most lie in a narrow range."""
    rng = np.random.default_rng(2)
    labels = (rng.random(3000) < 0.2).astype(int)
    scores = np.round(rng.beta(1, 60, 3000) + 0.005 * labels, 4)
    scores[rng.random(3000) < 0.33] = 0.01
    rows = [(int(a), float(b), i % 3) for i, (a, b) in enumerate(zip(labels, scores))]
    return labels, scores, spark.createDataFrame(rows, "label int, score double, part int")


@pytest.mark.parametrize("size", [50_000, 40, 7])
def test_auc_is_exact_for_any_range_size(sample, size):
    labels, scores, table = sample
    assert E.roc_auc(table, rows_per_range=size).first()[0] == pytest.approx(pairs_auc(labels, scores), abs=1e-12)
    parts = np.arange(3000) % 3
    for r in E.roc_auc(table, ["part"], size).collect():
        mine = parts == r["part"]
        assert r["roc_auc"] == pytest.approx(pairs_auc(labels[mine], scores[mine]), abs=1e-12)


@pytest.mark.parametrize("size", [50_000, 40])
def test_roc_curve_equals_a_direct_computation(sample, size):
    labels, scores, table = sample
    values = np.unique(scores)[::-1]
    fps = np.array([((scores >= v) & (labels == 0)).sum() for v in values])
    tps = np.array([((scores >= v) & (labels == 1)).sum() for v in values])
    keep = np.r_[True, (np.diff(fps, 2) != 0) | (np.diff(tps, 2) != 0), True]
    rows = E.roc_curve(table, True, size).orderBy(F.desc("threshold")).collect()
    assert (rows[0]["threshold"], rows[0]["fpr"], rows[0]["tpr"]) == (float("inf"), 0.0, 0.0)
    assert [r["threshold"] for r in rows[1:]] == values[keep].tolist()
    assert [r["fpr"] for r in rows[1:]] == pytest.approx((fps[keep] / fps[-1]).tolist())
    assert [r["tpr"] for r in rows[1:]] == pytest.approx((tps[keep] / tps[-1]).tolist())
    assert E.roc_curve(table, False, size).count() == len(values) + 1


def test_auc_of_one_class_is_missing(spark):
    table = spark.createDataFrame([(1, 0.3), (1, 0.4)], "label int, score double")
    assert E.roc_auc(table).first()[0] is None
    row = E.binary_metrics(table).first()
    assert (row["precision"], row["recall"], row["f1"]) == (0.0, 0.0, 0.0)


def test_histogram_equals_numpy(sample):
    labels, scores, table = sample
    rows = E.score_histogram(table).orderBy("label", "bin").collect()
    for cls in (0, 1):
        counts, edges = np.histogram(scores[labels == cls], 30)
        mine = [r for r in rows if r["label"] == cls]
        assert sum(r["count"] for r in mine) == counts.sum()
        assert [r["bin_from"] for r in mine] == pytest.approx(edges[:-1].tolist())
        # A value on an inner edge may fall on either side of it by rounding.
        assert np.abs(np.cumsum([r["count"] for r in mine]) - np.cumsum(counts)).max() <= (scores == 0.01).sum()


def test_histogram_of_equal_scores(spark):
    table = spark.createDataFrame([(0, 0.5), (0, 0.5), (1, 0.2)], "label int, score double")
    rows = E.score_histogram(table).where("count > 0").orderBy("label").collect()
    assert [(r["label"], r["count"]) for r in rows] == [(0, 2), (1, 1)]


def test_threshold_counts_itself(spark):
    table = spark.createDataFrame([(0.49,), (0.5,), (0.51,)], "s double")
    assert [r[0] for r in table.select(classify(F.col("s"), 0.5)).collect()] == [0, 1, 1]
    assert spark.range(1).select(sigmoid(F.lit(0.0))).first()[0] == 0.5


def test_alternating_scores(spark):
    table = twelve_rows(spark).select(F.col("FLAG_VENTA").alias("label"), (0.2 + F.col("CLIENTE") * 0.6 / 11).alias("score"))
    row = E.binary_metrics(table).first()
    assert row["tn"] + row["fp"] + row["fn"] + row["tp"] == 12
    assert row["roc_auc"] == pytest.approx(21 / 36, abs=1e-4)


def table_of(spark, pairs):
    return spark.createDataFrame(pairs, "metric string, value string")


def test_quality_gate(spark):
    good = [("recall", "0.65"), ("roc_auc", "0.65"), ("f1", "0.60"), ("other", "x")]
    assert all(r["passed"] and r["approved"] for r in G.quality_gate(table_of(spark, good)).collect())
    published = [("recall", "0.1498"), ("roc_auc", "0.6123"), ("f1", "0.0966")]
    assert not any(r["passed"] for r in G.quality_gate(table_of(spark, published)).collect())
    one_bad = G.quality_gate(table_of(spark, [("recall", "0.9"), ("roc_auc", "0.1"), ("f1", "0.9")])).collect()
    assert [r["approved"] for r in one_bad] == [False] * 3
    for broken in ([("recall", "0.9"), ("f1", "0.9")], [("recall", "much"), ("roc_auc", "1"), ("f1", "1")]):
        with pytest.raises(Exception, match="metric missing or not a number"):
            G.quality_gate(table_of(spark, broken)).collect()


def test_merge_prefers_new_values(spark):
    merged = M.merge_metrics(table_of(spark, [("a", "1"), ("b", "2")]), table_of(spark, [("b", None), ("c", "4")]))
    assert {tuple(r) for r in merged.collect()} == {("a", "1"), ("b", None), ("c", "4")}


def test_rank_shares_the_lowest_place_and_first_wins(spark):
    rows = [("m", "p0", 0, "roc_auc", 0.6), ("m", "p1", 1, "roc_auc", 0.7), ("m", "p2", 2, "roc_auc", 0.7), ("m", "p3", 3, "roc_auc", 0.5)]
    table = spark.createDataFrame(rows, "model_name string, params string, position int, metric string, mean double")
    assert {r["params"]: r["rank"] for r in M.cv_rank(table).collect()} == {"p1": 1, "p2": 1, "p0": 3, "p3": 4}
    assert M.best_model(table, "roc_auc").first()["params"] == "p1"
    assert M.best_model(table, "f1").first() is None


def test_summary_uses_the_population_deviation(spark):
    values = (0.5516192221740905, 0.5550518962419208, 0.568269313273137)
    table = spark.createDataFrame([("t", "p", "test", "roc_auc", v) for v in values],
                                  "model_name string, params string, split string, metric string, value double")
    row = M.cv_summary(table).first()
    assert (row["mean"], row["std"]) == pytest.approx((0.5583134772297161, 0.007177967043046738))


def test_report_lists_every_setting(spark):
    record = R.evaluation_record(scored_from_matrix(spark, 5, 1, 2, 4), "Tree", 100, 12, 7)
    rows = {(r["section"], r["item"]): r["value"] for r in R.report_rows(record).collect()}
    assert rows["setup", "model"] == "Tree" and rows["confusion_matrix", "tp"] == "4"
    assert rows["metrics", "accuracy"] == "0.7500" and rows["minimums", "f1"] == "0.6000"
    assert record.first()["confusion_matrix"] == [[5, 1], [2, 4]]


def test_histogram_takes_no_bad_score_and_shuffles_no_scores_to_classes(spark):
    table = spark.createDataFrame([(0, 0.1), (1, 0.7), (1, 0.9), (0, 0.4)], "label int, score double")
    plan = E.score_histogram(table)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan
    assert E.score_histogram(table).agg(F.sum("count")).first()[0] == 4
    with pytest.raises(Exception, match="not finite"):
        E.score_histogram(table.unionByName(spark.createDataFrame([(1, float("nan"))], "label int, score double"))).collect()
