"""Evaluation of scored rows (label 0/1, score, threshold).

Every metric follows from one small table: positives and negatives per distinct
score. It is one aggregate with map-side combining, whatever the number of rows.
All functions take optional group columns, so many models, folds or segments
are evaluated in the same pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.contract import THRESHOLD
from offerlens.functions.scalars import classify, col, ratio
from offerlens.operators.running import ROWS_PER_RANGE, running_totals
from offerlens.session import stage

N_BINS = 30


def score_counts(
    scored: DataFrame, groups: Sequence[str] = (), label: str = "label", score: str = "score"
) -> DataFrame:
    """Positives and negatives per distinct score; a missing or infinite score is an error."""
    value = col(score).cast("double")
    finite = value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))
    checked = F.when(finite, value).otherwise(F.raise_error("a score is missing or not finite").cast("double"))
    return scored.groupBy(*groups, checked.alias("score")).agg(
        F.count_if(col(label) == 1).alias("pos"), F.count_if(col(label) == 0).alias("neg")
    )


def _totals(counts: DataFrame, groups: Sequence[str], threshold: float) -> DataFrame:
    """TN, FP, FN, TP per group from score counts."""
    hit = classify(F.col("score"), threshold) == 1

    def total(name: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(name))), F.lit(0))

    return counts.groupBy(*groups).agg(
        total("neg", ~hit).alias("tn"), total("neg", hit).alias("fp"),
        total("pos", ~hit).alias("fn"), total("pos", hit).alias("tp"),
    )


def confusion_totals(scored: DataFrame, groups: Sequence[str] = (), threshold: float = THRESHOLD) -> DataFrame:
    return _totals(score_counts(scored, groups), groups, threshold)


def confusion_matrix(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Four rows (actual, predicted, count), zero where nothing falls."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    return confusion_totals(scored, threshold=threshold).select(F.inline(F.array(*[
        F.struct(F.lit(a).alias("actual"), F.lit(p).alias("predicted"), F.col(c).alias("count"))
        for a, p, c in cells
    ])))


def _basic_metrics() -> dict[str, Column]:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return {
        "accuracy": ratio(tp + tn, tn + fp + fn + tp),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def roc_auc(
    scored: DataFrame, groups: Sequence[str] = (), rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Exact area under the ROC curve, ties counted half; NULL if a class is absent."""
    return _auc(stage(score_counts(scored, groups), "scores"), groups, rows_per_range)


def _auc(counts: DataFrame, groups: Sequence[str], rows_per_range: int = ROWS_PER_RANGE) -> DataFrame:
    ranked = running_totals(counts, "score", ["pos", "neg"], groups, rows_per_range)
    # Pairs won by a negative's better-scored positives, counted twice to stay whole.
    wins = F.col("neg") * (2 * F.col("above_pos") + F.col("pos"))
    pairs = F.first("all_pos") * F.first("all_neg")
    return ranked.groupBy(*groups).agg(
        F.when(pairs > 0, F.sum(wins.cast("decimal(38,0)")).cast("double") / 2.0 / pairs.cast("double")).alias("roc_auc")
    )


def binary_metrics(
    scored: DataFrame,
    groups: Sequence[str] = (),
    threshold: float = THRESHOLD,
    digits: int | None = 4,
) -> DataFrame:
    """accuracy, precision, recall, f1 of class 1 and roc_auc, one row per group."""
    counts = stage(score_counts(scored, groups), "scores")
    totals = _totals(counts, groups, threshold)
    auc = _auc(counts, groups)
    both = totals.join(auc, list(groups)) if groups else totals.withColumn("roc_auc", auc.scalar())
    metrics = {**_basic_metrics(), "roc_auc": F.col("roc_auc")}
    if digits is not None:
        metrics = {name: F.round(value, digits) for name, value in metrics.items()}
    return both.select(*groups, "tn", "fp", "fn", "tp", *[v.alias(k) for k, v in metrics.items()])


def metric_rows(metrics: DataFrame, names: Sequence[str], groups: Sequence[str] = ()) -> DataFrame:
    """One row per metric instead of one column per metric."""
    return metrics.select(*groups, F.inline(F.array(*[
        F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in names
    ])))


def classification_report(scored: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """precision, recall, f1 and support per class, then accuracy and the two averages."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))

    def of_class(hit: Column, wrong: Column, lost: Column) -> list[Column]:
        return [ratio(hit, hit + wrong), ratio(hit, hit + lost), ratio(2 * hit, 2 * hit + wrong + lost),
                (hit + lost).cast("double")]

    def row(name: str, values: Sequence[Column]) -> Column:
        return F.struct(F.lit(name).alias("class"),
                        *[v.alias(n) for v, n in zip(values, ("precision", "recall", "f1", "support"))])

    zero, one = of_class(tn, fn, fp), of_class(tp, fp, fn)
    everything = (tn + fp + fn + tp).cast("double")
    accuracy = ratio(tn + tp, tn + fp + fn + tp)
    macro = [(a + b) / 2.0 for a, b in zip(zero[:3], one[:3])]
    weighted = [ratio(a * zero[3] + b * one[3], everything) for a, b in zip(zero[:3], one[:3])]
    return confusion_totals(scored, threshold=threshold).select(F.inline(F.array(
        row("0", zero), row("1", one), row("accuracy", [accuracy] * 4),
        row("macro avg", [*macro, everything]), row("weighted avg", [*weighted, everything]),
    )))


def roc_curve(
    scored: DataFrame, drop_intermediate: bool = True, rows_per_range: int = ROWS_PER_RANGE
) -> DataFrame:
    """Points (threshold, fpr, tpr) by falling threshold, starting at (0, 0).

    ``drop_intermediate`` leaves out points on a straight line between their
    neighbours, as these do not change the curve. The rate of a class without rows is NULL.
    """
    counts = stage(score_counts(scored), "scores")
    ranked = running_totals(counts, "score", ["pos", "neg"], (), rows_per_range)
    points = ranked.select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("above_neg") + F.col("neg"), F.col("all_neg")).alias("fpr"),
        F.try_divide(F.col("above_pos") + F.col("pos"), F.col("all_pos")).alias("tpr"),
        ((F.col("above_pos") + F.col("above_neg")) == 0).alias("is_first"),
        F.col("next_pos").isNull().alias("is_last"),
        ((F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))).alias("bends"),
    )
    if drop_intermediate:
        points = points.where(F.col("is_first") | F.col("is_last") | F.col("bends"))
    start = scored.sparkSession.range(1).select(
        F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.select("threshold", "fpr", "tpr").unionByName(start)


def score_histogram(scored: DataFrame, bins: int = N_BINS) -> DataFrame:
    """Rows per class in equal bins over that class's own score range; empty bins are kept.

    A missing or infinite score is an error. Rows of other labels than 0 and 1 have no class.
    """
    classes = F.array(*[F.struct(F.lit(k).alias("label"), F.col(c).alias("n")) for k, c in ((0, "neg"), (1, "pos"))])
    counts = score_counts(scored).select("score", F.inline(classes)).where("n > 0")
    # Two rows at most, so the join is a broadcast.
    span = counts.groupBy("label").agg(F.min("score").alias("lo"), F.max("score").alias("hi")).select(
        "label",
        F.when(F.col("lo") == F.col("hi"), F.col("lo") - 0.5).otherwise(F.col("lo")).alias("lo"),
        F.when(F.col("lo") == F.col("hi"), F.col("hi") + 0.5).otherwise(F.col("hi")).alias("hi"),
    )
    place = F.floor((F.col("score") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins) + 1
    filled = (
        counts.join(F.broadcast(span), "label")
        .groupBy("label", F.least(place, F.lit(bins)).cast("int").alias("bin")).agg(F.sum("n").alias("n"))
    )
    edges = span.withColumn("bin", F.explode(F.sequence(F.lit(1), F.lit(bins))))
    width = (F.col("hi") - F.col("lo")) / bins
    return edges.join(filled, ["label", "bin"], "left").select(
        "label", "bin",
        (F.col("lo") + (F.col("bin") - 1) * width).alias("bin_from"),
        (F.col("lo") + F.col("bin") * width).alias("bin_to"),
        F.coalesce("n", F.lit(0)).alias("count"),
    )
