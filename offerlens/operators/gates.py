"""Quality gates. A gate is a table of (check, passed, detail); ``enforce`` makes it strict."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from offerlens.contract import GATE_MINIMUMS, MONTH, RAW_COLUMNS, TARGET
from offerlens.functions.scalars import col
from offerlens.operators.columns import absent_columns, non_numeric_columns, text_columns


class GateError(ValueError):
    """A gate has a failed check."""


def _verdicts(one_row: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """Unfold a one-row frame of facts into one row per check."""
    rows = [
        F.struct(F.lit(name).alias("check"), passed.alias("passed"),
                 F.coalesce(detail.cast("string"), F.lit("")).alias("detail"))
        for name, passed, detail in checks
    ]
    return one_row.select(F.inline(F.array(*rows)))


def enforce(verdicts: DataFrame) -> None:
    """Raise with every failed check; the verdict table has a handful of rows."""
    failed = verdicts.where(~F.col("passed")).orderBy("check").collect()
    if failed:
        raise GateError("; ".join(f"{row['check']}: {row['detail']}" for row in failed))


def _names(names: Iterable[str]) -> Column:
    return F.lit(", ".join(names))


def _any_row(df: DataFrame) -> DataFrame:
    """One row saying whether ``df`` has rows; stops reading after the first."""
    return df.limit(1).agg((F.count("*") > 0).alias("has_rows"))


def dataset_gate(
    df: DataFrame,
    required: Iterable[str] = tuple(RAW_COLUMNS),
    mandatory: Iterable[str] = (TARGET, MONTH),
    target: str = TARGET,
) -> DataFrame:
    """Is this a usable raw table: rows, more than one column, the names it needs?"""
    missing = absent_columns(df, required)
    missing_mandatory = absent_columns(df, mandatory)
    return _verdicts(_any_row(df), [
        ("not_empty", F.col("has_rows"), F.lit("")),
        ("several_columns", F.lit(len(df.columns) > 1),
         F.lit("" if len(df.columns) > 1 else "one column only, check the separator")),
        ("required_columns", F.lit(not missing), _names(missing)),
        ("mandatory_columns", F.lit(not missing_mandatory), _names(missing_mandatory)),
        ("target_present", F.lit(target in df.columns), F.lit(target)),
    ])


def _null_counts(names: Sequence[str]) -> list[Column]:
    return [F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)]


def final_gate(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Is this a model-ready feature table: rows, target, no nulls, no text?"""
    return _final_verdicts(df, target, df.agg(F.count("*").alias("rows"), *_null_counts(df.columns)))


def _final_verdicts(df: DataFrame, target: str, facts: DataFrame) -> DataFrame:
    texts = text_columns(df)
    total = sum((F.col(f"n{i}") for i in range(len(df.columns))), F.lit(0).cast("long"))
    holders = F.array_join(
        F.filter(F.array(*[F.when(F.col(f"n{i}") > 0, F.lit(c)) for i, c in enumerate(df.columns)]),
                 lambda name: name.isNotNull()), ", ")
    return _verdicts(facts, [
        ("not_empty", F.col("rows") > 0, F.col("rows")),
        ("target_present", F.lit(target in df.columns), F.lit(target)),
        ("no_nulls", total == 0, holders),
        ("no_text_columns", F.lit(not texts), _names(texts)),
    ])


def _label_counts(df: DataFrame, target: str) -> list[Column]:
    label = col(target).try_cast("double")
    return [F.count_if(label.isNull()).alias("bad_labels"), F.count_if(~label.isin(0.0, 1.0)).alias("other_labels")]


def label_gate(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Can a binary model be fitted: 0/1 label without gaps, numeric complete features?"""
    if target not in df.columns:
        raise GateError(f"target_present: {target}")
    return _label_verdicts(df, target, df.agg(*_label_counts(df, target), *_null_counts(df.columns)))


def _label_verdicts(df: DataFrame, target: str, facts: DataFrame) -> DataFrame:
    features = [c for c in df.columns if c != target]
    odd = non_numeric_columns(df.select(*[col(c) for c in features]))
    nulls = sum((F.col(f"n{i}") for i, c in enumerate(df.columns) if c != target), F.lit(0).cast("long"))
    return _verdicts(facts, [
        ("label_complete", F.col("bad_labels") == 0, F.col("bad_labels")),
        ("label_binary", F.col("other_labels") == 0, F.col("other_labels")),
        ("features_numeric", F.lit(not odd), _names(odd)),
        ("features_complete", nulls == 0, nulls),
    ])


class Watch:
    """The facts of the gates, counted while a table is written.

    ``df`` is the table to write. Once a write of it has ended, the gates and the counts of
    negative values are there without another read. Read the table in a session of its own
    (``spark.newSession()``): one that has observed can no longer be shipped to tasks,
    as models do that are broadcast with their training summary.
    """

    def __init__(self, df: DataFrame, target: str = TARGET, leave_out: Sequence[str] = (), negatives: Sequence[str] = ()):
        if target not in df.columns:
            raise GateError(f"target_present: {target}")
        self._shown = df.select(*[col(c) for c in df.columns if c not in leave_out])
        self._target, self._negatives = target, [c for c in negatives if c in df.columns]
        self._seen = Observation()
        self.df = df.observe(
            self._seen, F.count(F.lit(1)).alias("rows"), *_null_counts(self._shown.columns), *_label_counts(df, target),
            *[F.count_if(col(c) < 0).alias(f"m{i}") for i, c in enumerate(self._negatives)])

    def _facts(self) -> DataFrame:
        """One row of counts; waits for the write."""
        counts = self._seen.get
        return self._shown.sparkSession.createDataFrame([tuple(counts.values())], ", ".join(f"{k} bigint" for k in counts))

    def rows(self) -> int:
        return self._seen.get["rows"]

    def final_gate(self) -> DataFrame:
        return _final_verdicts(self._shown, self._target, self._facts())

    def label_gate(self) -> DataFrame:
        return _label_verdicts(self._shown, self._target, self._facts())

    def negative_counts(self) -> DataFrame:
        """Number of negative values per watched column."""
        return self._facts().select(F.inline(F.array(*[
            F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("negatives")) for i, c in enumerate(self._negatives)])))


def signature_gate(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """Does a frame to be scored carry exactly the features the model was fitted on?"""
    missing = absent_columns(df, expected)
    extra = sorted(set(df.columns) - set(expected))
    one_row = df.sparkSession.range(1)
    return _verdicts(one_row, [
        ("no_missing_features", F.lit(not missing), _names(missing)),
        ("no_extra_features", F.lit(not extra), _names(extra)),
    ])


def quality_gate(metrics: DataFrame, minimums: Mapping[str, float] = GATE_MINIMUMS) -> DataFrame:
    """Compare a (metric, value) table with minimum values; equality passes.

    A required metric that is absent or no number is an error, not a failure.
    The result has one row per metric and the overall verdict in ``approved``.
    """
    limits = metrics.sparkSession.createDataFrame(list(minimums.items()), "metric string, minimum double")
    value = F.col("value").try_cast("double")
    checked = limits.join(metrics, "metric", "left").select(
        "metric",
        F.coalesce(value, F.raise_error(F.concat(F.lit("metric missing or not a number: "), F.col("metric")))
                   .cast("double")).alias("value"),
        "minimum",
    ).withColumn("passed", F.col("value") >= F.col("minimum"))
    # One window over everything is fine here: one row per required metric.
    everything = Window.partitionBy(F.lit(1))
    return checked.withColumn("approved", F.every("passed").over(everything))
