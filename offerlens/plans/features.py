"""Building the model-ready feature table: one fit over the raw table, then a projection.

``FeatureBuilder.fit`` collects a few hundred scalars with plain aggregates.
``FeatureBuilderModel`` holds them and transforms any frame, batch or stream,
without a shuffle.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, replace

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from offerlens.contract import RENAMES, FeatureSpec
from offerlens.functions.hashing import uniform
from offerlens.functions.scalars import col
from offerlens.operators.columns import (
    add_log_features,
    coerce_numeric,
    drop_columns,
    floor_columns,
    present,
    rename_columns,
)
from offerlens.operators.summary import Summary, summarise

IMPUTATION_SHAPE = (
    "`column` string, method string, nulls_imputed bigint, mean double, std double, "
    "lower_bound double, upper_bound double, value string"
)


def prepare(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> DataFrame:
    """The part that needs no statistics: rename, coerce, floor at zero, logs."""
    renamed = coerce_numeric(rename_columns(df, RENAMES), spec.numeric)
    return add_log_features(floor_columns(renamed, spec.floor_at_zero), spec.log)


def row_key(df: DataFrame, spec: FeatureSpec) -> list[str]:
    """The columns that identify a row; all columns if the key is not in the table."""
    key = [k for k in spec.key if k in df.columns]
    return key if len(key) == len(spec.key) else df.columns


def fit_uniform(df: DataFrame, names: Sequence[str]) -> dict[str, dict]:
    """Null count, mean, sample deviation and draw range per column.

    A column without values, or with one, counts as mean or deviation zero.
    """
    there = present(df, names)
    return _uniform(summarise(df, there), there) if there else {}


def _uniform(known: Summary, names: Sequence[str]) -> dict[str, dict]:
    fitted = {}
    for c in names:
        mean, std = known.moments[c]["mean"] or 0.0, known.moments[c]["std"] or 0.0
        lower = max(0.0, mean - std)
        fitted[c] = {"nulls": known.rows - known.filled[c], "mean": mean, "std": std, "lower": lower, "upper": max(lower, mean + std)}
    return fitted


def fit_median(df: DataFrame, names: Sequence[str]) -> dict[str, dict]:
    """Null count and exact median per column; zero for a column without values."""
    there = present(df, names)
    return _median(summarise(df, quantiles={c: (0.5,) for c in there}), there) if there else {}


def _median(known: Summary, names: Sequence[str]) -> dict[str, dict]:
    return {c: {"nulls": known.rows - known.filled[c], "value": 0.0 if known.quantiles[c][0] is None else known.quantiles[c][0]} for c in names}


def fit_categories(df: DataFrame, spec: FeatureSpec) -> dict[str, dict]:
    """Null count, most frequent level (ties: smallest) and sorted levels per category.

    Every level becomes a column. Where ``spec.max_levels`` is set, a column
    with more levels is an error.
    """
    there = present(df, spec.categorical)
    return _categories(summarise(df, levels=there), there, spec) if there else {}


def _categories(known: Summary, names: Sequence[str], spec: FeatureSpec) -> dict[str, dict]:
    if not names:
        return {}
    if spec.max_levels is not None:
        wide = [r["column"] for r in known.levels.groupBy("column").count().where(F.col("count") > spec.max_levels).collect()]
        if wide:
            raise ValueError(f"more than {spec.max_levels} levels in a category: {sorted(wide)}")
    seen: dict[str, dict[str, int]] = {c: {} for c in names}
    for r in known.levels.collect():  # as many rows as the feature table gets columns
        seen[r["column"]][r["value"]] = r["count"]
    fitted = {}
    for c in names:
        counts, nulls = seen[c], known.rows - known.filled[c]
        mode = min(counts, key=lambda level: (-counts[level], level)) if counts else spec.unknown_level
        levels = set(counts) | ({mode} if nulls else set())
        fitted[c] = {"nulls": nulls, "value": mode, "levels": sorted(levels)}
    return fitted


def fit_all(df: DataFrame, spec: FeatureSpec = FeatureSpec()) -> dict[str, dict]:
    """All three fits of a prepared table from the same two scans."""
    uniform, median, categories = (present(df, names) for names in (spec.impute_uniform, spec.impute_median, spec.categorical))
    known = summarise(df, uniform, {c: (0.5,) for c in median}, categories)
    return {"uniform": _uniform(known, uniform), "median": _median(known, median), "mode": _categories(known, categories, spec)}


def impute_uniform(df: DataFrame, fitted: dict[str, dict], key: Sequence[str], seed: int) -> DataFrame:
    """Fill gaps with a uniform draw from the fitted range; the draw depends on the row key."""
    def fill(c: str, f: dict) -> Column:
        draw = F.lit(f["lower"]) + F.lit(f["upper"] - f["lower"]) * uniform(seed, c, key)
        return F.coalesce(col(c), draw)

    return df.withColumns({c: fill(c, f) for c, f in fitted.items()})


def impute_value(df: DataFrame, fitted: dict[str, dict]) -> DataFrame:
    """Fill gaps with the fitted value: a median or a mode."""
    return df.withColumns({c: F.coalesce(col(c), F.lit(f["value"])) for c, f in fitted.items()})


def one_hot(df: DataFrame, levels: dict[str, Sequence[str]]) -> DataFrame:
    """Replace each category by 0/1 columns ``<column>_<level>`` after the others.

    A missing value gives zeros in all of them. The levels are known, so this
    is a projection; a pivot would shuffle.
    """
    dummies = [
        F.coalesce((col(c).cast("string") == F.lit(level)).cast("int"), F.lit(0)).alias(f"{c}_{level}")
        for c, known in levels.items() for level in known
    ]
    return df.select(*[col(c) for c in df.columns if c not in levels], *dummies)


class FeatureBuilder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits imputation values and category levels of the feature table."""

    spec = Param(Params._dummy(), "spec", "feature specification as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec: str | None = None):
        super().__init__()
        self._setDefault(spec=json.dumps(asdict(FeatureSpec())))
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @classmethod
    def of(cls, spec: FeatureSpec) -> FeatureBuilder:
        return cls(spec=json.dumps(asdict(spec)))

    def _fit(self, dataset: DataFrame) -> FeatureBuilderModel:
        spec = _spec(self.getOrDefault(self.spec))
        state = fit_all(prepare(dataset, spec), spec)
        return FeatureBuilderModel(spec=self.getOrDefault(self.spec), state=json.dumps(state))


def _spec(text: str) -> FeatureSpec:
    return FeatureSpec(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})


class FeatureBuilderModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Turns raw rows into feature rows with the fitted values."""

    spec = Param(Params._dummy(), "spec", "feature specification as JSON", TypeConverters.toString)
    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)
    carry = Param(Params._dummy(), "carry", "identifier columns kept beside the features",
                  TypeConverters.toListString)

    @keyword_only
    def __init__(self, *, spec: str | None = None, state: str | None = None, carry: list[str] | None = None):
        super().__init__()
        self._setDefault(spec=json.dumps(asdict(FeatureSpec())), state="{}", carry=[])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def keeping(self, *names: str) -> FeatureBuilderModel:
        """The same model that also passes on identifier columns."""
        return self.copy()._set(carry=list(names))

    def fitted(self) -> dict[str, dict]:
        return json.loads(self.getOrDefault(self.state))

    def levels(self) -> dict[str, list[str]]:
        return {c: f["levels"] for c, f in self.fitted()["mode"].items()}

    def impute(self, table: DataFrame) -> DataFrame:
        """Uniform, median and mode imputation of a prepared table."""
        spec, fitted = _spec(self.getOrDefault(self.spec)), self.fitted()
        filled = impute_uniform(table, fitted["uniform"], row_key(table, spec), spec.seed)
        return impute_value(filled, {**fitted["median"], **fitted["mode"]})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        spec = _spec(self.getOrDefault(self.spec))
        encoded = one_hot(self.impute(prepare(dataset, spec)), self.levels())
        kept = self.getOrDefault(self.carry)
        return drop_columns(encoded, [c for c in spec.drop if c not in kept])

    def imputations(self, spark) -> DataFrame:
        """What was imputed per column; columns without gaps keep their values empty."""
        fitted = self.fitted()
        rows = []
        for c, f in fitted["uniform"].items():
            values = (f["mean"], f["std"], f["lower"], f["upper"]) if f["nulls"] else (None,) * 4
            rows.append((c, "random_uniform_mean_std", f["nulls"], *values, None))
        for method, key in (("median", "median"), ("mode", "mode")):
            for c, f in fitted[key].items():
                rows.append((c, method, f["nulls"], None, None, None, None, str(f["value"]) if f["nulls"] else None))
        return spark.createDataFrame(rows, IMPUTATION_SHAPE)

    def record(self, df: DataFrame, source: str) -> dict:
        """The feature document: what was done to which columns."""
        spec = _spec(self.getOrDefault(self.spec))
        return {
            "dataset_path": source, "target": spec.target, "columns": len(df.columns),
            "column_names": df.columns, "renamed": dict(RENAMES), "floored_at_zero": list(spec.floor_at_zero),
            "log_features": list(spec.log), "imputed_uniform": list(spec.impute_uniform),
            "imputed_median": list(spec.impute_median), "categorical": list(spec.categorical),
            "levels": self.levels(), "dropped": list(spec.drop), "imputation": self.fitted(),
        }


def without_key(spec: FeatureSpec, columns: Sequence[str]) -> FeatureSpec:
    """The same specification for a table identified by other columns."""
    return replace(spec, key=tuple(columns))
