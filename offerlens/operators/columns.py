"""Operators on column names and types. None of them starts a job."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.contract import RENAMES
from offerlens.functions.scalars import as_double, col, floor_zero, nan_to_null


def clean_column_names(df: DataFrame) -> DataFrame:
    """Drop byte-order marks and surrounding blanks from the names."""
    return df.toDF(*[name.replace("﻿", "").strip() for name in df.columns])


def rename_columns(df: DataFrame, names: Mapping[str, str] = RENAMES) -> DataFrame:
    """Rename what is there; names that are absent are ignored."""
    return df.withColumnsRenamed(dict(names))


def absent_columns(df: DataFrame, names: Iterable[str]) -> list[str]:
    return sorted(set(names) - set(df.columns))


def drop_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop what is there, in one projection."""
    unwanted = set(names)
    return df.select(*[col(c) for c in df.columns if c not in unwanted])


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    return [name for name in names if name in df.columns]


def coerce_numeric(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Turn columns into doubles; text that is no number becomes NULL."""
    kinds = df.schema
    return df.withColumns({c: as_double(col(c), kinds[c].dataType) for c in present(df, names)})


def floor_columns(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: floor_zero(col(c)) for c in present(df, names)})


def add_log_features(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Floor the source columns at zero and append ``<name>_LOG = log1p(source)``."""
    there = present(df, names)
    floored = floor_columns(coerce_numeric(df, there), there)
    return floored.withColumns({f"{c}_LOG": F.log1p(col(c)) for c in there})


def columns_of(df: DataFrame, *kinds: type[T.DataType]) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def text_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.StringType)


def numeric_columns(df: DataFrame) -> list[str]:
    return columns_of(df, T.NumericType)


def non_numeric_columns(df: DataFrame) -> list[str]:
    """Columns a model cannot take: neither number nor boolean."""
    return [f.name for f in df.schema.fields if not isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def nan_as_null(df: DataFrame) -> DataFrame:
    """One notion of missing: NaN in any floating column becomes NULL."""
    floating = columns_of(df, T.DoubleType, T.FloatType)
    return df.withColumns({c: nan_to_null(col(c)) for c in floating}) if floating else df


def _nan_free(value: Column, kind: T.DataType) -> Column:
    """``value`` with NULL for NaN at every depth of arrays, maps and structs."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(value)
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda x: _nan_free(x, kind.elementType))
    if isinstance(kind, T.MapType):
        return F.transform_values(value, lambda _, x: _nan_free(x, kind.valueType))
    if isinstance(kind, T.StructType):
        inner = F.struct(*[_nan_free(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields])
        return F.when(value.isNotNull(), inner)
    return value


def json_rows(df: DataFrame, name: str = "json") -> DataFrame:
    """Each row as a JSON object in which missing numbers are ``null``, nested ones included."""
    fields = F.struct(*[_nan_free(col(f.name), f.dataType).alias(f.name) for f in df.schema.fields])
    return df.select(F.to_json(fields, {"ignoreNullFields": "false"}).alias(name))
