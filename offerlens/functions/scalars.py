"""Column expressions used across stages. All stay inside the JVM."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.contract import NULL_TOKENS


def col(name: str) -> Column:
    """A top-level column by its exact name (names may hold spaces, dots or ``%``)."""
    return F.col(f"`{name}`")


def null_tokens(text: Column, tokens: Iterable[str] = NULL_TOKENS) -> Column:
    """Texts that mean "missing" become NULL, other texts stay as they are."""
    return F.when(~text.isin(*tokens), text)


def nan_to_null(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


# A cast alone would take Java's own spellings too, such as 12D, 5f or 0x1p3.
DECIMAL_TEXT = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?|nan)\s*$"


def to_numeric(value: Column) -> Column:
    """Number, or NULL where the text is no decimal number. NaN counts as missing."""
    return nan_to_null(F.when(value.cast("string").rlike(DECIMAL_TEXT), value.try_cast("double")))


def as_double(value: Column, kind: T.DataType) -> Column:
    """A column of any type as a number. Only texts need the pattern of decimal numbers."""
    if isinstance(kind, (T.DoubleType, T.FloatType)):
        return nan_to_null(value.cast("double"))
    return value.cast("double") if isinstance(kind, T.NumericType) else to_numeric(value)


def floor_zero(value: Column) -> Column:
    """Negative becomes zero and missing stays missing (``greatest`` would drop the NULL)."""
    return F.when(value < 0, F.lit(0.0)).otherwise(value)


def log_feature(value: Column) -> Column:
    return F.log1p(floor_zero(value))


def sigmoid(margin: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-margin))


def classify(score: Column, threshold: float) -> Column:
    """1 where the score reaches the threshold, itself included."""
    return (score >= F.lit(threshold)).cast("int")


def ratio(part: Column, whole: Column) -> Column:
    """``part / whole``; zero where there is nothing to divide by."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(part.cast("double") / whole)


def whole(value: Column) -> Column:
    """A double rounded half away from zero, as ``F.round`` gives it, without a decimal number per value."""
    rest = value % 1.0
    return value - rest + F.when(rest >= 0.5, 1.0).when(rest <= -0.5, -1.0).otherwise(0.0)
