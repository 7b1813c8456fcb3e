"""Counts, moments, exact quantiles and levels of many columns in two scans.

The first scan is one aggregate: rows, filled cells, moments, and a mergeable
sketch for every column with quantiles. A sketch brackets a quantile between two
values. The second scan counts what lies below every bracket, the distinct values
inside, and the levels of the categories. Brackets that may hold more distinct
values than one task should rank are narrowed by another scan first, and a bracket that
missed its quantile is widened and counted again, so the results are exact for tables of every size.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.functions.scalars import col, nan_to_null
from offerlens.session import stage

MAX_RANKED = 200_000  # distinct values that one task ranks
SKETCH_SIZE = 8192
MARGIN = 0.001  # twice the rank error of a sketch of that size


@dataclass
class Summary:
    """What is known about a table after two scans. ``levels`` has a row per column and value that occurs, as text."""

    rows: int
    filled: dict[str, int]
    moments: dict[str, dict[str, float | None]]
    quantiles: dict[str, list[float | None]]
    levels: DataFrame | None


@dataclass
class _Bracket:
    """Where one quantile lies: ``low <= value <= high``."""

    column: str
    ranks: tuple[int, int]  # 0-based positions of the two neighbours among the filled values
    filled: int
    margin: float
    low: float = -math.inf
    high: float = math.inf

    def inside(self, value: Column) -> Column:
        return F.when(value.between(F.lit(self.low), F.lit(self.high)), value)


def summarise(
    df: DataFrame, moments: Sequence[str] = (), quantiles: Mapping[str, Sequence[float]] | None = None,
    levels: Sequence[str] = (), max_ranked: int = MAX_RANKED,
) -> Summary:
    """Facts about the named columns. NaN is a missing number; a column without values has no moments and no quantiles."""
    quantiles = quantiles or {}
    numbers = list(dict.fromkeys([*moments, *quantiles]))
    value = {c: _number(df, c) for c in numbers}
    names = list(dict.fromkeys([*numbers, *levels]))
    place = {c: i for i, c in enumerate(names)}
    facts = [F.count(F.lit(1)).alias("rows"), *[F.count(value.get(c, col(c))).alias(f"n{place[c]}") for c in names]]
    for c in moments:
        facts += [f(value[c]).alias(f"{k}{place[c]}") for k, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))]
    facts += [F.kll_sketch_agg_double(value[c], F.lit(SKETCH_SIZE)).alias(f"k{place[c]}") for c in quantiles]
    row = df.agg(*facts).first()  # a row of counts, and sketches of bounded size
    filled = {c: row[f"n{place[c]}"] for c in names}
    brackets = {(c, p): _Bracket(c, _neighbours(p, filled[c]), filled[c], MARGIN) for c, ps in quantiles.items() if filled[c] for p in ps}
    _tighten(df.sparkSession, [(b, row[f"k{place[b.column]}"], 0, b.filled) for b in brackets.values()])
    statistics, counts = _finish(df, list(brackets.values()), list(levels), value, max_ranked)
    found: dict[str, list[float | None]] = {}
    for c, ps in quantiles.items():
        found[c] = []
        for p in ps:
            lower, upper = statistics[c, brackets[c, p].ranks] if filled[c] else (None, None)
            share = p * (filled[c] - 1) - math.floor(p * (filled[c] - 1)) if filled[c] else 0.0
            found[c].append(lower * (1 - share) + upper * share if filled[c] else None)
    return Summary(row["rows"], filled, {c: {k: row[f"{k}{place[c]}"] for k in ("mean", "std", "min", "max")} for c in moments}, found, counts)


def exact_quantiles(
    df: DataFrame, columns: Sequence[str], probabilities: Sequence[float], max_ranked: int = MAX_RANKED,
) -> dict[str, list[float | None]]:
    """Linearly interpolated quantiles per column; None for a column without values."""
    return summarise(df, quantiles={c: probabilities for c in columns}, max_ranked=max_ranked).quantiles if columns else {}


def _number(df: DataFrame, name: str) -> Column:
    kind = df.schema[name].dataType
    return nan_to_null(col(name).cast("double")) if isinstance(kind, (T.DoubleType, T.FloatType, T.StringType)) else col(name).cast("double")


def _neighbours(p: float, n: int) -> tuple[int, int]:
    lower = math.floor(p * (n - 1))
    return lower, min(lower + 1, n - 1)


def _tighten(spark: SparkSession, known: list[tuple[_Bracket, bytes, int, int]]) -> None:
    """Set the ends of brackets by sketches of ``n`` values, the least of which has place ``first``."""
    picks = []
    for b, sketch, first, n in known:
        low, high = (b.ranks[0] - first - 1) / n - b.margin, (b.ranks[1] - first + 2) / n + b.margin
        ends = F.array(*[F.lit(float(min(max(x, 0.0), 1.0))) for x in (low, high)])
        picks.append(F.kll_sketch_get_quantile_double(F.lit(bytes(sketch)), ends))
    if picks:
        for (b, *_), (low, high) in zip(known, spark.range(1).select(F.array(*picks)).first()[0]):
            b.low, b.high = (low, high) if b.margin < 0.5 else (-math.inf, math.inf)


def _finish(df: DataFrame, brackets: list[_Bracket], levels: list[str], value: dict[str, Column], max_ranked: int):
    """The values at the ranks of every bracket, and the staged level counts."""
    max_ranked = max(max_ranked, 64)  # a bracket cannot get smaller than a few values
    found: dict[tuple, tuple[float, float]] = {}
    pending, counts = brackets, None
    while pending or (levels and counts is None):
        _narrow(df, [b for b in pending if 2 * b.margin * b.filled > max_ranked], value, max_ranked)
        cells = stage(_cells(df, pending, levels if counts is None else [], value), "cells")
        if counts is None and levels:
            first = len(_zones(pending))
            named = F.element_at(F.array(*[F.lit(c) for c in levels]), F.col("id") - first + 1)
            counts = cells.where(F.col("id") >= first).select(named.alias("column"), F.col("text").alias("value"), F.col("n").alias("count"))
        found.update(_pick(cells, pending))
        pending = [b for b in pending if (b.column, b.ranks) not in found]
        for b in pending:  # the sketch was off by more than its margin
            b.margin *= 4
        _restart(df, pending, value)
    return found, counts


def _restart(df: DataFrame, brackets: list[_Bracket], value: dict[str, Column]) -> None:
    if brackets:
        row = df.agg(*[F.kll_sketch_agg_double(value[b.column], F.lit(SKETCH_SIZE)) for b in brackets]).first()
        _tighten(df.sparkSession, [(b, row[i], 0, b.filled) for i, b in enumerate(brackets)])


def _narrow(df: DataFrame, brackets: list[_Bracket], value: dict[str, Column], max_ranked: int) -> None:
    """Tighten brackets until few distinct values lie inside or they no longer get smaller."""
    while brackets:
        facts = []
        for i, b in enumerate(brackets):
            inside = b.inside(value[b.column])
            facts += [F.count_if(value[b.column] < F.lit(b.low)).alias(f"b{i}"), F.count(inside).alias(f"n{i}"),
                      F.approx_count_distinct(inside).alias(f"d{i}"), F.kll_sketch_agg_double(inside, F.lit(SKETCH_SIZE)).alias(f"k{i}")]
        row = df.agg(*facts).first()
        before = [(b.low, b.high) for b in brackets]
        wide = [i for i in range(len(brackets)) if row[f"d{i}"] > max_ranked]
        _tighten(df.sparkSession, [(brackets[i], row[f"k{i}"], row[f"b{i}"], row[f"n{i}"]) for i in wide])
        brackets = [brackets[i] for i in wide if (brackets[i].low, brackets[i].high) != before[i]]


def _cells(df: DataFrame, brackets: list[_Bracket], levels: list[str], value: dict[str, Column]) -> DataFrame:
    """(id, zone, number, text, n): rows per zone of each column with quantiles, per value in the odd zones, and per level.

    The brackets of a column, merged where they meet, are its odd zones; what lies
    before, between and after them is counted as a whole.
    """
    made = []
    for i, (c, zones) in enumerate(_zones(brackets).items()):
        zone = F.when(value[c].isNull(), F.lit(None).cast("int"))
        for j, (low, high) in enumerate(zones):
            zone = zone.when(value[c] < F.lit(low), 2 * j).when(value[c] <= F.lit(high), 2 * j + 1)
        zone = zone.otherwise(2 * len(zones))
        made.append(F.struct(F.lit(i).alias("id"), zone.alias("zone"), F.when(zone % 2 == 1, value[c]).alias("number"), F.lit(None).cast("string").alias("text")))
    for j, c in enumerate(levels, len(made)):
        zone = F.when(col(c).isNotNull(), 0)
        made.append(F.struct(F.lit(j).alias("id"), zone.alias("zone"), F.lit(None).cast("double").alias("number"), as_text(df, c).alias("text")))
    return df.select(F.inline(F.array(*made))).where("zone is not null").groupBy("id", "zone", "number", "text").agg(F.count(F.lit(1)).alias("n"))


def _zones(brackets: list[_Bracket]) -> dict[str, list[tuple[float, float]]]:
    """The brackets of every column in order, overlapping ones merged."""
    zones: dict[str, list[tuple[float, float]]] = {}
    for b in sorted(brackets, key=lambda b: b.low):
        known = zones.setdefault(b.column, [])
        if known and b.low <= known[-1][1]:
            known[-1] = (known[-1][0], max(known[-1][1], b.high))
        else:
            known.append((b.low, b.high))
    return zones


def as_text(df: DataFrame, name: str) -> Column:
    """Any column as text; what has no cast to text goes as JSON."""
    kind = df.schema[name].dataType
    return F.to_json(F.struct(col(name))) if isinstance(kind, T.VariantType) else col(name).cast("string")


def _pick(cells: DataFrame, brackets: list[_Bracket]) -> dict[tuple, tuple[float, float]]:
    """The two values of every bracket that holds both ranks."""
    if not brackets:
        return {}
    columns = list(_zones(brackets))
    wanted = F.array(*[F.array(*[F.lit(r) for r in sorted({r for b in brackets if b.column == c for r in b.ranks})]) for c in columns])
    upto = F.sum("n").over(Window.partitionBy("id").orderBy("zone", "number"))
    placed = cells.where(F.col("id") < len(columns)).select("id", "zone", "number", upto.alias("upto"))
    ranked = placed.select("*", F.explode(F.element_at(wanted, F.col("id") + 1)).alias("rank")).where(F.col("upto") > F.col("rank"))
    rows = ranked.groupBy("id", "rank").agg(F.min(F.struct("zone", "number"))["number"].alias("value")).collect()
    at = {(columns[r["id"]], r["rank"]): r["value"] for r in rows}
    found = {(b.column, b.ranks): tuple(at.get((b.column, r)) for r in b.ranks) for b in brackets}
    return {key: pair for key, pair in found.items() if None not in pair}
