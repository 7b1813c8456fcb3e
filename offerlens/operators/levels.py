"""One-hot vectors of categories with any number of levels: no column per level, no levels on the driver."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.scalars import col
from offerlens.session import stage


def level_index(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """(column, value, index, position): every level of the categories, sorted, as a staged table.

    ``index`` counts from 0 within a column, ``position`` over all columns in
    the order of ``names``. Levels are sorted in ranges; only a count per
    range, and a first position per column, meet in one task. Missing values are no level.
    """
    cells = F.inline(F.array(*[
        F.struct(F.lit(i).alias("at"), F.lit(c).alias("column"), col(c).cast("string").alias("value")) for i, c in enumerate(names)]))
    found = df.select(cells).where("value is not null").distinct()
    levels = stage(found.repartitionByRange("at", "value").withColumn("part", F.spark_partition_id()), "levels")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = levels.groupBy("part").agg(F.count("*").alias("n")).select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy("part").orderBy("at", "value")
    placed = stage(levels.join(starts, "part").select(
        "column", "value", (F.col("start") + F.row_number().over(inside) - 1).alias("position")), "levels-placed")
    first = placed.groupBy("column").agg(F.min("position").alias("first"))  # a row per column
    return placed.join(F.broadcast(first), "column").select(
        "column", "value", (F.col("position") - F.col("first")).alias("index"), "position")


def one_hot_vector(df: DataFrame, index: DataFrame, names: Sequence[str], output: str = "levels") -> DataFrame:
    """``df`` with a sparse 0/1 vector over the positions of ``index``; a missing or unknown level has zeros in its part.

    The index is joined column by column: Spark broadcasts the levels of a
    column where they are few, and splits hot levels where it shuffles.
    """
    sizes = {r["column"]: r["n"] for r in index.groupBy("column").agg(F.count("*").alias("n")).collect()}  # a row per column
    there = [c for c in names if c in sizes]
    if not there:
        return df.withColumn(output, array_to_vector(F.array().cast("array<double>")))
    codes, parts = [f"__{output}_code_{c}" for c in there], [f"__{output}_part_{c}" for c in there]
    coded = df
    for c, code in zip(there, codes):
        key = f"{code}_value"
        levels = index.where(F.col("column") == c).select(F.col("value").alias(key), F.col("index").cast("double").alias(code))
        coded = coded.join(levels, col(c).cast("string") == col(key), "left").drop(key)
    coded = coded.withColumns({code: F.coalesce(col(code), F.lit(float(sizes[c]))) for c, code in zip(there, codes)})
    # The encoder learns the sizes from one row of largest codes; a code beyond them is its dropped last level.
    largest = df.sparkSession.createDataFrame([tuple(sizes[c] - 1.0 for c in there)], ", ".join(f"`{code}` double" for code in codes))
    encoder = OneHotEncoder(inputCols=codes, outputCols=parts, handleInvalid="keep", dropLast=True).fit(largest)
    assembler = VectorAssembler(inputCols=parts, outputCol=output)
    return assembler.transform(encoder.transform(coded)).drop(*codes, *parts)
