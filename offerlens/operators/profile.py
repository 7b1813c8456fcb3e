"""Data profiling: distributions, missing values, duplicates, full describe."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.contract import MONTH, TARGET
from offerlens.functions.scalars import col
from offerlens.operators.columns import columns_of, numeric_columns, present
from offerlens.operators.summary import summarise
from offerlens.session import stage


def percent(part: Column, whole: Column) -> Column:
    return F.round(part * 100.0 / whole, 2)


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """Rows per value as text, missing included; no rows if the column is absent."""
    if name not in df.columns:
        return df.sparkSession.createDataFrame([], "value string, count bigint")
    counts = df.groupBy(col(name).cast("string").alias("value")).agg(F.count("*").alias("count"))
    return counts.orderBy(F.desc("count"), F.asc_nulls_last("value"))


def distribution(df: DataFrame, name: str) -> DataFrame:
    """Value counts with their percentage of all rows.

    The total is summed from the counts, so the table is read once.
    """
    if name not in df.columns:
        return df.sparkSession.createDataFrame([], "value string, count bigint, percent double")
    counts = df.groupBy(col(name).cast("string").alias("value")).agg(F.count("*").alias("count"))
    total = counts.agg(F.sum("count")).scalar()
    return counts.select("value", "count", percent(F.col("count"), total).alias("percent")).orderBy(
        F.desc("count"), F.asc_nulls_last("value")
    )


def target_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    if target not in df.columns:
        raise ValueError(f"target column is absent: {target}")
    return distribution(df, target)


def month_distribution(df: DataFrame, month: str = MONTH) -> DataFrame:
    return distribution(df, month)


def _long(one_row: DataFrame, rows: Sequence[Column]) -> DataFrame:
    return one_row.select(F.inline(F.array(*rows)))


def null_report(df: DataFrame) -> DataFrame:
    """Missing values per column with their percentage, most first. One aggregate."""
    names = df.columns
    one_row = df.agg(
        F.count("*").alias("rows"),
        *[F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(names)],
    )
    rows = [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls"),
                 percent(F.col(f"n{i}"), F.col("rows")).alias("null_percent"))
        for i, c in enumerate(names)
    ]
    return _long(one_row.where(F.col("rows") > 0), rows).orderBy(F.desc("nulls"), "column")


def top_null_columns(df: DataFrame, n: int = 10) -> DataFrame:
    """The ``n`` columns with most missing values: a top-k report."""
    return null_report(df).limit(n)


def null_patterns(df: DataFrame) -> DataFrame:
    """How often each combination of missing cells occurs.

    The pattern has one digit per column, 1 where the cell is missing.
    """
    digits = [F.when(col(c).isNull(), "1").otherwise("0") for c in df.columns]
    return df.groupBy(F.concat(*digits).alias("pattern")).agg(F.count("*").alias("count"))


def negative_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Number of negative values per column, from one aggregate."""
    there = present(df, names)
    one_row = df.agg(*[F.count_if(col(c) < 0).alias(f"n{i}") for i, c in enumerate(there)])
    return _long(one_row, [
        F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("negatives")) for i, c in enumerate(there)
    ])


def duplicate_rows(df: DataFrame) -> DataFrame:
    """Rows that repeat an earlier row in full; missing equals missing.

    Only rows whose 64-bit hash occurs more than once can be duplicates. So the
    wide rows that reach the exact comparison are the suspects alone, and the
    first shuffle moves eight bytes per row. The suspects are staged, so their
    size is known when the join is planned: a short list filters the scan.
    """
    hashed = df.withColumn("row_hash", F.xxhash64(*[col(c) for c in df.columns]))
    suspects = stage(
        hashed.groupBy("row_hash").agg(F.count("*").alias("n")).where(F.col("n") > 1).select("row_hash"), "suspects"
    )
    groups = (
        hashed.join(suspects, "row_hash", "left_semi")
        .groupBy(*[col(c) for c in df.columns]).agg(F.count("*").alias("n"))
    )
    return groups.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows"))


def level_counts(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Rows per (column, value) of several columns, missing left out, in one pass."""
    cells = F.array(*[
        F.struct(F.lit(c).alias("column"), col(c).cast("string").alias("value")) for c in names
    ])
    return (
        df.select(F.inline(cells)).where(F.col("value").isNotNull())
        .groupBy("column", "value").agg(F.count("*").alias("count"))
    )


def level_summary(counts: DataFrame) -> DataFrame:
    """Filled cells, distinct values, and the most frequent value (ties: smallest) per column."""
    best = F.min_by(F.struct("value", "count"), F.struct((-F.col("count")).alias("n"), F.col("value")))
    return counts.groupBy("column").agg(
        F.sum("count").alias("filled"), F.count("*").alias("unique"), best.alias("best")
    ).select("column", "filled", "unique", F.col("best.value").alias("top"), F.col("best.count").alias("freq"))


def category_levels(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """The distinct levels of each category as text; missing is no level."""
    return level_counts(df, present(df, names)).select("column", F.col("value").alias("level"))


DESCRIBE_SHAPE = (
    "`column` string, count bigint, unique bigint, top string, freq bigint, mean double, std double, "
    "min double, q25 double, q50 double, q75 double, max double, earliest string, latest string"
)


def describe_all(df: DataFrame) -> DataFrame:
    """One row per column: count, unique, top, freq, mean, std, min, quartiles, max, earliest, latest.

    Numbers fill the numeric statistics, all other types unique, top and freq of their
    values as text, and dates and timestamps also the earliest and latest. A NaN is
    missing. The table is scanned twice, whatever its columns; a table without columns gives no rows.
    """
    spark = df.sparkSession
    numbers = numeric_columns(df)
    others = [c for c in df.columns if c not in numbers]
    known = summarise(df, numbers, {c: (0.25, 0.5, 0.75) for c in numbers}, others)
    rows = []
    for c in numbers:
        m = known.moments[c]
        rows.append((c, known.filled[c], None, None, None, m["mean"], m["std"], m["min"], *known.quantiles[c], m["max"], None, None))
    result = spark.createDataFrame(rows, DESCRIBE_SHAPE)
    if others:
        dated = columns_of(df, T.DateType, T.TimestampType, T.TimestampNTZType)
        # Dates and timestamps as text keep their order.
        ends = known.levels.groupBy("column").agg(F.min("value").alias("earliest"), F.max("value").alias("latest"))
        summary = level_summary(known.levels).join(ends, "column")
        names = spark.createDataFrame([(c, c in dated) for c in others], "`column` string, dated boolean")
        result = result.unionByName(names.join(summary, "column", "left").select(
            "column", F.coalesce("filled", F.lit(0)).alias("count"), F.coalesce("unique", F.lit(0)).alias("unique"), "top", "freq",
            *[F.when(F.col("dated"), F.col(c)).alias(c) for c in ("earliest", "latest")]), allowMissingColumns=True)
    return result


def as_map(counts: DataFrame, key: str = "value", value: str = "count") -> Column:
    """A small distribution as one map, for summary rows (the target, the months)."""
    entries = counts.agg(F.array_sort(F.collect_list(F.struct(F.coalesce(col(key), F.lit("nan")).alias("k"), col(value).alias("v")))))
    return F.map_from_entries(entries.scalar())


def validation_summary(df: DataFrame, source: str, target: str = TARGET, month: str = MONTH) -> DataFrame:
    """The validation document as one row: shape, types, duplicates, nulls, distributions."""
    gaps = [F.count_if(col(c).isNull()).alias(f"n{i}") for i, c in enumerate(df.columns)]
    counts = [F.col(f"n{i}") for i in range(len(gaps))]
    return df.agg(F.count("*").alias("rows"), *gaps).select(
        F.lit(source).alias("dataset_path"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.array(*[F.lit(c) for c in df.columns]).alias("column_names"),
        F.create_map(*[F.lit(x) for pair in df.dtypes for x in pair]).alias("dtypes"),
        duplicate_rows(df).scalar().alias("duplicated_rows"),
        sum(((n > 0).cast("long") for n in counts), F.lit(0)).alias("columns_with_nulls"),
        sum(counts, F.lit(0)).alias("total_null_values"),
        F.lit(target).alias("target"),
        as_map(value_counts(df, target)).alias("target_distribution"),
        as_map(value_counts(df, month)).alias("mes_distribution"),
    )


def ingest_record(df: DataFrame, source: str, file_hash: Column, target: str = TARGET) -> DataFrame:
    """The ingestion document as one row: source, shape, target distribution, hash, time."""
    return df.agg(F.count("*").alias("rows")).select(
        F.lit(source).alias("source"),
        F.element_at(F.split(F.lit(source), "/"), -1).alias("filename"),
        "rows",
        F.lit(len(df.columns)).alias("columns"),
        F.array(*[F.lit(c) for c in df.columns]).alias("column_names"),
        F.lit(target).alias("target"),
        as_map(value_counts(df, target)).alias("target_distribution"),
        file_hash.alias("file_hash_md5"),
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp_utc"),
    )
