"""Running totals along an ordered column without one task seeing all rows.

The rows are cut into ranges of the ordered column. Totals per range are few,
so their running sum is cheap and gives every range its starting value; inside
a range a plain window does the rest.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from offerlens.functions.scalars import col

ROWS_PER_RANGE = 50_000


def _ranges(df: DataFrame, order: str, rows_per_range: int) -> DataFrame:
    """Add ``range``: 0, 1, ... in ascending order, each with a bounded number of rows."""
    n = max(math.ceil(df.count() / rows_per_range), 2)
    cuts = df.approxQuantile(order, [i / n for i in range(1, n)], 1 / (4 * n)) or [0.0]
    splits = [-math.inf, *sorted(set(cuts)), math.inf]
    cut = Bucketizer(splits=splits, inputCol=order, outputCol="range").transform(df)
    return cut.withColumn("range", F.col("range").cast("int"))


def running_totals(
    df: DataFrame,
    order: str,
    sums: Sequence[str],
    groups: Sequence[str] = (),
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add, for every row, totals of ``sums`` over the rows with a larger ``order`` value.

    ``df`` has one row per group and value of ``order`` (a finite double), so no
    value is heavier than another. Adds per sum column ``above_<name>`` (rows
    strictly above) and ``all_<name>`` (the whole group), and ``next_<name>``:
    the value of the row just below, NULL on the last one. ``df`` is read
    several times, so callers pass a staged table.
    """
    ranged = _ranges(df, order, rows_per_range)
    keys = [*groups, "range"]
    first = F.max_by(F.struct(*sums), order)
    per_range = ranged.groupBy(*keys).agg(
        first.alias("head"), *[F.sum(c).alias(f"sum_{c}") for c in sums]
    )
    falling = Window.partitionBy(*groups, F.lit(0)).orderBy(F.desc("range"))
    before = falling.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups, F.lit(0))
    offsets = per_range.select(
        *keys,
        F.lead("head").over(falling).alias("next_head"),
        *[F.coalesce(F.sum(f"sum_{c}").over(before), F.lit(0)).alias(f"before_{c}") for c in sums],
        *[F.sum(f"sum_{c}").over(whole).alias(f"all_{c}") for c in sums],
    )
    inside = Window.partitionBy(*keys).orderBy(F.desc(order))
    upto = inside.rowsBetween(Window.unboundedPreceding, -1)
    joined = ranged.join(offsets, keys)
    return joined.select(
        *[col(c) for c in df.columns],
        *[(F.col(f"before_{c}") + F.coalesce(F.sum(c).over(upto), F.lit(0))).alias(f"above_{c}") for c in sums],
        *[F.col(f"all_{c}") for c in sums],
        *[F.coalesce(F.lead(c).over(inside), F.col(f"next_head.{c}")).alias(f"next_{c}") for c in sums],
    )
