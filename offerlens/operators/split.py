"""Exact stratified splits and folds.

Rows are put in the random order of a key hash within their class, and the
order is cut at exact quotas. Only the cut points are computed: counts per
class and hash prefix tell in which prefix a cut falls, and only the rows of
that prefix are ranked. Labelling the table is then a projection with constants
and needs no shuffle.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from offerlens.contract import N_FOLDS, SEED, TARGET, TEST_SIZE
from offerlens.functions.hashing import key_digest
from offerlens.functions.scalars import col



@dataclass(frozen=True)
class Cut:
    """The first ``rank`` rows of ``cls`` in hash order end at digest ``upto``."""

    cls: int
    rank: int
    upto: str


def class_counts(df: DataFrame, target: str = TARGET) -> dict[int, int]:
    """Rows per class, ascending."""
    rows = df.groupBy(col(target).alias("cls")).agg(F.count("*").alias("n")).collect()
    return {r["cls"]: r["n"] for r in sorted(rows, key=lambda r: r["cls"])}


def _prefix_length(rows: int) -> int:
    """Hex digits that give about as many prefixes as a prefix has rows, so both grow with the square root."""
    return max(math.ceil(math.log(max(rows, 1), 16) / 2), 1)


def find_cuts(
    df: DataFrame, target: str, digest: Column, ranks: dict[int, Sequence[int]], prefix_length: int | None = None
) -> list[Cut]:
    """Digests at the given ranks per class. ``digest`` must be unique within a class."""
    wanted = [(cls, rank) for cls, rs in ranks.items() for rank in sorted(set(rs)) if rank > 0]
    if not wanted:
        return []
    spark = df.sparkSession
    keyed = df.select(col(target).alias("cls"), digest.alias("digest"))
    length = prefix_length or _prefix_length(df.count())  # row counts alone
    prefix = F.substring("digest", 1, length)
    # A window over the prefixes of a class, not over its rows.
    order = Window.partitionBy("cls").orderBy("prefix")
    histogram = (
        keyed.groupBy("cls", prefix.alias("prefix")).agg(F.count("*").alias("n"))
        .withColumn("upto", F.sum("n").over(order))
    )
    cuts = spark.createDataFrame(wanted, "cls bigint, rank bigint")
    holders = (
        histogram.join(F.broadcast(cuts), "cls")
        .where((F.col("rank") <= F.col("upto")) & (F.col("rank") > F.col("upto") - F.col("n")))
        .select("cls", "prefix", "rank", (F.col("rank") - (F.col("upto") - F.col("n"))).alias("place"))
        .collect()
    )
    places = spark.createDataFrame([tuple(h) for h in holders], "cls bigint, prefix string, rank bigint, place bigint")
    ranked = (
        keyed.withColumn("prefix", prefix)
        .join(F.broadcast(places.select("cls", "prefix").distinct()), ["cls", "prefix"], "left_semi")
        .withColumn("place", F.row_number().over(Window.partitionBy("cls", "prefix").orderBy("digest")).cast("long"))
    )
    found = ranked.join(F.broadcast(places), ["cls", "prefix", "place"]).select("cls", "rank", "digest").collect()
    return [Cut(r["cls"], r["rank"], r["digest"]) for r in found]


def label_by_cuts(target: str, digest: Column, cuts: Sequence[Cut], names: dict[tuple[int, int], object], last: object) -> Column:
    """The name of the first cut a row does not exceed, else ``last``."""
    label = None
    for cut in sorted(cuts, key=lambda c: (c.cls, c.rank)):
        inside = (col(target) == cut.cls) & (digest <= F.lit(cut.upto))
        value = F.lit(names[cut.cls, cut.rank])
        label = F.when(inside, value) if label is None else label.when(inside, value)
    return F.lit(last) if label is None else label.otherwise(F.lit(last))


def holdout_quotas(counts: dict[int, int], test_size: float = TEST_SIZE) -> dict[int, int]:
    """Test rows per class: the train total is shared by largest remainder, the rest is test."""
    n = sum(counts.values())
    n_train = n - math.ceil(n * test_size)
    if min(counts.values(), default=0) < 2:
        raise ValueError("every class needs at least two rows")
    train = {cls: c * n_train // n for cls, c in counts.items()}
    by_remainder = sorted(counts, key=lambda cls: (-(counts[cls] * n_train % n), cls))
    for cls in by_remainder[: n_train - sum(train.values())]:
        train[cls] += 1
    return {cls: counts[cls] - train[cls] for cls in counts}


def stratified_split(
    df: DataFrame,
    key: Sequence[str],
    target: str = TARGET,
    test_size: float = TEST_SIZE,
    seed: int = SEED,
    prefix_length: int | None = None,
) -> DataFrame:
    """Add ``split`` (train / test) with exact class quotas. ``key`` is unique."""
    digest = key_digest(seed, "split", key)
    quotas = holdout_quotas(class_counts(df, target), test_size)
    cuts = find_cuts(df, target, digest, {cls: [q] for cls, q in quotas.items()}, prefix_length)
    names = {(c.cls, c.rank): "test" for c in cuts}
    return df.withColumn("split", label_by_cuts(target, digest, cuts, names, "train"))


def fold_quotas(counts: dict[int, int], folds: int = N_FOLDS) -> dict[int, list[int]]:
    """Rows per class and fold when class-sorted rows are dealt out one by one."""
    quotas, start = {}, 0
    for cls, n in counts.items():
        quotas[cls] = [len(range((fold - start) % folds, n, folds)) for fold in range(folds)]
        start += n
    return quotas


def stratified_folds(
    df: DataFrame,
    key: Sequence[str],
    target: str = TARGET,
    folds: int = N_FOLDS,
    seed: int = SEED,
    prefix_length: int | None = None,
) -> DataFrame:
    """Add ``fold`` (0 .. folds-1) with class shares as even as possible."""
    digest = key_digest(seed, "fold", key)
    counts = class_counts(df, target)
    if min(counts.values(), default=0) < folds:
        raise ValueError(f"every class needs at least {folds} rows")
    ranks, names = {}, {}
    for cls, quotas in fold_quotas(counts, folds).items():
        upto = 0
        ranks[cls] = []
        for fold, quota in enumerate(quotas[:-1]):
            upto += quota
            ranks[cls].append(upto)
            names[cls, upto] = fold
    cuts = find_cuts(df, target, digest, ranks, prefix_length)
    return df.withColumn("fold", label_by_cuts(target, digest, cuts, names, folds - 1))


def split_distribution(df: DataFrame, target: str = TARGET) -> DataFrame:
    """Rows per split and class, with the total over both splits."""
    per_split = df.groupBy("split", col(target).alias("class")).agg(F.count("*").alias("count"))
    both = per_split.groupBy("class").agg(F.sum("count").alias("count")).select(F.lit("total").alias("split"), "class", "count")
    return per_split.unionByName(both)


def balanced_weights(df: DataFrame, target: str = TARGET) -> dict[int, float]:
    """Weight per class, ``n / (classes * n_class)``."""
    counts = class_counts(df, target)
    n = sum(counts.values())
    return {cls: n / (len(counts) * c) for cls, c in counts.items()}


def weight_column(target: str, weights: dict[int, float]) -> Column:
    value = F.lit(None).cast("double")
    for cls, weight in weights.items():
        value = F.when(col(target) == cls, F.lit(weight)).otherwise(value)
    return value
