"""Frames that several registered queries start from, all derived from the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlens.contract import CUSTOMER, MONTH, TARGET
from offerlens.functions.hashing import uniform
from offerlens.functions.scalars import col
from offerlens.operators.columns import rename_columns
from offerlens.operators.split import stratified_split
from offerlens.plans.features import FeatureBuilder, FeatureBuilderModel, prepare
from offerlens.session import stage
from offerlens.sources.panel import staged_panel

KEY = (MONTH, CUSTOMER)
KEY_SQL = ['"MES"', '"CLIENTE"']

_made: dict[tuple, object] = {}


def once(spark: SparkSession, folder: str, name: str, make: Callable[[], object]):
    """A stage result made once per application, as a file handed from stage to stage is."""
    key = (spark.sparkContext.applicationId, folder, name)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def raw(spark: SparkSession, folder: str) -> DataFrame:
    return staged_panel(spark, folder)


def panel(spark: SparkSession, folder: str) -> DataFrame:
    return rename_columns(raw(spark, folder))


def prepared(spark: SparkSession, folder: str) -> DataFrame:
    return prepare(raw(spark, folder))


def builder(spark: SparkSession, folder: str) -> FeatureBuilderModel:
    return once(spark, folder, "builder", lambda: FeatureBuilder().fit(raw(spark, folder)))


def feature_split(spark: SparkSession, folder: str) -> DataFrame:
    """The feature table with its identifier and a train / test column, staged."""
    def make() -> DataFrame:
        features = stage(builder(spark, folder).keeping(CUSTOMER).transform(raw(spark, folder)), "features")
        return stage(stratified_split(features, KEY), "split")

    return once(spark, folder, "split", make)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    """Panel rows with a score that leans towards the label: a stand-in for a model."""
    draw = uniform(42, "score", KEY)
    return panel(spark, folder).select(
        MONTH, CUSTOMER, col(TARGET).cast("int").alias("label"),
        F.round(draw * 0.6 + col(TARGET) * 0.25, 4).alias("score"),
    )


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles to a fixed number of decimals, as sums differ in the last bits between engines."""
    return df.select(*[
        F.round(col(f.name), digits).alias(f.name) if isinstance(f.dataType, T.DoubleType) else col(f.name)
        for f in df.schema.fields
    ])
