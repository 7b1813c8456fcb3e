"""A classifier that oversamples and weighs its rows while it is fitted, and only then."""

from __future__ import annotations

import threading
from collections.abc import Iterator, Sequence

from pyspark import keyword_only
from pyspark.ml.base import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasSeed
from pyspark.ml.util import DefaultParamsReader, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from offerlens.contract import SEED, SMOTE_NEIGHBOURS, SMOTE_RATIO
from offerlens.functions.scalars import col
from offerlens.plans.rows import fit_kept, training_rows
from offerlens.session import stage


class ResampledClassifier(Estimator, HasSeed, MLReadable, MLWritable):
    """Fits ``estimator`` on oversampled rows and returns its model, which scores rows as they are.

    The features (a vector or an array), the label and, where the inner estimator has one, the
    weight take the names the inner estimator is set to. ``keyCol`` identifies a row:
    all draws are hashes of it. Works as a stage of a ``Pipeline`` and inside a
    ``CrossValidator``, whose parameter maps may name parameters of the inner estimator, which then
    share one resampling, and of this one.
    """

    estimator = Param(Params._dummy(), "estimator", "classifier fitted on the resampled rows")
    keyCol = Param(Params._dummy(), "keyCol", "column that identifies a row", TypeConverters.toString)
    ratio = Param(Params._dummy(), "ratio", "minority rows per majority row after oversampling", TypeConverters.toFloat)
    neighbours = Param(Params._dummy(), "neighbours", "nearest neighbours to draw from", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, estimator: Estimator | None = None, keyCol: str = "key", ratio: float = SMOTE_RATIO,
                 neighbours: int = SMOTE_NEIGHBOURS, seed: int = SEED):
        super().__init__()
        self._setDefault(keyCol="key", ratio=SMOTE_RATIO, neighbours=SMOTE_NEIGHBOURS, seed=SEED)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def getEstimator(self) -> Estimator:
        return self.getOrDefault(self.estimator)

    def resampled(self, dataset: DataFrame) -> DataFrame:
        """The rows the inner estimator sees: features, label and weight under its names."""
        inner = self.getEstimator()
        features, label = inner.getOrDefault(inner.featuresCol), inner.getOrDefault(inner.labelCol)
        vector = isinstance(dataset.schema[features].dataType, VectorUDT)
        points = stage(dataset.select(
            col(self.getOrDefault(self.keyCol)).cast("string").alias("key"), col(label).cast("int").alias("label"),
            (vector_to_array(col(features)) if vector else col(features).cast("array<double>")).alias("features")), "points")
        rows = training_rows(points, self.getOrDefault(self.ratio), self.getOrDefault(self.neighbours), self.getSeed())
        named = [F.col("label").alias(label), F.col("x").alias(features)]
        if inner.hasParam("weightCol") and inner.isDefined("weightCol"):
            named.append(F.col("weight").alias(inner.getOrDefault("weightCol")))
        return rows.select(*named)

    def _fit(self, dataset: DataFrame) -> Model:
        return fit_kept(self.getEstimator(), self.resampled(dataset))

    def fitMultiple(self, dataset: DataFrame, paramMaps: Sequence[dict]) -> Iterator[tuple[int, Model]]:
        """One resampling for all maps with the same own parameters."""
        groups: dict[tuple, list[int]] = {}
        for i, params in enumerate(paramMaps):
            own = tuple(sorted((p.name, repr(v)) for p, v in params.items() if p.parent == self.uid))
            groups.setdefault(own, []).append(i)

        def fitted(places: list[int]) -> Iterator[tuple[int, Model]]:
            this = self.copy({p: v for p, v in paramMaps[places[0]].items() if p.parent == self.uid})
            rows = this.resampled(dataset).persist()
            try:
                for i in places:
                    yield i, this.getEstimator().copy(paramMaps[i]).fit(rows)
            finally:
                rows.unpersist()

        return _Shared(pair for places in groups.values() for pair in fitted(places))

    def copy(self, extra: dict | None = None) -> ResampledClassifier:
        that = Params.copy(self, extra)
        return that._set(estimator=self.getEstimator().copy(extra)) if self.isSet(self.estimator) else that

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Shared:
    """An iterator that several threads may ask in turn, as a cross-validation does."""

    def __init__(self, pairs: Iterator[tuple[int, Model]]):
        self._pairs, self._lock = pairs, threading.Lock()

    def __iter__(self) -> _Shared:
        return self

    def __next__(self) -> tuple[int, Model]:
        with self._lock:
            return next(self._pairs)


class _Writer(MLWriter):
    def __init__(self, instance: ResampledClassifier):
        super().__init__()
        self.instance = instance

    def saveImpl(self, path: str) -> None:
        own = {p.name: v for p, v in self.instance._paramMap.items() if p.name != "estimator"}
        DefaultParamsWriter.saveMetadata(self.instance, path, self.sparkSession, paramMap=own)
        self.instance.getEstimator().write().save(f"{path}/estimator")


class _Reader(MLReader):
    def __init__(self, cls: type[ResampledClassifier]):
        super().__init__()
        self.cls = cls

    def load(self, path: str) -> ResampledClassifier:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        instance = self.cls(estimator=DefaultParamsReader.loadParamsInstance(f"{path}/estimator", self.sparkSession))
        instance._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(instance, metadata)
        return instance
