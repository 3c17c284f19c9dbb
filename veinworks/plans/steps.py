"""Feature selection as a Spark ML estimator, to chain with the preparation step."""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F

from veinworks.operators.selection import PROBLEMS, select_features, select_unsupervised
from veinworks.functions.numeric import numeric_columns


class _SelectionParams(Params):
    rowId = Param(Params._dummy(), "rowId", "row key column", TypeConverters.toString)
    label = Param(Params._dummy(), "label", "target column, '' for none", TypeConverters.toString)
    problem = Param(Params._dummy(), "problem", "classification, regression or clustering", TypeConverters.toString)
    nFeatures = Param(Params._dummy(), "nFeatures", "features to keep, 0 for automatic", TypeConverters.toInt)


class SelectFeatures(Estimator, _SelectionParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learns which numeric columns to keep."""

    @keyword_only
    def __init__(self, *, rowId="row_id", label="", problem="clustering", nFeatures=0):
        super().__init__()
        self._setDefault(rowId="row_id", label="", problem="clustering", nFeatures=0)
        self._set(**self._input_kwargs)
        if self.getOrDefault("problem") not in PROBLEMS:
            raise ValueError(f"problem must be one of: {', '.join(PROBLEMS)}")

    def _fit(self, df: DataFrame) -> "FeatureSubset":
        row_id, label = self.getOrDefault("rowId"), self.getOrDefault("label")
        wanted = self.getOrDefault("nFeatures") or None
        if self.getOrDefault("problem") == "clustering":
            chosen = select_unsupervised(df, numeric_columns(df, [row_id, label]), wanted)
        else:
            chosen = select_features(df, label, self.getOrDefault("problem"), wanted, row_id=row_id)["features"]
        return FeatureSubset().keeping([c for c in (row_id, label) if c in df.columns], chosen)


class FeatureSubset(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Keeps the key, the target and the selected features."""

    keys = Param(Params._dummy(), "keys", "columns kept besides features", TypeConverters.toListString)
    features = Param(Params._dummy(), "features", "selected features", TypeConverters.toListString)

    def keeping(self, keys: list[str], features: list[str]) -> "FeatureSubset":
        self._set(keys=keys, features=features)
        return self

    def _transform(self, df: DataFrame) -> DataFrame:
        names = self.getOrDefault("keys") + self.getOrDefault("features")
        return df.select(*[F.col(f"`{c}`") for c in names if c in df.columns])
