"""Principal components on centred, scaled columns."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Correlation
from pyspark.sql import DataFrame, Window, functions as F

from veinworks.operators.columns import drop_incomplete_rows
from veinworks.operators.scaling import scale_parameters
from veinworks.session import from_rows

# Automatic feature count looks at ten components and 80 % variance.
MAX_COMPONENTS = 10
VARIANCE_SHARE = 0.8
MIN_AUTO_FEATURES = 5


def fit_components(df: DataFrame, cols: Sequence[str], k: int) -> tuple[np.ndarray, np.ndarray]:
    """(k × columns loadings, explained variance shares) of standardised columns.

    Standardised columns have their correlation matrix as covariance, which is
    one distributed pass; only that columns × columns matrix is decomposed here.
    Constant columns carry no variance. The largest loading of each component
    is made positive.
    """
    cols = list(cols)
    params = scale_parameters(df, cols)
    varying = [i for i, c in enumerate(cols) if params[c][1]]
    matrix = np.zeros((len(cols), len(cols)))
    if len(varying) > 1:
        wide = df.select(*[F.col(f"`{cols[i]}`").cast("double").alias(f"x{i}") for i in varying])
        vectors = VectorAssembler(inputCols=wide.columns, outputCol="v").transform(wide).select("v")
        matrix[np.ix_(varying, varying)] = np.nan_to_num(Correlation.corr(vectors, "v").first()[0].toArray())
    elif varying:
        matrix[varying[0], varying[0]] = 1.0
    values, vectors = np.linalg.eigh(matrix)
    order = np.argsort(values)[::-1][:k]
    loadings = vectors[:, order].T
    signs = np.sign(loadings[np.arange(len(order)), np.abs(loadings).argmax(axis=1)])
    loadings = loadings * np.where(signs == 0, 1.0, signs)[:, None]
    total = values.clip(min=0).sum()
    share = values[order].clip(min=0) / total if total > 0 else np.zeros(len(order))
    return loadings, share


def component_table(spark, cols: Sequence[str], loadings: np.ndarray, share: np.ndarray) -> DataFrame:
    rows = [
        (i + 1, c, float(loadings[i, j]), float(share[i]))
        for i in range(len(share))
        for j, c in enumerate(cols)
    ]
    return from_rows(spark, rows, "component int, feature string, loading double, explained double")


def project(
    df: DataFrame, cols: Sequence[str], k: int = 2, keep: Sequence[str] = ()
) -> DataFrame:
    """Coordinates ``pc1 .. pck`` of each row (columns standardised first)."""
    loadings, _ = fit_components(df, cols, k)
    params = scale_parameters(df, cols)
    return _coordinates(df, cols, loadings, params, keep)


def _coordinates(df, cols, loadings, params, keep):
    out = []
    for i in range(loadings.shape[0]):
        total = F.lit(0.0)
        for j, c in enumerate(cols):
            mean, std = params[c]
            if std:
                weight = float(loadings[i, j]) / std
                total = total + (F.col(f"`{c}`").cast("double") - F.lit(mean)) * F.lit(weight)
        out.append(total.alias(f"pc{i + 1}"))
    return df.select(*[F.col(c) for c in keep], *out)


def component_overview(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> dict[str, DataFrame]:
    """Complete rows projected onto two components, with the explained shares."""
    complete = drop_incomplete_rows(df, cols)
    loadings, share = fit_components(complete, cols, 2)
    params = scale_parameters(complete, cols)
    key = list(keep) or [c for c in ("row_id",) if c in df.columns]
    return {
        "components": component_table(df.sparkSession, cols, loadings, share),
        "projection": _coordinates(complete, cols, loadings, params, key),
    }


def cumulative_share(explained: DataFrame) -> DataFrame:
    """Running explained variance over a (component, explained) table."""
    w = Window.orderBy("component").rowsBetween(Window.unboundedPreceding, 0)
    return explained.select("component", "explained", F.sum("explained").over(w).alias("cumulative"))


def auto_feature_count(share: Sequence[float], n_features: int) -> int:
    """First component count past 80 % variance, at most half, at least five features."""
    passed = [i for i, v in enumerate(np.cumsum(share)) if v > VARIANCE_SHARE]
    wanted = passed[0] + 1 if passed else 1
    return max(min(wanted, n_features // 2), MIN_AUTO_FEATURES)


def auto_feature_count_table(explained: DataFrame, n_features: int) -> DataFrame:
    """The same rule on a (component, explained) table."""
    cumulative = cumulative_share(explained)
    first = F.coalesce(F.min(F.when(F.col("cumulative") > VARIANCE_SHARE, F.col("component"))), F.lit(1))
    chosen = F.greatest(F.least(first, F.lit(n_features // 2)), F.lit(MIN_AUTO_FEATURES))
    return cumulative.agg(chosen.cast("int").alias("n_features"))
