"""Pearson correlation of many columns in one pass, pairwise complete.

Each task turns its rows into matrices over pairs of columns: rows where both
values are present, means, squares and products around those means. They merge
without loss of digits, a row of the matrices at a time, so the result is a
table at every width and each pair uses exactly the rows that have both values.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

PARTS_PER_MERGE = 64
# Per pair of a row's column and another: rows with both, mean of either, squares of either, product.
PARTS = ("n", "mean", "other_mean", "squares", "other_squares", "product")


def pair_sums(x: np.ndarray) -> np.ndarray:
    """The parts (first axis) for all pairs of columns of ``x``, where NaN is missing."""
    here = ~np.isnan(x)
    counts = np.maximum(here.sum(0), 1)
    low, high = np.where(here, x, np.inf).min(0, initial=np.inf), np.where(here, x, -np.inf).max(0, initial=-np.inf)
    # Constant columns stay exactly constant; the others are moved to their mean.
    shift = np.where(low == high, low, np.where(here, x, 0).sum(0) / counts)
    shift = np.where(np.isfinite(shift), shift, 0)
    moved, p = np.where(here, x - shift, 0), here.astype(float)
    n, sums = p.T @ p, moved.T @ p
    whole = np.maximum(n, 1)
    squares = np.maximum((moved * moved).T @ p - sums * sums / whole, 0)
    mean = np.where(n > 0, shift[:, None] + sums / whole, 0)
    return np.stack([n, mean, mean.T, squares, squares.T, moved.T @ moved - sums * sums.T / whole])


def merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The parts of two sets of rows taken together."""
    n = a[0] + b[0]
    whole = np.maximum(n, 1)
    away, other = b[1] - a[1], b[2] - a[2]
    both = a[0] * b[0] / whole
    none_a, none_b = a[0] == 0, b[0] == 0
    mean, other_mean = a[1] + away * b[0] / whole, a[2] + other * b[0] / whole
    out = np.stack([n, mean, other_mean, a[3] + b[3] + away**2 * both, a[4] + b[4] + other**2 * both, a[5] + b[5] + away * other * both])
    return np.where(none_b, a, np.where(none_a, b, out))


def correlation_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(i, j, n, correlation) of columns i <= j by place: rows with both values, null where it is undefined.

    The diagonal is 1 for columns that vary. One scan at any width; a task
    holds six square matrices, and a merge one row of them per partition.
    """
    width = len(list(cols))
    wide = df.select(F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("v"))

    def run(batches):
        total = np.zeros((len(PARTS), width, width))
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(float).reshape(-1, width)
            total = merged(total, pair_sums(x))
        part = TaskContext.get().partitionId() // PARTS_PER_MERGE
        lists = pa.array(list(total.transpose(1, 0, 2).reshape(width, -1)), pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array(np.full(width, part)), lists], ["i", "part", "sums"])

    def add(part: pa.Table) -> pa.Table:
        total = np.zeros((len(PARTS), width))
        for row in part["sums"]:
            total = merged(total, row.values.to_numpy().reshape(len(PARTS), width))
        return pa.Table.from_arrays([part["i"][:1], part["part"][:1], pa.array([total.ravel()], pa.list_(pa.float64()))], ["i", "part", "sums"])

    schema = "i int, part long, sums array<double>"
    sums = wide.mapInArrow(run, schema).groupBy("i", "part").applyInArrow(add, schema).groupBy("i").applyInArrow(add, schema)
    at = lambda k: F.element_at("sums", F.lit(k * width + 1) + F.col("j"))
    pairs = sums.select("i", "sums", F.explode(F.sequence(F.col("i"), F.lit(width - 1))).alias("j")) if width else sums.withColumn("j", F.lit(0))
    spread = F.sqrt(at(3)) * F.sqrt(at(4))
    r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(at(5), spread))))
    return pairs.select("i", "j", at(0).cast("long").alias("n"), F.when(spread > 0, r).alias("correlation"))


def _named(cols: Sequence[str], place: str):
    return F.element_at(F.array(*[F.lit(c) for c in cols]), F.col(place) + 1)


def correlations(df: DataFrame, cols: Sequence[str]) -> dict[tuple[str, str], float | None]:
    """Correlation per ordered pair (i < j) of a few columns; ``None`` where it is undefined."""
    cols = list(cols)
    found = correlation_rows(df, cols).where("i < j").orderBy("i", "j").collect() if len(cols) > 1 else []
    return {(cols[r["i"]], cols[r["j"]]): r["correlation"] for r in found}


def correlation_pairs(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The upper triangle as rows (feature1, feature2, correlation)."""
    rows = correlation_rows(df, cols).where("i < j")
    return rows.select(_named(cols, "i").alias("feature1"), _named(cols, "j").alias("feature2"), "correlation")


def correlation_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Full matrix in long form, both halves and the diagonal."""
    rows = correlation_rows(df, cols)
    ends = F.when(F.col("i") == F.col("j"), F.array(F.struct("i", "j"))).otherwise(
        F.array(F.struct("i", "j"), F.struct(F.col("j").alias("i"), F.col("i").alias("j")))
    )
    both = rows.select("correlation", F.inline(ends))
    return both.select(_named(cols, "i").alias("feature1"), _named(cols, "j").alias("feature2"), "correlation")


def strongest_pairs(pairs: DataFrame, n: int = 10, negative: bool = False) -> DataFrame:
    """The n most positive (or most negative) pairs; undefined ones come last."""
    order = F.asc_nulls_last("correlation") if negative else F.desc_nulls_last("correlation")
    return pairs.orderBy(order, "feature1", "feature2").limit(n)


def redundant_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.9) -> list[str]:
    """Columns strongly correlated with any earlier column, itself kept or not."""
    cols = list(cols)
    if len(cols) < 2:
        return []
    strong = correlation_rows(df, cols).where("i < j").where(F.abs("correlation") > threshold)
    return [cols[r["j"]] for r in strong.select("j").distinct().orderBy("j").collect()]  # one row per column


def drop_redundant_columns(df: DataFrame, cols: Sequence[str], threshold: float = 0.9) -> DataFrame:
    return df.drop(*redundant_columns(df, cols, threshold))
