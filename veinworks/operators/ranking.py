"""Ranking, choosing and cumulative analysis of small result tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

FLAT = 1e-9


def top_n(df: DataFrame, score: str, n: int, ties: Sequence[str] = ()) -> DataFrame:
    """The n rows with the largest score; ties keep the named order."""
    return df.orderBy(F.desc_nulls_last(score), *ties).limit(n)


def best_row(df: DataFrame, score: str, ties: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """The first row with the largest score, overall or per group.

    An aggregate of structs, so no row set is sorted in one place. NULL scores
    never win over a score.
    """
    order = F.struct(
        F.col(score).isNull().alias("_missing"),
        (-F.col(score)).alias("_negated"),
        *[F.col(t).alias(f"_tie{i}") for i, t in enumerate(ties)],
    )
    picked = F.min_by(F.struct(*[F.col(c) for c in df.columns]), order).alias("_row")
    return df.groupBy(*by).agg(picked).where("_row is not null").select("_row.*")


def normalised(score: Column, by: Sequence[str] = ()) -> Column:
    """Min-max over all rows of a small table; 0 where all scores are equal."""
    w = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    low, high = F.min(score).over(w), F.max(score).over(w)
    return F.when(high - low < FLAT, F.lit(0.0)).otherwise(F.try_divide(score - low, high - low))


def combined_ranking(scores: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Average of min-max-normalised scores per feature."""
    total = None
    for p in parts:
        term = normalised(F.col(p))
        total = term if total is None else total + term
    return scores.withColumn("score", total / F.lit(float(len(parts))))


def elbow(inertias: DataFrame) -> DataFrame:
    """Largest drop of inertia from k-1 to k over a (k, inertia) table.

    A drop counts only where k-1 was tried; the smallest k is no candidate.
    """
    w = Window.orderBy("k")
    previous_k, previous = F.lag("k").over(w), F.lag("inertia").over(w)
    drop = F.when(previous_k == F.col("k") - 1, previous - F.col("inertia")).otherwise(F.lit(0.0))
    drops = inertias.select("k", "inertia", previous_k.alias("_before"), drop.alias("drop"))
    return best_row(drops.where("_before is not null").drop("_before"), "drop", ["k"])


def valid_settings(sweep: DataFrame, n_rows: int) -> DataFrame:
    """Density settings worth comparing: two clusters or more, under half noise, scored."""
    return sweep.where(
        (F.col("n_clusters") >= 2)
        & (F.col("n_noise") < 0.5 * n_rows)
        & F.col("silhouette").isNotNull()
    )


def setting_matrix(sweep: DataFrame, columns: Sequence[int]) -> DataFrame:
    """eps × min_samples matrix of silhouettes, 0 where there is none."""
    wide = sweep.groupBy("eps").pivot("min_samples", list(columns)).agg(F.first("silhouette"))
    return wide.fillna(0.0, subset=[str(c) for c in columns])
