"""Standardising and rescaling columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from veinworks.functions.numeric import clamp, min_max, z_score
from veinworks.operators.profile import value_range
from veinworks.operators.quantiles import exact_quantiles

# Data outside this range is scaled before clustering.
SCALE_ABOVE = 10
SCALE_BELOW = -10
# Quantiles that bound extreme values.
WINSOR_LOW, WINSOR_HIGH = 0.05, 0.95


def scale_parameters(df: DataFrame, cols: Sequence[str]) -> dict[str, tuple[float | None, float | None]]:
    """Mean and population deviation of each column, in one aggregation."""
    cols = list(cols)
    if not cols:
        return {}
    row = df.agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    return {c: (row[f"m{i}"], row[f"s{i}"]) for i, c in enumerate(cols)}


def apply_scale(df: DataFrame, params: dict[str, tuple[float | None, float | None]]) -> DataFrame:
    return df.select(
        *[
            z_score(F.col(f"`{c}`").cast("double"), *params[c]).alias(c) if c in params else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def standardise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Zero mean and unit population deviation; constants become 0."""
    return apply_scale(df, scale_parameters(df, cols))


def standardise_if_wide(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Standardise only when some value lies outside the usual range of scaled data."""
    low, high = value_range(df, cols)
    if low is not None and (high > SCALE_ABOVE or low < SCALE_BELOW):
        return standardise(df, cols)
    return df


def winsor_bounds(df: DataFrame, cols: Sequence[str]) -> dict[str, list[float | None]]:
    return exact_quantiles(df, cols, [WINSOR_LOW, WINSOR_HIGH]).get((), {})


def winsorise(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Clamp each column to its 5 % and 95 % quantiles."""
    bounds = winsor_bounds(df, cols)
    return df.select(
        *[
            clamp(F.col(f"`{c}`").cast("double"), *bounds[c]).alias(c)
            if bounds.get(c, [None])[0] is not None
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def rescale(df: DataFrame, cols: Sequence[str], constant: float | None = None) -> DataFrame:
    """Min-max scale; extremes come from one aggregation joined back as a single row."""
    cols = list(cols)
    extremes = df.agg(
        *[F.min(F.col(f"`{c}`").cast("double")).alias(f"_lo{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(f"`{c}`").cast("double")).alias(f"_hi{i}") for i, c in enumerate(cols)],
    )
    wide = df.join(F.broadcast(extremes))
    return wide.select(
        *[
            min_max(
                F.col(f"`{c}`").cast("double"), F.col(f"_lo{cols.index(c)}"), F.col(f"_hi{cols.index(c)}"), constant
            ).alias(c)
            if c in cols
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def rescaled_over_groups(profile: DataFrame, keys: Sequence[str], constant: float | None = None) -> DataFrame:
    """Min-max scale a long profile (keys, feature, value) per feature across groups."""
    w = Window.partitionBy("feature")
    return profile.select(
        *keys,
        "feature",
        min_max(F.col("value"), F.min("value").over(w), F.max("value").over(w), constant).alias("scaled"),
    )
