"""Column expressions for numbers, dates and coordinates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

MICROS_PER_DAY = 86_400_000_000
# Multiplicative congruence used for reproducible pseudo-random order.
HASH_PRIME = 2_147_483_647
HASH_MULTIPLIER = 1_583_458_089
HASH_SECOND = 742_938_285
HASH_SEED_STEP = 1_103_515_245


def is_numeric(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.NumericType)


def numeric_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [f.name for f in df.schema.fields if is_numeric(f) and f.name not in exclude]


def string_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, T.StringType) and f.name not in exclude
    ]


def categorical_columns(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Categorical for profiling: strings and booleans."""
    return [
        f.name
        for f in df.schema.fields
        if isinstance(f.dataType, (T.StringType, T.BooleanType)) and f.name not in exclude
    ]


def nan_to_null(df: DataFrame) -> DataFrame:
    """Missing is NULL everywhere below; NaN is turned into NULL at the source."""
    return df.select(
        *[
            F.when(~F.isnan(f.name), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def elapsed_days(ts: Column, as_of: str) -> Column:
    """Whole days from ``ts`` up to ``as_of``, floored (a day not completed counts as none)."""
    micros = F.unix_micros(F.lit(as_of).cast("timestamp")) - F.unix_micros(ts.cast("timestamp"))
    return F.floor(micros / F.lit(MICROS_PER_DAY))


def parse_date(text: Column, fmt: str | None = None) -> Column:
    """Timestamp of a string, NULL where it cannot be read."""
    return F.try_to_timestamp(text, F.lit(fmt)) if fmt else F.try_to_timestamp(text)


def unparsed(text: Column, fmt: str | None = None) -> Column:
    """Whether a string is there but cannot be read as a timestamp."""
    return text.isNotNull() & parse_date(text, fmt).isNull()


def clamp(value: Column, low, high) -> Column:
    """Bring values into [low, high]; NULL stays NULL."""
    bounded = F.least(F.greatest(value, F.lit(low)), F.lit(high))
    return F.when(value.isNotNull(), bounded)


def z_score(value: Column, mean: float | None, std: float | None) -> Column:
    """Centre and scale by the population deviation; a constant column becomes 0."""
    if mean is None:
        return value
    return (value - F.lit(mean)) / F.lit(std if std else 1.0)


def min_max(value: Column, low: Column, high: Column, constant: float | None = None) -> Column:
    """Rescale to [0, 1]; a constant column becomes ``constant`` (NULL by default)."""
    scaled = F.try_divide(value - low, high - low)
    return scaled if constant is None else F.coalesce(scaled, F.lit(constant))


def percentage(part: Column, whole: Column) -> Column:
    return F.try_divide(part * F.lit(100.0), whole)


def linspace(low: float, high: float, n: int, integer: bool = False) -> list:
    """``n`` evenly spaced values, ends included; ``integer`` truncates."""
    if n < 1:
        return []
    step = (high - low) / (n - 1) if n > 1 else 0.0
    values = [low + i * step for i in range(n)]
    return [int(v) for v in values] if integer else values


def linspace_col(low: Column, high: Column, n: int) -> Column:
    """The same grid as an array column, for bounds held in a row."""
    if n == 1:
        return F.array(low)
    return F.transform(
        F.sequence(F.lit(0), F.lit(n - 1)), lambda i: low + i * (high - low) / F.lit(n - 1)
    )


def squared_distance(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """Unrolled squared Euclidean distance: stays inside generated code."""
    total = None
    for x, y in zip(a, b):
        term = (x - y) * (x - y)
        total = term if total is None else total + term
    return total


def euclidean(a: Sequence[Column], b: Sequence[Column]) -> Column:
    return F.sqrt(squared_distance(a, b))


def array_distance(a: Column, b: Column) -> Column:
    """Euclidean distance of two array columns of equal length."""
    parts = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.sqrt(F.aggregate(parts, F.lit(0.0), lambda acc, v: acc + v))


def hash_order(row_id: Column | str, seed: int = 42) -> Column:
    """Reproducible pseudo-random position of a row, from integer arithmetic only.

    The same formula can be written in any SQL dialect, so samples taken by it
    can be checked independently. Ties (row ids that differ by a multiple of
    the prime) are broken by the row id wherever the order is used.
    """
    key = F.col(row_id) if isinstance(row_id, str) else row_id
    start = F.lit(seed * HASH_SEED_STEP % HASH_PRIME)
    first = F.pmod(F.pmod(key.cast("long"), F.lit(HASH_PRIME)) * F.lit(HASH_MULTIPLIER) + start, F.lit(HASH_PRIME))
    mixed = first.bitwiseXOR(F.shiftright(first, 15))
    return F.pmod(mixed * F.lit(HASH_SECOND), F.lit(HASH_PRIME))
