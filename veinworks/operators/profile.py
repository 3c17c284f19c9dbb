"""Table profiling: the numbers behind an exploratory overview."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql import types as T

from veinworks.functions.numeric import categorical_columns, percentage
from veinworks.operators.columns import wide_to_long
from veinworks.operators.correlation import correlation_matrix, correlation_pairs, strongest_pairs
from veinworks.operators.quantiles import box_statistics, exact_quantiles
from veinworks.session import from_rows

TOP_CATEGORIES = 10


def profiled_numeric(df: DataFrame, exclude: Sequence[str] = ()) -> list[str]:
    """Integers and floating-point columns, as profiling counts them."""
    kinds = (T.LongType, T.IntegerType, T.DoubleType, T.FloatType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in exclude]


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, sample std, min, quartiles, max and missing values, one row per column."""
    cols = list(cols)
    aggs = [F.count(F.lit(1)).alias("n")]
    for i, c in enumerate(cols):
        v = F.col(f"`{c}`").cast("double")
        aggs += [
            F.count(v).alias(f"count{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
        ]
    row = df.agg(*aggs).first()
    quartiles = exact_quantiles(df, cols, [0.25, 0.5, 0.75]).get((), {})
    out = []
    for i, c in enumerate(cols):
        q1, q2, q3 = quartiles[c]
        missing = row["n"] - row[f"count{i}"]
        share = 100.0 * missing / row["n"] if row["n"] else None
        out.append(
            (c, row[f"count{i}"], row[f"mean{i}"], row[f"std{i}"], row[f"min{i}"], q1, q2, q3,
             row[f"max{i}"], missing, share)
        )
    return from_rows(
        df.sparkSession,
        out,
        "feature string, count long, mean double, std double, min double, p25 double, "
        "p50 double, p75 double, max double, missing long, missing_pct double",
    )


def missing_values(df: DataFrame) -> DataFrame:
    """Columns with gaps, most gaps first: count and percentage of all rows."""
    counted = df.agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.col(f"`{c}`")).alias(c) for c in df.columns]
    )
    cells = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").alias("have")) for c in df.columns])
    return (
        counted.select("n", F.explode(cells).alias("cell"))
        .select(
            "cell.feature",
            (F.col("n") - F.col("cell.have")).alias("missing"),
            percentage(F.col("n") - F.col("cell.have"), F.col("n")).alias("missing_pct"),
        )
        .where("missing > 0")
        .orderBy(F.desc("missing"), "feature")
    )


def distinct_counts(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values per column, NULL not counted.

    The exact form groups (column, value) pairs, so partial counts are merged on
    the map side and no task sees a whole column.
    """
    cols = list(cols)
    if not exact:
        row = df.agg(*[F.approx_count_distinct(F.col(f"`{c}`")).alias(f"d{i}") for i, c in enumerate(cols)])
        cells = F.array(
            *[F.struct(F.lit(c).alias("feature"), F.col(f"d{i}").alias("n_distinct")) for i, c in enumerate(cols)]
        )
        return row.select(F.inline(cells))
    cells = F.array(
        *[F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("string").alias("value")) for c in cols]
    )
    return (
        df.select(F.explode(cells).alias("cell"))
        .select("cell.feature", "cell.value")
        .groupBy("feature", "value")
        .count()
        .groupBy("feature")
        .agg(F.count("value").alias("n_distinct"))
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """Frequency of every value; NULL gets no row but counts in the percentage."""
    total = df.agg(F.count(F.lit(1)).alias("n"))
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(F.col(col).alias("value"))
        .agg(F.count(F.lit(1)).alias("count"))
        .join(F.broadcast(total))
        .select("value", "count", percentage(F.col("count"), F.col("n")).alias("percentage"))
    )


def top_values(df: DataFrame, col: str, n: int = TOP_CATEGORIES) -> DataFrame:
    """The n most frequent values, ties by value."""
    return value_counts(df, col).orderBy(F.desc("count"), "value").limit(n)


def histogram(df: DataFrame, cols: Sequence[str], bins: int = 10) -> DataFrame:
    """Equal-width bins between minimum and maximum of each column.

    A value on the upper edge belongs to the last bin; a constant column has
    one bin.
    """
    cols = list(cols)
    long = wide_to_long(df, cols).where("value is not null")
    row = df.agg(
        *[F.min(F.col(f"`{c}`").cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(f"`{c}`").cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    ranges = from_rows(
        df.sparkSession,
        [(c, row[f"lo{i}"], row[f"hi{i}"]) for i, c in enumerate(cols)],
        "feature string, lo double, hi double",
    )
    width = (F.col("hi") - F.col("lo")) / F.lit(float(bins))
    slot = F.coalesce(F.floor(F.try_divide(F.col("value") - F.col("lo"), width)), F.lit(0))
    binned = (
        long.join(F.broadcast(ranges), "feature")
        .withColumn("bin", F.least(slot, F.lit(bins - 1)).cast("int"))
        .groupBy("feature", "bin", "lo", "hi")
        .agg(F.count(F.lit(1)).alias("count"))
    )
    return binned.select(
        "feature",
        "bin",
        (F.col("lo") + F.col("bin") * width).alias("bin_low"),
        (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_high"),
        "count",
    )


def value_range(df: DataFrame, cols: Sequence[str]) -> tuple[float | None, float | None]:
    """Smallest and largest number over all columns."""
    row = df.agg(
        *[F.min(F.col(f"`{c}`").cast("double")).alias(f"lo{i}") for i, c in enumerate(cols)],
        *[F.max(F.col(f"`{c}`").cast("double")).alias(f"hi{i}") for i, c in enumerate(cols)],
    ).first()
    lows = [row[f"lo{i}"] for i in range(len(cols)) if row[f"lo{i}"] is not None]
    highs = [row[f"hi{i}"] for i in range(len(cols)) if row[f"hi{i}"] is not None]
    return (min(lows) if lows else None, max(highs) if highs else None)


def profile(
    df: DataFrame,
    numeric: Sequence[str] | None = None,
    categorical: Sequence[str] | None = None,
    exclude: Sequence[str] = ("row_id",),
    bins: int = 10,
    most_numeric: int | None = None,
    most_categorical: int | None = None,
) -> dict[str, DataFrame]:
    """Every profiling table by name; projection onto two components included.

    Histograms, boxes and value counts cover all columns, or the first
    ``most_numeric`` and ``most_categorical`` ones.
    """
    from veinworks.operators.components import component_overview

    numeric = list(numeric) if numeric is not None else profiled_numeric(df, exclude)
    categorical = list(categorical) if categorical is not None else categorical_columns(df, exclude)
    tables = {"missing_values": missing_values(df)}
    if numeric:
        shown = numeric[:most_numeric]
        tables["numerical_summary"] = describe_numeric(df, numeric)
        tables["histograms"] = histogram(df, shown, bins)
        tables["boxes"] = box_statistics(df, shown)
    if len(numeric) > 1:
        pairs = correlation_pairs(df, numeric)
        tables["correlation_matrix"] = correlation_matrix(df, numeric)
        tables["top_positive_correlations"] = strongest_pairs(pairs)
        tables["top_negative_correlations"] = strongest_pairs(pairs, negative=True)
    for c in categorical[:most_categorical]:
        tables[f"value_counts_{c}"] = value_counts(df, c)
    if len(numeric) > 2:
        overview = component_overview(df, numeric)
        tables["components"] = overview["components"]
        tables["projection"] = overview["projection"]
    return tables
