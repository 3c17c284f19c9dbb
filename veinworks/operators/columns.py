"""Choosing, dropping and renaming columns; filling and attaching values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from veinworks.functions.numeric import categorical_columns, numeric_columns, string_columns

# What the name cleaner writes for characters tree libraries refuse.
NAME_REPLACEMENTS = {
    "[": "_replace_bracket_open_",
    "]": "_replace_bracket_close_",
    "<": "_smaller_than_",
}

# Column groups that describe a customer in the segmentation data.
DEMOGRAPHIC_COLUMNS = [
    "Year_Birth", "Education", "Marital_Status", "Income",
    "Kidhome", "Teenhome", "Dt_Customer", "Recency",
]
PURCHASE_PREFIX = "Mnt"
CHANNEL_COLUMNS = [
    "NumWebPurchases", "NumCatalogPurchases", "NumStorePurchases", "NumWebVisitsMonth",
]
PROMOTION_COLUMNS = ["NumDealsPurchases"]
PROMOTION_PREFIX = "Accepted"
RESPONSE_COLUMN = "Response"


def describe_source(df: DataFrame) -> DataFrame:
    """Rows, columns and column names of a table."""
    names = F.array(*[F.lit(c) for c in df.columns])
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns"), names.alias("columns")
    )


def require_column(df: DataFrame, name: str) -> None:
    if name not in df.columns:
        raise ValueError(f"column {name!r} not found; available: {', '.join(df.columns)}")


def split_target(df: DataFrame, label: str, row_id: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """Features and target as two tables that share ``row_id``."""
    require_column(df, label)
    return df.drop(label), df.select(row_id, label)


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    for name in names:
        require_column(df, name)
    return df.select(*[F.col(f"`{n}`") for n in names])


def columns_by_type(df: DataFrame, kind: str) -> list[str]:
    """Column names of a kind: ``number``, ``string`` or ``categorical``."""
    kinds = {
        "number": numeric_columns,
        "string": string_columns,
        "categorical": categorical_columns,
    }
    if kind not in kinds:
        raise ValueError(f"unknown column kind {kind!r}; expected one of {sorted(kinds)}")
    return kinds[kind](df)


def columns_by_name(
    df: DataFrame, contains: str | None = None, prefixes: Sequence[str] = ()
) -> list[str]:
    """Names that contain a word (any case) or start with one of the prefixes."""
    return [
        c
        for c in df.columns
        if (contains is not None and contains.lower() in c.lower())
        or any(c.startswith(p) for p in prefixes)
    ]


def ordered_difference(names: Sequence[str], removed: Sequence[str]) -> list[str]:
    gone = set(removed)
    return [n for n in names if n not in gone]


def segmentation_columns(df: DataFrame) -> list[str]:
    """Members of the customer column groups that the table has, group by group."""
    have = df.columns
    groups = [
        DEMOGRAPHIC_COLUMNS,
        columns_by_name(df, prefixes=[PURCHASE_PREFIX]),
        CHANNEL_COLUMNS,
        PROMOTION_COLUMNS + [c for c in have if c.startswith(PROMOTION_PREFIX) or c == RESPONSE_COLUMN],
    ]
    return [c for group in groups for c in group if c in have]


def available_members(df: DataFrame, groups: Sequence[Sequence[str]]) -> list[str]:
    """Ordered intersection of named groups with the columns of a table."""
    return [c for group in groups for c in group if c in df.columns]


def column_counts(df: DataFrame, rough_distinct: Sequence[str] = ()) -> tuple[int, dict[str, int], dict[str, int]]:
    """(rows, present values per column, rough distinct counts), in one aggregation."""
    row = df.agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.count(F.col(f"`{c}`")).alias(f"c{i}") for i, c in enumerate(df.columns)],
        *[F.approx_count_distinct(F.col(f"`{c}`"), 0.02).alias(f"d{i}") for i, c in enumerate(rough_distinct)],
    ).first()
    present = {c: row[f"c{i}"] for i, c in enumerate(df.columns)}
    return row["_n"], present, {c: row[f"d{i}"] for i, c in enumerate(rough_distinct)}


def missing_fractions(df: DataFrame) -> dict[str, float]:
    n, present, _ = column_counts(df)
    return {c: (n - have) / n if n else 0.0 for c, have in present.items()}


def drop_sparse_columns(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """Keep columns whose missing share is strictly below the threshold."""
    missing = missing_fractions(df)
    return keep_columns(df, [c for c in df.columns if missing[c] < threshold])


def category_levels(
    df: DataFrame, cols: Sequence[str], most: int | None, rough: dict[str, int] | None = None
) -> dict[str, list[str] | None]:
    """Sorted distinct values per column, ``None`` where there are more than ``most``.

    A sketch first rules out high-cardinality columns, so the exact pass only
    collects sets that are known to be small. Without ``most`` every value is
    listed: for callers that need a column per value.
    """
    cols = list(cols)
    if not cols:
        return {}
    if rough is None and most is not None:
        rough = column_counts(df.select(*[F.col(f"`{c}`") for c in cols]), cols)[2]
    few = [c for c in cols if most is None or rough[c] <= 2 * most + 10]
    levels: dict[str, list[str] | None] = {c: None for c in cols}
    if few:
        sets = df.agg(
            *[F.collect_set(F.col(f"`{c}`").cast("string")).alias(f"s{i}") for i, c in enumerate(few)]
        ).first()
        for i, c in enumerate(few):
            found = sorted(sets[f"s{i}"])
            levels[c] = found if most is None or len(found) <= most else None
    return levels


def drop_wide_categories(df: DataFrame, most: int = 50) -> DataFrame:
    """Drop string columns with more distinct values than ``most`` (NULL not counted)."""
    levels = category_levels(df, string_columns(df), most)
    return df.drop(*[c for c, found in levels.items() if found is None])


def drop_incomplete_rows(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Rows with a value in every named (default: every numeric) column."""
    return df.dropna(subset=list(cols) if cols is not None else numeric_columns(df))


def drop_noise(df: DataFrame, label: str = "prediction", noise: int = -1) -> DataFrame:
    return df.where(F.col(label) != noise)


def add_suffix(df: DataFrame, col: str, suffix: str) -> DataFrame:
    return df.withColumnRenamed(col, col + suffix)


def clean_name(name: str) -> str:
    for char, words in NAME_REPLACEMENTS.items():
        name = name.replace(char, words)
    return name


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def fill_missing(df: DataFrame, values: dict[str, float | None]) -> DataFrame:
    """Replace NULL by a per-column value (columns without one stay as they are)."""
    return df.select(
        *[
            F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(values[c])).alias(c)
            if values.get(c) is not None
            else F.col(f"`{c}`")
            for c in df.columns
        ]
    )


def attach_labels(df: DataFrame, labels: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Put labels (clusters, predictions, targets) next to their rows."""
    return df.join(labels, row_id)


def keep_important(importances: DataFrame, threshold: float) -> DataFrame:
    """Features whose importance reaches the threshold."""
    return importances.where(F.col("importance") >= threshold)


def wide_to_long(df: DataFrame, cols: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """One row per (keys, column) with a double value."""
    cells = F.array(
        *[
            F.struct(F.lit(c).alias("feature"), F.col(f"`{c}`").cast("double").alias("value"))
            for c in cols
        ]
    )
    return df.select(*keys, F.explode(cells).alias("cell")).select(*keys, "cell.feature", "cell.value")


