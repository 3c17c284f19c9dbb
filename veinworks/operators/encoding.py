"""Turning categories and labels into numbers."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import TargetEncoder
from pyspark.sql import DataFrame, functions as F

from veinworks.functions.numeric import string_columns
from veinworks.operators.columns import category_levels
from veinworks.operators.quantiles import running_totals
from veinworks.session import SMALL_ROWS, durable

MISSING_CODE = -1


def label_codes(df: DataFrame, label: str, row_id: str = "row_id") -> DataFrame:
    """(label, code): codes follow the first appearance of each label by ``row_id``."""
    firsts = (
        df.where(F.col(label).isNotNull())
        .groupBy(F.col(label).alias("label"))
        .agg(F.min(row_id).alias("first_row"))
    )
    ranked = running_totals(firsts, "first_row", {"_rank": F.lit(1)})
    return ranked.select("label", (F.col("_rank") - 1).cast("int").alias("code"))


def encode_label(df: DataFrame, label: str, row_id: str = "row_id", output: str | None = None) -> DataFrame:
    """Replace a label by its code; NULL becomes -1."""
    codes = label_codes(df, label, row_id)
    joined = df.join(codes, df[label] == codes["label"], "left")
    coded = F.coalesce(F.col("code"), F.lit(MISSING_CODE)).alias(output or label)
    kept = [df[c] for c in df.columns if c != (output or label)]
    return joined.select(*kept, coded)


def indicator_name(col: str, value: str) -> str:
    return f"{col}_{value}"


def one_hot_plan(
    df: DataFrame, cols: Sequence[str], most: int | None = 50, missing: bool = True
) -> dict[str, list[str | None]]:
    """Indicator values per column: sorted levels without the first, then missing."""
    plan: dict[str, list[str | None]] = {}
    for c, levels in category_levels(df, cols, most).items():
        if levels is not None:
            plan[c] = list(levels[1:]) + ([None] if missing else [])
    return plan


def one_hot_columns(plan: dict[str, list[str | None]]) -> list:
    out = []
    for c, values in plan.items():
        text = F.col(f"`{c}`").cast("string")
        for v in values:
            hit = text.isNull() if v is None else F.coalesce(text == F.lit(v), F.lit(False))
            out.append(hit.cast("double").alias(indicator_name(c, "nan" if v is None else v)))
    return out


def one_hot(
    df: DataFrame, cols: Sequence[str] | None = None, most: int | None = 50, missing: bool = True
) -> DataFrame:
    """Replace string columns by indicators named ``column_value``.

    The first level is left out; ``missing`` adds ``column_nan``. Columns with
    more than ``most`` levels are dropped; ``None`` keeps them all.
    """
    cols = list(cols) if cols is not None else string_columns(df)
    plan = one_hot_plan(df, cols, most, missing)
    kept = [F.col(f"`{c}`") for c in df.columns if c not in cols]
    return df.select(*kept, *one_hot_columns(plan))


def encode_categories(
    df: DataFrame,
    cols: Sequence[str],
    encoding: str = "onehot",
    label: str | None = None,
    row_id: str = "row_id",
    most: int = 50,
) -> DataFrame:
    """The three encodings by name: ``onehot``, ``label`` or ``target`` (binary label)."""
    if encoding == "onehot":
        return one_hot(df, cols, most)
    if encoding == "label":
        for c in cols:
            df = encode_label(df, c, row_id)
        return df
    if encoding == "target":
        if label is None:
            raise ValueError("target encoding needs a label column")
        for c in cols:
            df = encode_label(df, c, row_id, output=f"_{c}_code")
        codes = [f"_{c}_code" for c in cols]
        df = df.withColumns({c: F.when(F.col(c) >= 0, F.col(c).cast("double")) for c in codes})
        encoder = TargetEncoder(
            inputCols=codes, outputCols=[f"{c}_target" for c in cols], labelCol=label,
            targetType="binary", handleInvalid="keep",
        )
        return encoder.fit(df).transform(df).drop(*codes, *cols)
    raise ValueError("encoding must be one of: onehot, label, target")


def label_dictionary(df: DataFrame, label: str, row_id: str = "row_id", most: int = SMALL_ROWS) -> dict:
    """The codes as a dictionary, for tables with few labels."""
    codes = durable(label_codes(df, label, row_id))
    if codes.count() > most:
        raise ValueError(f"{label!r} has more than {most} labels; use encode_label instead")
    return {r["label"]: r["code"] for r in codes.orderBy("code").collect()}
