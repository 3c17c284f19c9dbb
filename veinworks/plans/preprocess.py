"""The composite preparation step as a Spark ML estimator.

Fitting runs a handful of aggregations and keeps only small decisions (column
names, medians, bounds, levels, means); applying the model is one projection.
"""

from __future__ import annotations

import json

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, functions as F

from veinworks.functions.numeric import clamp, elapsed_days, numeric_columns, string_columns, z_score
from veinworks.operators.columns import category_levels, clean_name, column_counts
from veinworks.operators.correlation import redundant_columns
from veinworks.operators.encoding import MISSING_CODE, indicator_name, label_dictionary
from veinworks.operators.quantiles import medians
from veinworks.operators.scaling import scale_parameters, winsor_bounds

MAX_LABELS = 10_000


class _PreprocessParams(Params):
    rowId = Param(Params._dummy(), "rowId", "row key column", TypeConverters.toString)
    label = Param(Params._dummy(), "label", "target column, '' for none", TypeConverters.toString)
    missingThreshold = Param(
        Params._dummy(), "missingThreshold", "drop columns with this missing share or more", TypeConverters.toFloat
    )
    maxCategories = Param(
        Params._dummy(), "maxCategories", "drop categories with more levels", TypeConverters.toInt
    )
    correlationThreshold = Param(
        Params._dummy(), "correlationThreshold", "drop the later of two columns above this", TypeConverters.toFloat
    )
    asOf = Param(Params._dummy(), "asOf", "moment dates are measured to", TypeConverters.toString)
    scaleIndicators = Param(
        Params._dummy(), "scaleIndicators", "treat indicators as numbers", TypeConverters.toBoolean
    )


class Preprocess(Estimator, _PreprocessParams, DefaultParamsReadable, DefaultParamsWritable):
    """label codes → drop sparse columns → dates to days → fill medians → clamp
    extremes → indicators → drop correlated columns → standardise → clean names."""

    @keyword_only
    def __init__(
        self,
        *,
        rowId="row_id",
        label="",
        missingThreshold=0.9,
        maxCategories=50,
        correlationThreshold=0.9,
        asOf="",
        scaleIndicators=False,
    ):
        super().__init__()
        self._setDefault(
            rowId="row_id", label="", missingThreshold=0.9, maxCategories=50,
            correlationThreshold=0.9, asOf="", scaleIndicators=False,
        )
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame) -> "PreprocessModel":
        row_id, label = self.getOrDefault("rowId"), self.getOrDefault("label")
        state: dict = {"row_id": row_id, "label": None, "label_codes": None}
        if label and label in df.columns:
            state["label"] = label
            state["label_codes"] = [
                [str(k), v] for k, v in label_dictionary(df, label, row_id, MAX_LABELS).items()
            ]
        features = df.select(*[F.col(f"`{c}`") for c in df.columns if c not in (row_id, label)])
        n, present, rough = column_counts(features, string_columns(features))
        threshold = self.getOrDefault("missingThreshold")
        kept = [c for c in features.columns if not n or (n - present[c]) / n < threshold]
        state["dates"] = [c for c in kept if "date" in c.lower()]
        if state["dates"] and not self.getOrDefault("asOf"):
            raise ValueError("asOf is needed for date columns: " + ", ".join(state["dates"]))
        state["as_of"] = self.getOrDefault("asOf")
        state["kept"] = kept

        staged = features.select(*[_dated(features, c, state).alias(_dated_name(c, state)) for c in kept])
        numbers = numeric_columns(staged)
        state["numbers"] = numbers
        state["medians"] = medians(staged, numbers) if numbers else {}
        filled = staged.select(
            *[
                F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(state["medians"][c])).alias(c)
                if c in numbers else F.col(f"`{c}`")
                for c in staged.columns
            ]
        )
        state["bounds"] = winsor_bounds(filled, numbers) if numbers else {}
        text = string_columns(staged)
        levels = category_levels(staged, text, self.getOrDefault("maxCategories"), rough)
        state["levels"] = {c: v[1:] for c, v in levels.items() if v is not None}
        state["text"] = text

        model = PreprocessModel()._with_state({**state, "dropped": [], "scale": {}})
        before_filter = model._project(df, final=False)
        measured = list(numbers)
        if self.getOrDefault("scaleIndicators"):
            measured += _indicator_names(state)
        state["dropped"] = redundant_columns(before_filter, measured, self.getOrDefault("correlationThreshold"))
        remaining = [c for c in measured if c not in state["dropped"]]
        state["scale"] = {c: list(v) for c, v in scale_parameters(before_filter, remaining).items()}
        return PreprocessModel()._with_state(state)


def _dated_name(c: str, state: dict) -> str:
    return f"{c}_days" if c in state["dates"] else c


def _dated(df: DataFrame, c: str, state: dict) -> Column:
    col = F.col(f"`{c}`")
    if c not in state["dates"]:
        return col
    if dict(df.dtypes)[c] == "string":
        col = F.try_to_timestamp(col)
    return elapsed_days(col, state["as_of"])


def _indicator_names(state: dict) -> list[str]:
    return [indicator_name(c, v) for c, vs in state["levels"].items() for v in [*vs, "nan"]]


class PreprocessModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Fitted preparation: the decisions are kept as one JSON parameter."""

    state = Param(Params._dummy(), "state", "fitted decisions", TypeConverters.toString)

    def _with_state(self, state: dict) -> "PreprocessModel":
        self._set(state=json.dumps(state))
        return self

    @property
    def decisions(self) -> dict:
        return json.loads(self.getOrDefault("state"))

    def _transform(self, df: DataFrame) -> DataFrame:
        return self._project(df, final=True)

    def _project(self, df: DataFrame, final: bool) -> DataFrame:
        s = self.decisions
        numbers, out = set(s["numbers"]), []
        for source in s["kept"]:
            name = _dated_name(source, s)
            if name in s["text"] or name in s["dropped"]:
                continue
            col = _dated(df, source, s)
            if name in numbers:
                col = F.coalesce(col.cast("double"), F.lit(s["medians"].get(name)))
                low, high = s["bounds"].get(name, [None, None])
                if low is not None:
                    col = clamp(col, low, high)
            if final and name in s["scale"]:
                col = z_score(col, *s["scale"][name])
            out.append(col.alias(clean_name(name) if final else name))
        for c, values in s["levels"].items():
            text = F.col(f"`{c}`").cast("string")
            for v in [*values, None]:
                name = indicator_name(c, "nan" if v is None else v)
                if name in s["dropped"]:
                    continue
                hit = text.isNull() if v is None else F.coalesce(text == F.lit(v), F.lit(False))
                hit = hit.cast("double")
                if final and name in s["scale"]:
                    hit = z_score(hit, *s["scale"][name])
                out.append(hit.alias(clean_name(name) if final else name))
        if s["label"] is not None and s["label"] in df.columns:
            out.append(self._label_column(s).alias(s["label"]))
        key = [F.col(s["row_id"])] if s["row_id"] in df.columns else []
        return df.select(*key, *out)

    @staticmethod
    def _label_column(s: dict) -> Column:
        if not s["label_codes"]:
            return F.lit(MISSING_CODE)
        pairs = [F.lit(x) for pair in s["label_codes"] for x in pair]
        found = F.try_element_at(F.create_map(*pairs), F.col(s["label"]).cast("string"))
        return F.coalesce(found, F.lit(MISSING_CODE))


def preprocess(df: DataFrame, label: str | None = None, as_of: str = "", **params) -> DataFrame:
    """Fit and apply in one call."""
    return Preprocess(label=label or "", asOf=as_of, **params).fit(df).transform(df)
