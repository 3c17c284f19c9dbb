"""Classification quality from (label, score, prediction) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from veinworks.operators.quantiles import running_totals
from veinworks.operators.ranking import best_row

# Metric names of the leaderboard.
METRICS = ["Accuracy", "Precision", "Recall", "F1 Score", "ROC AUC"]


def metric_name(name: str) -> str:
    """Leaderboard spelling of a metric name in any case."""
    for metric in METRICS:
        if name.strip().lower() == metric.lower():
            return metric
    raise ValueError(f"unknown metric {name!r}; expected one of: {', '.join(METRICS)}")


def class_counts(df: DataFrame, label: str) -> DataFrame:
    return df.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("count"))


def confusion_matrix(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    """Counts and row shares for every pair of classes, empty cells included."""
    cells = df.groupBy(F.col(label).alias("label"), F.col(prediction).alias("prediction")).agg(
        F.count(F.lit(1)).alias("count")
    )
    classes = cells.select(F.explode(F.array("label", "prediction")).alias("label")).distinct()
    # One row holding the classes: the grid is classes × classes, never rows × rows.
    listed = classes.agg(F.array_sort(F.collect_set("label")).alias("all"))
    grid = listed.select(F.explode("all").alias("label"), "all").select(
        "label", F.explode("all").alias("prediction")
    )
    full = grid.join(cells, ["label", "prediction"], "left").select(
        "label", "prediction", F.coalesce("count", F.lit(0)).alias("count")
    )
    total = F.sum("count").over(Window.partitionBy("label"))
    return full.withColumn("share", F.try_divide(F.col("count") * 1.0, total))


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part * 1.0, whole), F.lit(0.0))


def threshold_metrics(
    df: DataFrame, label: str = "label", prediction: str = "prediction", by: Sequence[str] = ()
) -> DataFrame:
    """Accuracy, precision, recall and F1 of class 1, in one aggregation."""
    y, p = F.col(label), F.col(prediction)
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_if(y == p).alias("_right"),
        F.count_if((y == 1) & (p == 1)).alias("_tp"),
        F.count_if(p == 1).alias("_pred"),
        F.count_if(y == 1).alias("_pos"),
    )
    return counts.select(
        *by,
        _ratio(F.col("_right"), F.col("_n")).alias("accuracy"),
        _ratio(F.col("_tp"), F.col("_pred")).alias("precision"),
        _ratio(F.col("_tp"), F.col("_pos")).alias("recall"),
        _ratio(F.col("_tp") * 2, F.col("_pred") + F.col("_pos")).alias("f1"),
    )


def _per_score(df, label, score, by):
    """Positives and negatives per distinct score: ties shrink before anything is sorted."""
    return df.groupBy(*by, F.col(score).cast("double").alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg")
    )


def _cumulative(per_score: DataFrame, by: Sequence[str]) -> DataFrame:
    """Counts at or above each score, per group."""
    totals = {"tp": F.col("pos"), "fp": F.col("neg")}
    return running_totals(per_score, "score", totals, descending=True, by=by)


def roc_curve(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """(threshold, fpr, tpr) at every distinct score, with the origin at threshold NULL."""
    by = list(by)
    points = _cumulative(_per_score(df, label, score, by), by)
    sums = df.groupBy(*by).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n")
    )
    joined = points.join(F.broadcast(sums), by) if by else points.join(F.broadcast(sums))
    curve = joined.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("fp") * 1.0, F.col("_n")).alias("fpr"),
        F.try_divide(F.col("tp") * 1.0, F.col("_p")).alias("tpr"),
    )
    origin = sums.select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return curve.unionByName(origin)


def precision_recall_curve(
    df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()
) -> DataFrame:
    """(threshold, precision, recall) at every distinct score."""
    by = list(by)
    points = _cumulative(_per_score(df, label, score, by), by)
    sums = df.groupBy(*by).agg(F.count_if(F.col(label) == 1).alias("_p"))
    joined = points.join(F.broadcast(sums), by) if by else points.join(F.broadcast(sums))
    return joined.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("tp") * 1.0, F.col("tp") + F.col("fp")).alias("precision"),
        F.try_divide(F.col("tp") * 1.0, F.col("_p")).alias("recall"),
    )


def roc_auc(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Area under the ROC curve: the share of (positive, negative) pairs in order.

    Per distinct score: positives times the negatives strictly below, plus half
    of the negatives level with it, over all pairs. NULL with a single class.
    """
    by = list(by)
    points = _cumulative(_per_score(df, label, score, by), by)
    sums = df.groupBy(*by).agg(
        F.count_if(F.col(label) == 1).alias("_p"), F.count_if(F.col(label) != 1).alias("_n")
    )
    joined = points.join(F.broadcast(sums), by) if by else points.join(F.broadcast(sums))
    wins = F.col("pos") * ((F.col("_n") - F.col("fp")) + F.col("neg") * 0.5)
    return joined.groupBy(*by).agg(
        F.try_divide(F.sum(wins), F.max(F.col("_p").cast("double") * F.col("_n"))).alias("roc_auc")
    )


def trapezoid_area(curve: DataFrame, x: str, y: str, by: Sequence[str] = ()) -> DataFrame:
    """Area under a bounded curve table by trapezoids, points taken in (x, y) order."""
    w = Window.partitionBy(*by).orderBy(x, y) if by else Window.partitionBy(F.lit(0)).orderBy(x, y)
    step = (F.col(x) - F.lag(x).over(w)) * (F.col(y) + F.lag(y).over(w)) / 2
    return curve.withColumn("_area", step).groupBy(*by).agg(F.coalesce(F.sum("_area"), F.lit(0.0)).alias("area"))


def leaderboard(scored: DataFrame, model: str = "model") -> DataFrame:
    """Five metrics per model over rows (model, label, score, prediction)."""
    base = threshold_metrics(scored, by=[model])
    area = roc_auc(scored, by=[model])
    return base.join(area, model).select(
        F.col(model).alias("Model"),
        F.col("accuracy").alias("Accuracy"),
        F.col("precision").alias("Precision"),
        F.col("recall").alias("Recall"),
        F.col("f1").alias("F1 Score"),
        F.col("roc_auc").alias("ROC AUC"),
    )


def best_model(board: DataFrame, metric: str = "roc auc") -> DataFrame:
    """Leaderboard row with the best value of the requested metric."""
    column = metric_name(metric)
    return best_row(board.withColumn("_score", F.col(f"`{column}`")), "_score", ["Model"]).drop("_score")


def classification_report(
    scored: DataFrame, label: str = "label", score: str = "score", prediction: str = "prediction"
) -> dict[str, DataFrame]:
    """Confusion matrix, metrics and, with two classes only, the curves."""
    tables = {
        "confusion": confusion_matrix(scored, label, prediction),
        "metrics": threshold_metrics(scored, label, prediction),
    }
    if scored.select(label).distinct().limit(3).count() == 2:
        tables["roc"] = roc_curve(scored, label, score)
        tables["precision_recall"] = precision_recall_curve(scored, label, score)
        tables["roc_auc"] = roc_auc(scored, label, score)
    return tables
