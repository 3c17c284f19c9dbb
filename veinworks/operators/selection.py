"""Choosing features, with and without a target."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorSlicer
from pyspark.sql import DataFrame, functions as F

from veinworks.functions.numeric import numeric_columns
from veinworks.operators.clustering import assign_kmeans, fit_kmeans, with_vectors
from veinworks.operators.columns import require_column
from veinworks.operators.components import MAX_COMPONENTS, auto_feature_count, fit_components
from veinworks.operators.ranking import FLAT
from veinworks.operators.sampling import LARGE_TABLE, fold_column, sample_rows, stratified_downsample, with_class_weights
from veinworks.operators.scaling import scale_parameters, standardise
from veinworks.operators.silhouette import mean_silhouette
from veinworks.session import from_rows

# Components that count in the ranking, clusters of the quality
# check, folds of the elimination.
RANKED_COMPONENTS = 3
QUALITY_CLUSTERS = 3
FOLDS = 5
PROBLEMS = ("classification", "regression", "clustering")
PARALLEL_FITS = 8


def _spread(values: np.ndarray) -> np.ndarray:
    low, high = values.min(), values.max()
    return (values - low) / (high - low) if high - low >= FLAT else np.zeros(len(values))


def rank_unsupervised(df: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, np.ndarray]:
    """((feature, variance, loading, score), explained shares).

    The score averages the normalised variance after scaling (1, or 0 for a
    constant) and the normalised absolute loadings on three components.
    """
    cols = list(cols)
    params = scale_parameters(df, cols)
    variance = np.array([1.0 if params[c][1] else 0.0 for c in cols])
    loadings, share = fit_components(df, cols, min(MAX_COMPONENTS, len(cols)))
    weight = np.abs(loadings[:RANKED_COMPONENTS]).sum(axis=0)
    score = (_spread(variance) + _spread(weight)) / 2
    rows = [(c, float(variance[i]), float(weight[i]), float(score[i]), i) for i, c in enumerate(cols)]
    table = from_rows(df.sparkSession, rows, "feature string, variance double, loading double, score double, position int")
    return table, share


def select_unsupervised(df: DataFrame, cols: Sequence[str], n: int | None = None) -> list[str]:
    """The n best-ranked features; n from the explained variance when not given."""
    ranking, share = rank_unsupervised(df, cols)
    wanted = n if n is not None else auto_feature_count(share, len(cols))
    return [r["feature"] for r in ranking.orderBy(F.desc("score"), "position").limit(wanted).collect()]


def selection_quality(df: DataFrame, cols: Sequence[str], row_id: str = "row_id") -> float | None:
    """Silhouette of a three-cluster k-means on the (scaled) selected features."""
    scaled = standardise(df.select(row_id, *[F.col(f"`{c}`") for c in cols]), cols)
    model, _ = fit_kmeans(scaled, cols, QUALITY_CLUSTERS)
    return mean_silhouette(scaled.join(assign_kmeans(scaled, cols, model, row_id), row_id), cols, row_id=row_id)


def _learner(label: str, seed: int, max_depth: int):
    tree = DecisionTreeClassifier(labelCol=label, featuresCol="picked", weightCol="weight", seed=seed, maxDepth=max_depth)
    return tree, MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy")


def _eliminate(learner, train: DataFrame, n: int, down_to: int = 1, test: DataFrame | None = None, evaluator=None):
    """Drop the least important feature again and again.

    Returns ``(kept, importances, {size: score})``; scores only with a test set.
    """
    kept, scores = list(range(n)), {}
    while True:
        picker = VectorSlicer(inputCol="features", outputCol="picked", indices=kept)
        model = learner.fit(picker.transform(train))
        if test is not None:
            scores[len(kept)] = evaluator.evaluate(model.transform(picker.transform(test)))
        weights = model.featureImportances.toArray()
        if len(kept) <= down_to:
            return kept, weights, scores
        kept.pop(int(np.argmin(weights)))


class LineSums:
    """Sums of products of 1, the columns and the target for each fold: enough for every linear fit and its score.

    One pass over the rows; columns and target are moved to their means first,
    so that large values lose no digits.
    """

    def __init__(self, df: DataFrame, cols: Sequence[str], label: str, row_id: str, folds: int, seed: int):
        values = [F.col(f"`{c}`").cast("double") for c in (*cols, label)]
        rows = df.select(fold_column(row_id, folds, seed).cast("int").alias("fold"), *[v.alias(f"x{i}") for i, v in enumerate(values)]).dropna()
        names, width = rows.columns[1:], len(values) + 1
        shift = np.array(rows.agg(*[F.avg(c) for c in names]).first(), float)

        def run(batches):
            sums = np.zeros((folds, width, width))
            for batch in batches:
                x = np.column_stack([c.to_numpy() for c in batch.columns[1:]]) - shift
                x, fold = np.column_stack([np.ones(len(x)), x]), batch.column(0).to_numpy()
                for f in np.unique(fold):
                    sums[f] += x[fold == f].T @ x[fold == f]
            keys = [pa.array(np.repeat(np.arange(folds, dtype=np.int32), width)), pa.array(np.tile(np.arange(width, dtype=np.int32), folds))]
            yield pa.RecordBatch.from_arrays([*keys, pa.array(list(sums.reshape(-1, width)), pa.list_(pa.float64()))], ["fold", "i", "sums"])

        def add(part: pa.Table) -> pa.Table:
            total = np.sum([r.values.to_numpy() for r in part["sums"]], axis=0)
            return pa.Table.from_arrays([part["fold"][:1], part["i"][:1], pa.array([total], pa.list_(pa.float64()))], ["fold", "i", "sums"])

        schema = "fold int, i int, sums array<double>"
        self.folds = np.zeros((folds, width, width))
        for fold, i, sums in rows.mapInArrow(run, schema).groupBy("fold", "i").applyInArrow(add, schema).collect():  # folds × columns rows
            self.folds[fold, i] = sums

    def eliminate(self, train: np.ndarray, test: np.ndarray | None = None, down_to: int = 1):
        """(kept, importances, {size: r2}) as the column with the smallest coefficient leaves again and again.

        A column leaves the inverse of the normal equations by a rank-one
        update; nothing is fitted anew.
        """
        n = train[0, 0]
        centred = train[1:, 1:] - np.outer(train[0, 1:], train[0, 1:]) / n
        kept, inverse = list(range(len(centred) - 1)), np.linalg.pinv(centred[:-1, :-1], hermitian=True)
        scores = {}
        while True:
            weights = inverse @ centred[kept, -1]
            if test is not None:
                scores[len(kept)] = self._r2(train, test, kept, weights)
            if len(kept) <= down_to:
                return kept, np.abs(weights), scores
            j = int(np.argmin(np.abs(weights)))
            if inverse[j, j] > 0:
                inverse = inverse - np.outer(inverse[:, j], inverse[j]) / inverse[j, j]
            inverse = np.delete(np.delete(inverse, j, 0), j, 1)
            kept.pop(j)

    @staticmethod
    def _r2(train: np.ndarray, test: np.ndarray, kept: list[int], weights: np.ndarray) -> float:
        places = [k + 1 for k in kept]
        start = (train[0, -1] - train[0, places] @ weights) / train[0, 0]
        line = np.zeros(len(test))
        line[0], line[places], line[-1] = -start, -weights, 1.0  # what a row's target is off its line
        total = test[-1, -1] - test[0, -1] ** 2 / test[0, 0]
        return float(1 - (line @ test @ line) / total) if total > 0 else 0.0


def eliminate_linear(
    df: DataFrame, cols: Sequence[str], label: str, row_id: str = "row_id", folds: int = FOLDS, seed: int = 42
) -> tuple[list[tuple[int, float]], object]:
    """(curve of mean r2 by size, elimination on all rows) of linear regression, from one pass over the rows.

    Rows with a missing value are left out; folds without rows do not count.
    """
    sums = LineSums(df, cols, label, row_id, folds, seed)
    whole = sums.folds.sum(0)
    used = [f for f in sums.folds if f[0, 0] > 0 and whole[0, 0] > f[0, 0]]
    per_fold = [sums.eliminate(whole - f, f)[2] for f in used]
    curve = [(n, float(np.mean([s[n] for s in per_fold])) if per_fold else 0.0) for n in range(1, len(cols) + 1)]
    return curve, lambda size: sums.eliminate(whole, None, size)[:2]


def eliminate_features(
    df: DataFrame, cols: Sequence[str], label: str, problem: str = "classification", row_id: str = "row_id",
    folds: int = FOLDS, seed: int = 42, max_depth: int = 10,
) -> dict:
    """Recursive elimination with cross-validation, one feature at a time.

    Every fold eliminates on its own; the size with the best mean score wins,
    ties go to fewer features; a last elimination on all rows names them.
    """
    require_column(df, label)
    cols = list(cols)
    if problem == "regression":
        curve, eliminated = eliminate_linear(df, cols, label, row_id, folds, seed)
        kept, weights = eliminated(_best_size(curve))
        return _elimination(df.sparkSession, cols, curve, kept, weights)
    base = with_vectors(df, cols).select(row_id, F.col(label).cast("double").alias(label), "features")
    base = with_class_weights(base, label).withColumn("fold", fold_column(row_id, folds, seed)).persist()
    try:
        learner, evaluator = _learner(label, seed, max_depth)

        def run(i: int):
            train, test = base.where(F.col("fold") != i), base.where(F.col("fold") == i)
            return _eliminate(learner, train, len(cols), 1, test, evaluator)[2]

        with ThreadPoolExecutor(max_workers=min(folds, PARALLEL_FITS)) as pool:
            per_fold = list(pool.map(run, range(folds)))
        curve = [(n, float(np.mean([s[n] for s in per_fold]))) for n in range(1, len(cols) + 1)]
        kept, weights, _ = _eliminate(learner, base, len(cols), _best_size(curve))
    finally:
        base.unpersist()
    return _elimination(df.sparkSession, cols, curve, kept, weights)


def _best_size(curve: list[tuple[int, float]]) -> int:
    """The size with the best score, the smaller of equals."""
    return max(curve, key=lambda p: (p[1], -p[0]))[0]


def _elimination(spark, cols, curve, kept, weights) -> dict:
    importances = sorted(zip(kept, weights), key=lambda p: (-p[1], p[0]))
    return {
        "features": [cols[i] for i in sorted(kept)],
        "importances": from_rows(spark, [(cols[i], float(w)) for i, w in importances], "feature string, importance double"),
        "ordered": [cols[i] for i, _ in importances],
        "curve": from_rows(spark, curve, "n_features int, mean_score double"),
    }


def select_features(
    df: DataFrame,
    label: str | None = None,
    problem_type: str = "classification",
    n_features: int | None = None,
    downsample: bool = False,
    row_id: str = "row_id",
    cols: Sequence[str] | None = None,
    **params,
) -> dict:
    """Entry point: the narrowed table, the chosen names and the supporting tables."""
    if problem_type not in PROBLEMS:
        raise ValueError(f"problem_type must be one of: {', '.join(PROBLEMS)}")
    cols = list(cols) if cols is not None else numeric_columns(df, [row_id] + ([label] if label else []))
    extra = [label] if label and label in df.columns else []
    out: dict = {}
    if problem_type == "clustering":
        ranking, share = rank_unsupervised(df, cols)
        wanted = n_features if n_features is not None else auto_feature_count(share, len(cols))
        chosen = [r["feature"] for r in ranking.orderBy(F.desc("score"), "position").limit(wanted).collect()]
        out.update(ranking=ranking, silhouette=selection_quality(df, chosen, row_id))
    else:
        if label is None:
            raise ValueError(f"a target column is required for {problem_type}")
        sampled = df
        if downsample:
            if problem_type == "classification":
                sampled = stratified_downsample(df, label, row_id)
            else:
                n = df.count()
                sampled = sample_rows(df, min(LARGE_TABLE, n // 2), row_id) if n > LARGE_TABLE else df
        found = eliminate_features(sampled, cols, label, problem_type, row_id, **params)
        chosen = found["features"]
        if n_features is not None and n_features < len(chosen):
            chosen = found["ordered"][:n_features]
        out.update(curve=found["curve"], importances=found["importances"])
    out["features"] = chosen
    out["data"] = df.select(row_id, *[F.col(f"`{c}`") for c in chosen], *extra)
    return out


def selection_report(spark, problem_type: str, features: Sequence[str]) -> DataFrame:
    """(section, key, value) rows describing a selection."""
    rows = [("selection", "problem_type", problem_type), ("selection", "n_features", str(len(features)))]
    rows += [("features", str(i + 1), f) for i, f in enumerate(features)]
    return from_rows(spark, rows, "section string, key string, value string")


