"""Training, tuning and comparing classifiers of a 0/1 target."""

from __future__ import annotations

import itertools
import json
import math
import random
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pandas as pd
from pyspark.ml.classification import (
    GBTClassificationModel, GBTClassifier, LinearSVC, LinearSVCModel, LogisticRegression, LogisticRegressionModel,
    RandomForestClassificationModel, RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from veinworks.operators.clustering import with_vectors
from veinworks.operators.neighbors import nearest_neighbors, neighbor_votes, neighbor_votes_by_k
from veinworks.operators.sampling import fold_column, oversample, sample_rows
from veinworks.operators.scoring import best_model, leaderboard, metric_name
from veinworks.session import checkpoint_folder, durable, from_rows

# The models compared, their defaults and their tuning grids.
DEFAULTS = {
    "Logistic Regression": {"C": 1.0, "max_iter": 1000},
    "KNN": {"n_neighbors": 5},
    "SVM": {"C": 1.0, "gamma": None},
    "Random Forest": {"n_estimators": 100, "max_depth": None},
    "Gradient Boosting": {"learning_rate": 0.3, "n_estimators": 100, "max_depth": 6},
}
GRIDS = {
    "Logistic Regression": {"C": [0.001, 0.01, 0.1, 1, 10, 100], "max_iter": [500, 1000, 3000]},
    "KNN": {"n_neighbors": list(range(1, 31))},
    "SVM": {"C": [0.1, 1, 10], "gamma": [0.1, 1, 10]},
    "Random Forest": {"n_estimators": [100, 200], "max_depth": [None, 10, 20]},
    "Gradient Boosting": {"learning_rate": [0.01, 0.1], "n_estimators": [100, 200], "max_depth": [3, 6]},
}
SEED = 42
FOLDS = 5
RANDOM_DRAWS = 10
SEARCHES = (None, "grid", "random")

DEEPEST_TREE = 30  # the deepest tree Spark grows
KERNEL_FEATURES = 128
PARALLEL_FITS = 4
ROWS_PER_LOT = 1_000_000  # rows times trees that are grown together: the driver holds their nodes

Scorer = Callable[[DataFrame], DataFrame]


class Fitted:
    """A trained model: its name, parameters, parts and how it scores rows.

    ``score`` gives (row_id, score, prediction); ``score`` is the probability of
    1. ``parts`` are Spark models and tables, ``extra`` plain values: with them
    the model can be written and read again.
    """

    def __init__(self, name: str, params: dict, parts: dict, features: Sequence[str], row_id: str, **extra):
        self.name, self.params, self.parts, self.extra = name, params, parts, extra
        self.features, self.row_id = list(features), row_id
        self.model = parts.get("model")
        self.score = SCORERS[name](parts, self.features, row_id, params, extra)


def _probability(parts, cols, row_id, params, extra) -> Scorer:
    model = parts["model"]
    if isinstance(model, ForestLots):
        return lambda df: model.score(df, cols, row_id)

    def score(df: DataFrame) -> DataFrame:
        out = model.transform(with_vectors(df, cols))
        return out.select(
            row_id,
            vector_to_array("probability")[1].alias("score"),
            F.col("prediction").cast("int").alias("prediction"),
        )

    return score


def fit_logistic(train, cols, label, row_id, C=1.0, max_iter=1000) -> Fitted:
    """L2-penalised: the penalty per row is 1 / (C · rows), on unscaled columns."""
    rows = with_vectors(train, cols)
    model = LogisticRegression(
        labelCol=label, regParam=1.0 / (C * max(rows.count(), 1)), elasticNetParam=0.0, standardization=False,
        maxIter=int(max_iter), tol=1e-6,
    ).fit(rows)
    return Fitted("Logistic Regression", {"C": C, "max_iter": max_iter}, {"model": model}, cols, row_id)


class ForestLots:
    """A forest whose trees are written in lots; the driver holds one lot at a time.

    Trees of unlimited depth have about as many nodes as rows, so a whole
    forest grows out of a driver's memory.
    """

    def __init__(self, paths: Sequence[str], trees: Sequence[int]):
        self.paths, self.trees = list(paths), list(trees)

    def score(self, df: DataFrame, cols: Sequence[str], row_id: str) -> DataFrame:
        """(row_id, score, prediction): the votes of all lots, added up in one pass over the rows per lot."""
        rows = df.select(row_id, *[F.col(f"`{c}`").cast("double").alias(f"_f{i}") for i, c in enumerate(cols)], F.lit(0.0).alias("_votes"))
        names = rows.columns[1:-1]
        for path, trees in zip(self.paths, self.trees, strict=True):
            out = RandomForestClassificationModel.load(path).transform(with_vectors(rows, names))
            votes = F.col("_votes") + trees * vector_to_array("probability")[1]
            rows = durable(out.select(row_id, *names, votes.alias("_votes")))
        score = F.col("_votes") / sum(self.trees)
        return rows.select(row_id, score.alias("score"), (score > 0.5).cast("int").alias("prediction"))

    @property
    def featureImportances(self) -> DenseVector:
        """The mean of the lots' importances, by their trees."""
        total = sum(n * RandomForestClassificationModel.load(p).featureImportances.toArray() for p, n in zip(self.paths, self.trees, strict=True))
        return DenseVector(total / total.sum() if total.sum() > 0 else total)

    def save(self, path: str) -> None:
        for i, lot in enumerate(self.paths):
            RandomForestClassificationModel.load(lot).write().overwrite().save(f"{path}/lot{i}")

    @classmethod
    def load(cls, path: str, trees: Sequence[int]) -> ForestLots:
        return cls([f"{path}/lot{i}" for i in range(len(trees))], trees)


def fit_forest(train, cols, label, row_id, n_estimators=100, max_depth=None) -> Fitted:
    """Trees are grown in lots of at most ``ROWS_PER_LOT`` rows times trees, one tree at least.

    The node that a row has reached is kept from level to level, so a deep tree
    is not walked from its root for every level, nor sent to the tasks.
    """
    folder = f"{checkpoint_folder(train.sparkSession)}/forest-{uuid.uuid4().hex}"
    depth = DEEPEST_TREE if max_depth is None else max_depth
    params = {"n_estimators": n_estimators, "max_depth": depth}
    rows = with_vectors(train, cols).select(label, "features").persist()
    try:
        most = max(1, ROWS_PER_LOT // max(1, rows.count()))
        forest = RandomForestClassifier(labelCol=label, maxDepth=depth, cacheNodeIds=True)
        grow = lambda n, lot: forest.copy({forest.numTrees: n, forest.seed: SEED + lot}).fit(rows)
        if n_estimators <= most:
            return Fitted("Random Forest", params, {"model": grow(n_estimators, 0)}, cols, row_id)
        trees = []
        while sum(trees) < n_estimators:
            size = min(most, n_estimators - sum(trees))
            grow(size, len(trees)).write().overwrite().save(f"{folder}/lot{len(trees)}")
            trees.append(size)
    finally:
        rows.unpersist()
    return Fitted("Random Forest", params, {"model": ForestLots.load(folder, trees)}, cols, row_id, lots=trees)


def fit_boosted(train, cols, label, row_id, learning_rate=0.3, n_estimators=100, max_depth=6) -> Fitted:
    model = GBTClassifier(
        labelCol=label, stepSize=learning_rate, maxIter=n_estimators, maxDepth=max_depth, seed=SEED
    ).fit(with_vectors(train, cols))
    params = {"learning_rate": learning_rate, "n_estimators": n_estimators, "max_depth": max_depth}
    return Fitted("Gradient Boosting", params, {"model": model}, cols, row_id)


def fit_neighbors(train, cols, label, row_id, n_neighbors=5) -> Fitted:
    """Majority of the nearest training rows; nothing is fitted beyond keeping them.

    Synthetic rows share the id of their base row, so rows are numbered anew by
    their place in the written table.
    """
    kept = _numbered(train, cols, label).withColumnRenamed("_number", row_id)
    return Fitted("KNN", {"n_neighbors": n_neighbors}, {"rows": kept}, cols, row_id, label=label)


def _votes(parts, cols, row_id, params, extra) -> Scorer:
    kept = parts["rows"]

    def score(df: DataFrame) -> DataFrame:
        near = nearest_neighbors(kept, cols, params["n_neighbors"], queries=df.select(row_id, *cols), row_id=row_id)
        return neighbor_votes(near, kept, row_id, extra["label"]).select(
            F.col("query_id").alias(row_id), "score", F.col("prediction").cast("int").alias("prediction")
        )

    return score


def _numbered(train: DataFrame, cols, label) -> DataFrame:
    """Training rows with a stable number of their own (durable, so it never changes)."""
    doubles = [F.col(f"`{c}`").cast("double").alias(c) for c in cols]
    return durable(train.select(*doubles, F.col(label).cast("int").alias(label)).withColumn("_number", F.monotonically_increasing_id()))


def kernel_features(df: DataFrame, cols: Sequence[str], gamma: float, n: int = KERNEL_FEATURES, seed: int = SEED) -> DataFrame:
    """Random Fourier features of the Gaussian kernel exp(-gamma · distance²) as ``features``."""
    draw = np.random.default_rng(seed)
    weights = draw.normal(0.0, math.sqrt(2.0 * gamma), size=(len(cols), n))
    shift = draw.uniform(0.0, 2.0 * math.pi, size=n)

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def lift(parts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in parts:
            x = np.array(part.tolist(), dtype=float).reshape(len(part), -1)
            yield pd.Series(list(np.sqrt(2.0 / n) * np.cos(x @ weights + shift)), dtype=object)

    place = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    return df.withColumn("features", array_to_vector(lift(place)))


def default_gamma(df: DataFrame, cols: Sequence[str]) -> float:
    """1 / (columns · variance over all values)."""
    row = df.agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.avg(F.col(f"`{c}`").cast("double") ** 2).alias(f"q{i}") for i, c in enumerate(cols)],
    ).first()
    mean = sum(row[f"m{i}"] for i in range(len(cols))) / len(cols)
    var = sum(row[f"q{i}"] for i in range(len(cols))) / len(cols) - mean * mean
    return 1.0 / (len(cols) * var) if var > 0 else 1.0


def fit_svm(train, cols, label, row_id, C=1.0, gamma=None) -> Fitted:
    """Support vector machine with an approximated Gaussian kernel.

    Rows are lifted by random features and separated linearly; a logistic fit
    on the margin turns it into a probability.
    """
    width = default_gamma(train, cols) if gamma is None else gamma
    lifted = kernel_features(train, cols, width).select(label, "features").persist()
    try:
        n = max(lifted.count(), 1)
        model = LinearSVC(labelCol=label, regParam=1.0 / (C * n), standardization=False, maxIter=200).fit(lifted)
        margins = model.transform(lifted).select(label, _margin())
        sigmoid = LogisticRegression(labelCol=label, featuresCol="margin").fit(margins)
    finally:
        lifted.unpersist()

    return Fitted("SVM", {"C": C, "gamma": width}, {"model": model, "sigmoid": sigmoid}, cols, row_id, width=width)


def _margin():
    return array_to_vector(F.array(vector_to_array("rawPrediction")[1])).alias("margin")


def _kernel(parts, cols, row_id, params, extra) -> Scorer:
    def score(df: DataFrame) -> DataFrame:
        out = parts["model"].transform(kernel_features(df.select(row_id, *cols), cols, extra["width"]))
        out = out.select(row_id, F.col("prediction").cast("int").alias("prediction"), _margin())
        out = parts["sigmoid"].setPredictionCol("_p").setRawPredictionCol("_r").transform(out)
        return out.select(row_id, vector_to_array("probability")[1].alias("score"), "prediction")

    return score


SCORERS = {
    "Logistic Regression": _probability, "KNN": _votes, "SVM": _kernel, "Random Forest": _probability,
    "Gradient Boosting": _probability,
}
READERS = {
    "Logistic Regression": {"model": LogisticRegressionModel}, "KNN": {}, "Random Forest": {"model": RandomForestClassificationModel},
    "SVM": {"model": LinearSVCModel, "sigmoid": LogisticRegressionModel}, "Gradient Boosting": {"model": GBTClassificationModel},
}


def add_scores(fitted: Fitted, df: DataFrame) -> DataFrame:
    """All columns of ``df`` with ``score`` and ``prediction``, which replace columns of these names.

    Without a join, but for the neighbour model, which looks rows up by their key.
    """
    kept = [c for c in df.columns if c not in ("score", "prediction")]
    if fitted.name == "KNN":
        return df.select(*[F.col(f"`{c}`") for c in kept]).join(fitted.score(df), fitted.row_id)
    # The whole row takes the place of the key.
    score = SCORERS[fitted.name](fitted.parts, fitted.features, "_row", fitted.params, fitted.extra)
    row = F.struct(*[F.col(f"`{c}`") for c in kept]).alias("_row")
    scored = score(df.select(row, *[F.col(f"`{c}`") for c in fitted.features]))
    return scored.select(*[F.col(f"_row.`{c}`") for c in kept], "score", "prediction")


def save_fitted(fitted: Fitted, path: str, spark: SparkSession) -> str:
    """Write a trained model of any kind: its parts, and a row that describes it."""
    about = {"name": fitted.name, "params": fitted.params, "features": fitted.features, "row_id": fitted.row_id, "extra": fitted.extra}
    for part, value in fitted.parts.items():
        if isinstance(value, DataFrame):
            value.write.mode("overwrite").parquet(f"{path}/{part}")
        elif isinstance(value, ForestLots):
            value.save(f"{path}/{part}")
        else:
            value.write().overwrite().save(f"{path}/{part}")
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")
    return path


def load_fitted(spark: SparkSession, path: str) -> Fitted:
    """Read what ``save_fitted`` has written."""
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    if lots := about["extra"].get("lots"):
        parts = {"model": ForestLots.load(f"{path}/model", lots)}
    else:
        parts = {part: kind.load(f"{path}/{part}") for part, kind in READERS[about["name"]].items()}
    if about["name"] == "KNN":
        parts["rows"] = spark.read.parquet(f"{path}/rows")
    return Fitted(about["name"], about["params"], parts, about["features"], about["row_id"], **about["extra"])


FITTERS = {
    "Logistic Regression": fit_logistic,
    "KNN": fit_neighbors,
    "SVM": fit_svm,
    "Random Forest": fit_forest,
    "Gradient Boosting": fit_boosted,
}


def combinations(grid: dict[str, list]) -> list[dict]:
    return [dict(zip(grid, values)) for values in itertools.product(*grid.values())]


def drawn_combinations(grid: dict[str, list], n: int = RANDOM_DRAWS, seed: int = SEED) -> list[dict]:
    """n different combinations (all, when there are fewer), reproducibly."""
    every = combinations(grid)
    return every if len(every) <= n else random.Random(seed).sample(every, n)


def labelled(scores: DataFrame, rows: DataFrame, label: str, row_id: str) -> DataFrame:
    return rows.select(row_id, F.col(label).cast("int").alias("label")).join(scores, row_id)


def search_parameters(
    name: str, train: DataFrame, cols: Sequence[str], label: str, settings: Sequence[dict], metric: str = "roc auc",
    row_id: str = "row_id", folds: int = FOLDS, balance: bool = False,
) -> tuple[dict, DataFrame]:
    """(best setting, (model, params, metric, mean_score)) by cross-validation.

    Minority rows are made inside the training folds only. The neighbour model
    looks up the neighbours of a fold once for all its settings.
    """
    column, cols = metric_name(metric), list(cols)
    rows = train.select(row_id, *[F.col(f"`{c}`").cast("double").alias(c) for c in cols], F.col(label).cast("int").alias(label))
    rows = rows.withColumn("fold", fold_column(row_id, folds)).persist()
    try:
        scored = None
        for i in range(folds):
            fitting, held = rows.where(F.col("fold") != i).drop("fold"), rows.where(F.col("fold") == i).drop("fold")
            if balance:
                fitting = durable(oversample(fitting, label, cols, row_id))
            if name == "KNN":
                kept = _numbered(fitting, cols, label).withColumnRenamed("_number", row_id)
                most = max(s["n_neighbors"] for s in settings)
                near = durable(nearest_neighbors(kept, cols, most, queries=held, row_id=row_id))
                ks = [s["n_neighbors"] for s in settings]
                votes = neighbor_votes_by_k(near, kept, ks, row_id, label).withColumnRenamed("query_id", row_id)
                place = F.array_position(F.array(*[F.lit(int(k)) for k in ks]), F.col("k")) - 1
                parts = [votes.withColumn("model", F.concat(place.cast("string"), F.lit(f"/{i}"))).drop("k")]
            else:
                with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
                    fits = list(pool.map(lambda s: FITTERS[name](fitting, cols, label, row_id, **s), settings))
                parts = [f.score(held).withColumn("model", F.lit(f"{j}/{i}")) for j, f in enumerate(fits)]
            # One name per (setting, fold): scores are averaged over folds.
            for part in parts:
                one = labelled(part, held, label, row_id).select(row_id, "label", "score", "prediction", "model")
                scored = one if scored is None else scored.unionByName(one)
        board = leaderboard(durable(scored)).select(
            F.split_part("Model", F.lit("/"), F.lit(1)).cast("int").alias("setting"), F.col(f"`{column}`").alias("value")
        )
        means = {r["setting"]: r["mean"] for r in board.groupBy("setting").agg(F.avg("value").alias("mean")).collect()}
    finally:
        rows.unpersist()
    ranked = [(name, {k: str(v) for k, v in s.items()}, column, means.get(j)) for j, s in enumerate(settings)]
    best = max(range(len(settings)), key=lambda j: (means.get(j) is not None, means.get(j) or 0.0, -j))
    table = from_rows(train.sparkSession, ranked, "model string, params map<string,string>, metric string, mean_score double")
    return settings[best], table


def compare_models(
    train: DataFrame,
    test: DataFrame,
    cols: Sequence[str],
    label: str,
    row_id: str = "row_id",
    models: Sequence[str] = tuple(DEFAULTS),
    search: str | None = None,
    metric: str = "roc auc",
    n_samples: int | None = None,
    balance: bool = True,
    grids: dict[str, dict] | None = None,
) -> dict:
    """Train every model once, score the held-out rows, rank by one metric.

    Steps: settings by cross-validation (optional) → minority oversampling of
    the training rows → optional downsampling → one fit per model → leaderboard.
    """
    column = metric_name(metric)
    if search not in SEARCHES:
        raise ValueError("search must be None, 'grid' or 'random'")
    unknown = [m for m in models if m not in FITTERS]
    if unknown:
        raise ValueError(f"unknown models {unknown}; expected some of: {', '.join(FITTERS)}")
    cols = list(cols)
    grids = {**GRIDS, **(grids or {})}
    settings, searches = {}, None
    for name in models:
        settings[name] = DEFAULTS[name]
        if search is not None:
            tried = combinations(grids[name]) if search == "grid" else drawn_combinations(grids[name])
            settings[name], table = search_parameters(name, train, cols, label, tried, metric, row_id, balance=balance)
            searches = table if searches is None else searches.unionByName(table)
    rows = train.select(row_id, *cols, F.col(label).cast("int").alias(label))
    if balance:
        rows = oversample(rows, label, cols, row_id).drop("synthetic")
    if n_samples is not None:
        rows = sample_rows(rows, n_samples, row_id)
    rows = durable(rows)
    fitted = {name: FITTERS[name](rows, cols, label, row_id, **settings[name]) for name in models}
    scored = None
    for name, model in fitted.items():
        one = labelled(model.score(test), test, label, row_id).withColumn("model", F.lit(name))
        scored = one if scored is None else scored.unionByName(one)
    scored = durable(scored)
    board = durable(leaderboard(scored))
    winner = best_model(board, metric).first()["Model"]
    return {
        "leaderboard": board, "scored": scored, "models": fitted, "best": fitted[winner], "metric": column,
        "searches": searches,
    }


def feature_importances(fitted: Fitted, n: int | None = None) -> DataFrame | None:
    """(feature, importance), largest first; ``None`` for models that have none."""
    model = fitted.model
    if hasattr(model, "featureImportances"):
        weights = model.featureImportances.toArray()
    elif fitted.name == "Logistic Regression":
        weights = np.abs(model.coefficients.toArray())
    else:
        return None
    rows = sorted(zip(fitted.features, (float(w) for w in weights)), key=lambda p: -p[1])
    return from_rows(SparkSession.active(), rows[:n], "feature string, importance double")
