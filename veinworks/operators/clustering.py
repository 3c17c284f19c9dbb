"""Centroid and hierarchical clustering, sweeps, and the segmentation analysis."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.ml.clustering import BisectingKMeans, BisectingKMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window, functions as F

from veinworks.functions.numeric import numeric_columns, string_columns
from veinworks.operators.columns import fill_missing, segmentation_columns, wide_to_long
from veinworks.operators.components import project
from veinworks.operators.density import dbscan_eps_sweep, dbscan_grid
from veinworks.operators.encoding import one_hot
from veinworks.operators.linkage import MICRO, linkage_labels
from veinworks.operators.lloyd import Centers, fit_many, labels_of, with_nearest
from veinworks.operators.neighbors import neighbor_distance_range
from veinworks.operators.quantiles import box_statistics, exact_quantiles, medians
from veinworks.operators.ranking import best_row, elbow
from veinworks.operators.scaling import rescaled_over_groups, standardise, standardise_if_wide
from veinworks.operators.silhouette import clustering_scores, mean_silhouettes, silhouette_samples
from veinworks.session import durable, from_rows

# Seed and number of starts of k-means, share of rows per cluster
# that bounds k, and the DBSCAN grid of the segmentation analysis.
SEED = 42
STARTS = 10
ROWS_PER_CLUSTER = 10
SEGMENT_EPS_STEPS = 4
SEGMENT_MIN_SAMPLES = (5, 20, 3)
METHODS = ("kmeans", "hierarchical", "dbscan")
PARALLEL_FITS = 8
SWEEP_SCHEMA = "method string, n_clusters int, silhouette double, inertia double"


def with_vectors(df: DataFrame, cols: Sequence[str], output: str = "features") -> DataFrame:
    doubles = df.withColumns({c: F.col(f"`{c}`").cast("double") for c in cols})
    return VectorAssembler(inputCols=list(cols), outputCol=output).transform(doubles)


def fit_kmeans(
    df: DataFrame, cols: Sequence[str], k: int, seed: int = SEED, starts: int = STARTS, max_iter: int = 300
) -> tuple[Centers, float]:
    """The cheapest of several seeded starts, with its cost."""
    found = fit_many(df, cols, {k: starts}, seed, max_iter)[k]
    return found, found.cost


def assign_kmeans(df: DataFrame, cols: Sequence[str], model: Centers, row_id: str = "row_id") -> DataFrame:
    rows = df.select(row_id, *[F.col(f"`{c}`") for c in cols])
    return with_nearest(rows, cols, {"prediction": model.points}).select(row_id, "prediction")


def nearest_center(df: DataFrame, cols: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Each row with its nearest given centre (``prediction``) and the squared distance, without a join."""
    found = with_nearest(df, cols, {"prediction": np.array(centers, float)}, "squared_distance")
    return found.withColumn("prediction", F.col("prediction").cast("int"))


def cluster_counts_to_try(k_range: tuple[int, int], n_rows: int) -> list[int]:
    """k from max(2, low) to high, never more than a tenth of the rows."""
    low, high = k_range
    return list(range(max(2, low), min(high, n_rows // ROWS_PER_CLUSTER) + 1))


def kmeans_sweep(
    df: DataFrame, cols: Sequence[str], k_range: tuple[int, int] = (2, 10), row_id: str = "row_id",
    starts: int = STARTS, limit_k: bool = True,
) -> dict:
    """k-means per k, chosen by silhouette, or by the elbow when no k has one."""
    ks = cluster_counts_to_try(k_range, df.count()) if limit_k else list(range(k_range[0], k_range[1] + 1))
    if not ks:
        raise ValueError("too few rows for two clusters")
    rows = durable(df.select(row_id, *[F.col(f"`{c}`") for c in cols]))  # read often, made once
    fitted = fit_many(rows, cols, {k: starts for k in ks}, SEED)
    labels = labels_of(rows, cols, {f"k{k}": fitted[k].points for k in ks}, row_id)
    return _choose(rows, cols, row_id, "kmeans", ks, labels, fitted, {k: fitted[k].cost for k in ks})


def _choose(df, cols, row_id, method, ks, labels, models, costs):
    """Silhouettes of all k in one pass over labels kept side by side; then the best k."""
    settings = F.array(*[F.struct(F.lit(f"k{k}").alias("setting"), F.col(f"k{k}").alias("label")) for k in ks])
    scores = mean_silhouettes(df, labels.select(row_id, F.inline(settings)), cols, row_id)
    rows = [(method, k, scores.get(f"k{k}"), costs.get(k)) for k in ks]
    sweep = from_rows(df.sparkSession, rows, SWEEP_SCHEMA)
    scored = [r for r in rows if r[2] is not None]
    if scored:
        best = max(scored, key=lambda r: (r[2], -r[1]))[1]
    else:
        found = elbow(from_rows(df.sparkSession, list(costs.items()), "k int, inertia double")).first() if costs else None
        best = found["k"] if found else ks[0]
    return {
        "sweep": sweep,
        "model": models.get(best),
        "labels": labels.select(row_id, F.col(f"k{best}").alias("prediction")),
        "n_clusters": best,
        "silhouette": scores.get(f"k{best}"),
    }


def fit_bisecting(df: DataFrame, cols: Sequence[str], ks: Sequence[int], seed: int = SEED) -> dict[int, BisectingKMeansModel]:
    """Top-down hierarchies with k leaves, for each k; the fits run side by side."""
    vectors = with_vectors(_positive(df, cols), cols).select("features").persist()
    try:
        with ThreadPoolExecutor(max_workers=PARALLEL_FITS) as pool:
            fits = pool.map(lambda k: BisectingKMeans(k=k, seed=seed).fit(vectors), ks)
            return dict(zip(ks, fits, strict=True))
    finally:
        vectors.unpersist()


def _positive(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """The columns moved so that their minima are 1: halving starts from a step
    relative to the centre's distance from the origin, and standardised columns have none."""
    low = df.agg(*[F.min(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    return df.withColumns({c: F.col(f"`{c}`").cast("double") + F.lit(1.0 - (low[i] or 0.0)) for i, c in enumerate(cols)})


def halving_labels(df: DataFrame, cols: Sequence[str], ks: Sequence[int], row_id: str = "row_id", seed: int = SEED) -> DataFrame:
    """(row_id, k2, k3, ...) of up to k groups, by halving the group of largest cost again and again.

    Each halving is a pass over the rows. Rows that are all equal stay
    together, so there may be fewer than k groups.
    """
    models, scored = fit_bisecting(df, cols, ks, seed), with_vectors(_positive(df, cols), cols)
    for k in ks:
        scored = models[k].setPredictionCol(f"k{k}").transform(scored)
    return durable(scored.select(row_id, *[F.col(f"k{k}").cast("long") for k in ks]))


def hierarchical_labels(
    df: DataFrame, cols: Sequence[str], k: int, row_id: str = "row_id", seed: int = SEED, linkage: str = "ward", micro: int = MICRO
) -> DataFrame:
    """(row_id, prediction) of up to k groups: bottom-up by ``linkage``, or top-down with ``linkage="halving"``."""
    found = _hierarchy(df, cols, [k], row_id, seed, linkage, micro)
    return found.select(row_id, F.col(f"k{k}").alias("prediction"))


def _hierarchy(df, cols, ks, row_id, seed, linkage, micro) -> DataFrame:
    if linkage == "halving":
        return halving_labels(df, cols, ks, row_id, seed)
    return linkage_labels(df, cols, ks, linkage, row_id, micro)


def hierarchical_sweep(
    df: DataFrame, cols: Sequence[str], k_range: tuple[int, int] = (2, 10), row_id: str = "row_id", limit_k: bool = True,
    linkage: str = "ward", micro: int = MICRO,
) -> dict:
    """One hierarchy cut at every k; chosen by silhouette."""
    ks = cluster_counts_to_try(k_range, df.count()) if limit_k else list(range(k_range[0], k_range[1] + 1))
    if not ks:
        raise ValueError("too few rows for two clusters")
    rows = durable(df.select(row_id, *[F.col(f"`{c}`") for c in cols]))  # read often, made once
    labels = _hierarchy(rows, cols, ks, row_id, SEED, linkage, micro)
    return _choose(rows, cols, row_id, "hierarchical", ks, labels, {}, {})


def run_clustering(
    df: DataFrame,
    cols: Sequence[str],
    k_range: tuple[int, int] = (2, 10),
    methods: Sequence[str] = METHODS,
    row_id: str = "row_id",
    starts: int = STARTS,
) -> dict:
    """Every requested method on (if need be scaled) columns; best by silhouette.

    Returns the sweep table, the labels, method and cluster count of the winner
    and its profile on the unscaled columns.
    """
    unknown = [m for m in methods if m not in METHODS]
    if unknown:
        raise ValueError(f"unknown methods {unknown}; expected some of: {', '.join(METHODS)}")
    cols = list(cols)
    scaled = standardise_if_wide(df.select(row_id, *cols), cols).persist()
    results = {}
    try:
        for method in methods:
            if method == "kmeans":
                results[method] = kmeans_sweep(scaled, cols, k_range, row_id, starts, limit_k=False)
            elif method == "hierarchical":
                results[method] = hierarchical_sweep(scaled, cols, k_range, row_id=row_id, limit_k=False)
            else:
                results[method] = dbscan_eps_sweep(scaled, cols, row_id=row_id)
    finally:
        scaled.unpersist()
    sweep = None
    for method, found in results.items():
        part = found["sweep"].withColumn("n_clusters", F.col("n_clusters").cast("long"))
        sweep = part if sweep is None else sweep.unionByName(part, allowMissingColumns=True)
    best = None
    for method, found in results.items():
        score = found["silhouette"]
        if score is not None and (best is None or score > results[best]["silhouette"]):
            best = method
    out = {"sweep": sweep, "method": best, "labels": None, "n_clusters": None, "silhouette": None, "profile": None}
    if best is not None:
        out.update({k: results[best][k] for k in ("labels", "n_clusters", "silhouette")})
        out["profile"] = cluster_profile(df.join(out["labels"], row_id), cols)
    return out


def segmentation_features(df: DataFrame, row_id: str = "row_id") -> DataFrame:
    """Customer column groups, indicators without a missing level, medians for gaps."""
    chosen = segmentation_columns(df)
    picked = df.select(row_id, *[F.col(f"`{c}`") for c in chosen])
    text = string_columns(picked, [row_id])
    encoded = one_hot(picked, text, most=None, missing=False) if text else picked
    numbers = numeric_columns(encoded, [row_id])
    filled = fill_missing(encoded, medians(encoded, numbers))
    return filled.select(row_id, *[F.col(f"`{c}`").cast("double").alias(c) for c in numbers])


def segmentation(
    df: DataFrame,
    k_range: tuple[int, int] = (2, 8),
    all_columns: bool = False,
    row_id: str = "row_id",
    starts: int = STARTS,
    methods: Sequence[str] = METHODS,
) -> dict:
    """Segmentation by three methods; the best mean silhouette wins (no score counts 0).

    Ties go to k-means, then hierarchical, then DBSCAN.
    """
    base = df if all_columns else segmentation_features(df, row_id)
    cols = numeric_columns(base, [row_id])
    scaled = durable(standardise(base.select(row_id, *cols), cols))
    results: dict[str, dict] = {}
    if "kmeans" in methods:
        results["KMeans"] = kmeans_sweep(scaled, cols, k_range, row_id, starts)
    if "hierarchical" in methods:
        results["Hierarchical"] = hierarchical_sweep(scaled, cols, k_range, row_id=row_id)
    if "dbscan" in methods:
        low, high = neighbor_distance_range(scaled, cols, row_id, sample=None)
        results["DBSCAN"] = dbscan_grid(scaled, cols, (low, high, SEGMENT_EPS_STEPS), SEGMENT_MIN_SAMPLES, row_id)
    scores = {m: found["silhouette"] or 0.0 for m, found in results.items()}
    best = max(scores, key=scores.get)
    return {
        "features": cols,
        "scores": from_rows(df.sparkSession, list(scores.items()), "method string, silhouette double"),
        "results": results,
        "method": best,
        "labels": results[best]["labels"],
        "n_clusters": results[best]["n_clusters"],
    }


def cluster_sizes(df: DataFrame, label: str = "prediction") -> DataFrame:
    """Rows and percentage per cluster."""
    counts = df.groupBy(F.col(label).alias("prediction")).agg(F.count(F.lit(1)).alias("count"))
    total = counts.agg(F.sum("count").alias("_total"))  # one row
    return counts.join(F.broadcast(total)).select("prediction", "count", (F.col("count") * 100.0 / F.col("_total")).alias("percentage"))


def cluster_profile(df: DataFrame, cols: Sequence[str], label: str = "prediction") -> DataFrame:
    """Mean of every column per cluster, wide: one aggregation."""
    return df.groupBy(F.col(label).alias("prediction")).agg(
        *[F.avg(F.col(f"`{c}`").cast("double")).alias(c) for c in cols]
    )


def cluster_medians(df: DataFrame, cols: Sequence[str], label: str = "prediction") -> DataFrame:
    """(prediction, feature, median), exact."""
    found = exact_quantiles(df, cols, [0.5], [label])
    kind = df.schema[label].dataType.simpleString()
    rows = [(key[0], c, v[0]) for key, per in found.items() for c, v in per.items()]
    return from_rows(df.sparkSession, rows, f"prediction {kind}, feature string, median double")


def between_cluster_variance(profile: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Sample variance of the cluster means per column."""
    return (
        wide_to_long(profile, cols, ["prediction"])
        .groupBy("feature")
        .agg(F.var_samp("value").alias("variance"))
    )


def most_variable(variances: DataFrame, cols: Sequence[str], n: int) -> list[str]:
    """The n columns with the largest variance, ties in column order."""
    place = {c: i for i, c in enumerate(cols)}
    rows = [(r["feature"], r["variance"]) for r in variances.collect()]
    rows.sort(key=lambda r: (r[1] is None, -(r[1] or 0.0), place[r[0]]))
    return [c for c, _ in rows[:n]]


def normalised_profile(profile: DataFrame, cols: Sequence[str], n: int | None = None) -> DataFrame:
    """Cluster means rescaled per column; with ``n``, of the n most variable columns."""
    long = rescaled_over_groups(wide_to_long(profile, cols, ["prediction"]), ["prediction"])
    if n is None or len(cols) <= n:
        return long
    spread = long.groupBy("feature").agg(F.var_samp("scaled").alias("variance"))
    return long.where(F.col("feature").isin(most_variable(spread, cols, n)))


def segment_dashboard(
    df: DataFrame, cols: Sequence[str] | None = None, label: str = "prediction", row_id: str = "row_id", n: int | None = None
) -> dict[str, DataFrame]:
    """Sizes, boxes and medians of the columns (with ``n``, the most telling ones), and the scaled profile."""
    cols = list(cols) if cols is not None else numeric_columns(df, [label, row_id])
    profile = cluster_profile(df, cols, label)
    shown = cols
    if n is not None and len(cols) > n:
        shown = most_variable(between_cluster_variance(profile, cols), cols, n)
    profile_long = wide_to_long(profile, shown, ["prediction"])
    return {
        "sizes": cluster_sizes(df, label),
        "boxes": box_statistics(df, shown, [label]),
        "medians": cluster_medians(df, shown, label),
        "profile": rescaled_over_groups(profile_long, ["prediction"], constant=0.0),
    }


def pair_plot_data(
    df: DataFrame, labels: DataFrame, cols: Sequence[str], row_id: str = "row_id", n: int | None = None
) -> DataFrame:
    """The columns (with ``n``, those of largest variance) with the cluster of each row."""
    shown = list(cols)
    if n is not None and len(shown) > n:
        spread = wide_to_long(df, shown).groupBy("feature").agg(F.var_samp("value").alias("variance"))
        shown = most_variable(spread, shown, n)
    return df.select(row_id, *[F.col(f"`{c}`") for c in shown]).join(labels.select(row_id, "prediction"), row_id)


def cluster_overview(
    df: DataFrame, labels: DataFrame, cols: Sequence[str], row_id: str = "row_id", n: int | None = None
) -> dict[str, DataFrame]:
    """Projection with cluster, sizes, and boxes of the original columns (with ``n``, the first n)."""
    labelled = df.join(labels.select(row_id, "prediction"), row_id)
    return {
        "projection": project(df, cols, 2, [row_id]).join(labels.select(row_id, "prediction"), row_id),
        "sizes": cluster_sizes(labelled),
        "boxes": box_statistics(labelled, list(cols)[:n], ["prediction"]),
    }


def clustering_report(df: DataFrame, labels: DataFrame, cols: Sequence[str], row_id: str = "row_id") -> dict[str, DataFrame]:
    """Projection, silhouettes, dashboard tables and the indices."""
    labelled = df.join(labels.select(row_id, "prediction"), row_id)
    tables = {
        "projection": project(df, cols, 2, [row_id]).join(labels.select(row_id, "prediction"), row_id),
        "silhouettes": silhouette_samples(labelled, cols, row_id=row_id),
        "scores": clustering_scores(labelled, cols, row_id=row_id),
    }
    tables.update({f"dashboard_{k}": v for k, v in segment_dashboard(labelled, cols, row_id=row_id).items()})
    return tables
