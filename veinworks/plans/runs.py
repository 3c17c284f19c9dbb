"""End-to-end runs: prepare, select, model, evaluate, report."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from veinworks.functions.numeric import numeric_columns
from veinworks.operators.classification import compare_models, feature_importances, save_fitted
from veinworks.operators.clustering import cluster_profile, cluster_sizes, segment_dashboard, segmentation
from veinworks.operators.columns import keep_important, require_column
from veinworks.operators.sampling import split_rows
from veinworks.operators.scoring import classification_report
from veinworks.operators.selection import select_features, selection_report
from veinworks.plans.preprocess import Preprocess
from veinworks.plans.settings import Settings
from veinworks.session import durable
from veinworks.sources.tables import (
    classification_summary, clustering_summary, report, write_run, write_tables,
)


def prepare(df: DataFrame, s: Settings):
    """(fitted preparation, prepared rows written once)."""
    model = Preprocess(
        rowId=s.row_id, label=s.label or "", missingThreshold=s.missing_threshold, maxCategories=s.max_categories,
        correlationThreshold=s.correlation_threshold, asOf=s.as_of,
    ).fit(df)
    return model, durable(model.transform(df))


def run_classification(df: DataFrame, s: Settings) -> dict:
    """Prepare → select → split → oversample → tune → compare → report."""
    require_column(df, s.label)
    model, prepared = prepare(df, s)
    features = numeric_columns(prepared, [s.row_id, s.label])
    train, test = split_rows(prepared, s.test_fraction, s.row_id, s.seed)
    curve = None
    if s.select:
        found = select_features(
            train, s.label, "classification", s.n_features, s.downsample, s.row_id, features, **s.options
        )
        features, curve = found["features"], found["curve"]
        if s.importance_threshold is not None:
            kept = {r["feature"] for r in keep_important(found["importances"], s.importance_threshold).collect()}
            features = [f for f in features if f in kept] or features
    result = compare_models(
        train, test, features, s.label, s.row_id, s.models, s.search, s.metric, s.n_samples, s.balance
    )
    best = result["scored"].where(F.col("model") == result["best"].name)
    tables = {
        "leaderboard": result["leaderboard"],
        "selected_features": selection_report(df.sparkSession, "classification", features),
        **classification_report(best),
    }
    if curve is not None:
        tables["elimination_curve"] = curve
    importances = feature_importances(result["best"])
    if importances is not None:
        tables["importances"] = importances
    summary = classification_summary(result, features, df.count(), len(df.columns))
    tables["summary"] = report(df.sparkSession, summary)
    _write(tables, prepared, s)
    if s.output:
        save_fitted(result["best"], f"{s.output}/{s.run_id}/model", df.sparkSession)
    return {**result, "preparation": model, "prepared": prepared, "features": features, "tables": tables}


def run_clustering(df: DataFrame, s: Settings) -> dict:
    """Prepare → rank features → segment by every method → profile → report."""
    model, prepared = prepare(df, s)
    features = numeric_columns(prepared, [s.row_id] + ([s.label] if s.label else []))
    if s.select:
        found = select_features(prepared, None, "clustering", s.n_features, row_id=s.row_id, cols=features)
        features = found["features"]
    narrow = prepared.select(s.row_id, *[F.col(f"`{c}`") for c in features])
    result = segmentation(narrow, s.k_range, all_columns=True, row_id=s.row_id, starts=s.starts, methods=s.methods)
    labelled = durable(df.join(result["labels"].select(s.row_id, "prediction"), s.row_id))
    result["sizes"] = cluster_sizes(labelled)
    tables = {
        "sizes": result["sizes"],
        "profile": cluster_profile(
            narrow.join(result["labels"].select(s.row_id, "prediction"), s.row_id), features
        ),
        "scores": result["scores"],
        "selected_features": selection_report(df.sparkSession, "clustering", features),
        **{f"sweep_{m}": found["sweep"] for m, found in result["results"].items()},
        **{f"dashboard_{k}": v for k, v in segment_dashboard(labelled, label="prediction", row_id=s.row_id).items()},
    }
    shape = (df.count(), len(df.columns))
    summary = clustering_summary(result, features, shape, (shape[0], len(prepared.columns) - 1))
    tables["summary"] = report(df.sparkSession, summary)
    _write(tables, prepared, s)
    if s.output:
        write_run(labelled, f"{s.output}/labelled", s.run_id)
    return {**result, "preparation": model, "prepared": prepared, "features": features, "labelled": labelled, "tables": tables}


def _write(tables: dict, prepared: DataFrame, s: Settings) -> None:
    if s.output:
        write_tables(tables, f"{s.output}/{s.run_id}")
        write_run(prepared, f"{s.output}/prepared", s.run_id)


def run(df: DataFrame, settings: Settings) -> dict:
    """The run that the task of the settings asks for."""
    if settings.task == "classification":
        return run_classification(df, settings)
    return run_clustering(df, settings)


