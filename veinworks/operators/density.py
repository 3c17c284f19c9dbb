"""Density-based clustering (DBSCAN) as joins and aggregations.

Identical rows are merged first. Space is cut into small cells whose diameter
is ``eps``: all rows of a cell are neighbours, so a cell with ``min_samples``
rows needs no distances at all and dense regions cost no more than sparse ones.
Clusters are the connected components of cells, not of rows.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from veinworks.functions.numeric import linspace, squared_distance
from veinworks.operators.correlation import correlations
from veinworks.operators.graph import connected_components
from veinworks.operators.neighbors import around
from veinworks.operators.ranking import best_row, valid_settings
from veinworks.operators.silhouette import mean_silhouettes
from veinworks.session import durable, from_rows

NOISE = -1
GRID_DIMENSIONS = 3
ROWS_PER_SALT = 20_000
EDGE_SLACK = 1e-12

# Settings used when no setting of a sweep is valid.
DEFAULT_EPS, DEFAULT_MIN_SAMPLES = 0.5, 5
# The plain eps sweep (ten values, min_samples 5).
PLAIN_EPS = (0.1, 2.0, 10)
PLAIN_MIN_SAMPLES = 5


def _grid_axes(df: DataFrame, cols: Sequence[str]) -> list[Column]:
    """Up to three coordinates for candidate cells.

    Beyond three columns these are the leading principal axes. A projection
    never makes a distance longer, so no neighbour is missed.
    """
    cols = list(cols)
    if len(cols) <= GRID_DIMENSIONS:
        return [F.col(c) for c in cols]
    stats = df.agg(
        *[F.avg(c).alias(f"m{i}") for i, c in enumerate(cols)],
        *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(cols)],
    ).first()
    std = np.array([stats[f"s{i}"] or 0.0 for i in range(len(cols))])
    corr = np.eye(len(cols))
    for (a, b), r in correlations(df, cols).items():
        i, j = cols.index(a), cols.index(b)
        corr[i, j] = corr[j, i] = r or 0.0
    _, axes = np.linalg.eigh(corr * std[:, None] * std[None, :])
    out = []
    for d in range(1, GRID_DIMENSIONS + 1):
        total = F.lit(0.0)
        for i, c in enumerate(cols):
            total = total + (F.col(c) - F.lit(stats[f"m{i}"] or 0.0)) * F.lit(float(axes[i, -d]))
        out.append(total)
    return out


def _near(left: Sequence[str], right: Sequence[str], eps: float) -> Column:
    return F.sqrt(squared_distance([F.col(c) for c in left], [F.col(c) for c in right])) <= F.lit(eps)


class _Space:
    """Distinct points with their small cell and candidate cell, written once."""

    def __init__(self, df: DataFrame, cols: Sequence[str], eps: float, row_id: str):
        self.cols, self.eps = list(cols), eps
        self.coords = [f"x{i}" for i in range(len(self.cols))]
        rows = df.select(
            F.col(row_id).alias("row"), *[(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(x) for c, x in zip(self.cols, self.coords)]
        )
        self.rows = rows
        side = eps / math.sqrt(len(self.cols)) * (1 - 1e-9)
        distinct = rows.groupBy(*self.coords).agg(F.count(F.lit(1)).alias("weight"), F.min("row").alias("point"))
        axes = _grid_axes(distinct, self.coords)
        self.marks = [f"g{i}" for i in range(len(axes))]
        self.points = durable(
            distinct.select(
                "*",
                F.array(*[F.floor(F.col(x) / F.lit(side)) for x in self.coords]).alias("cell"),
                *[F.floor(a / F.lit(eps)).alias(m) for a, m in zip(axes, self.marks)],
            )
        )
        busiest = self.points.groupBy(*self.marks).count().agg(F.max("count")).first()[0] or 0
        self.salts = max(1, math.ceil(busiest / ROWS_PER_SALT))

    def meet(self, asking: DataFrame, data: DataFrame) -> DataFrame:
        """Pairs in neighbouring candidate cells; crowded cells are salted.

        ``asking`` columns get the prefix ``q_``. The pairs stream into the
        aggregation that follows and are never written.
        """
        keep = [c for c in asking.columns if c not in self.marks]
        q = asking.select(*[F.col(c).alias(f"q_{c}") for c in keep], F.inline(around(self.marks)))
        q = q.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(self.salts - 1))))
        d = data.withColumn("salt", F.pmod(F.xxhash64("point"), F.lit(self.salts)).cast("int"))
        return q.join(d, [*self.marks, "salt"])


def reaches(space: _Space, most: int) -> DataFrame:
    """Points with the rows in their cell and, where the cell holds fewer than
    ``most`` rows, the rows within eps. Serves every ``min_samples`` up to ``most``."""
    cells = space.points.groupBy("cell").agg(F.sum("weight").alias("cell_weight"))
    staged = space.points.join(cells, "cell")
    asking = staged.where(F.col("cell_weight") < most).select("point", *space.coords, *space.marks)
    data = space.points.select("point", "weight", *space.coords, *space.marks)
    counted = (
        space.meet(asking, data)
        .where(_near([f"q_{x}" for x in space.coords], space.coords, space.eps))
        .groupBy(F.col("q_point").alias("point"))
        .agg(F.sum("weight").alias("reach"))
    )
    return durable(staged.join(counted, "point", "left"))


def is_core(min_samples: int) -> Column:
    return F.greatest("cell_weight", F.coalesce("reach", F.lit(0))) >= min_samples


def _cell_components(space: _Space, core: DataFrame) -> DataFrame:
    """(cell, cluster): the smallest core row of the cell's component."""
    cells = durable(
        core.groupBy("cell").agg(
            F.min("point").alias("point"),
            *[F.min(x).alias(f"lo_{x}") for x in space.coords],
            *[F.max(x).alias(f"hi_{x}") for x in space.coords],
            # A cell is at most eps wide, so it touches two candidate cells per axis at most.
            F.collect_set(F.struct(*space.marks)).alias("touched"),
            F.array_distinct(
                F.array(
                    *[
                        pick(F.struct(*space.coords, *space.marks), x)
                        for x in space.coords
                        for pick in (F.min_by, F.max_by)
                    ]
                )
            ).alias("ends"),
        )
    )
    # First the extreme points of every cell: a handful per cell.
    ends = cells.select("cell", "point", F.inline("ends"))
    asking = ends.select(F.col("point").alias("node"), *space.coords, *space.marks)
    data = ends.select("point", *space.coords, *space.marks)
    first = (
        space.meet(asking, data)
        .where("q_node < point")
        .where(_near([f"q_{x}" for x in space.coords], space.coords, space.eps))
        .select(F.col("q_node").alias("a"), F.col("point").alias("b"))
        .distinct()
    )
    nodes = cells.select(F.col("point").alias("node"))
    rough = connected_components(nodes, first)
    placed = cells.drop("ends").join(rough.withColumnRenamed("node", "point"), "point")

    # Then all core rows, but only between components, and only where the
    # bounding boxes of two cells leave room for a pair within eps.
    edges_of = [f"{e}_{x}" for x in space.coords for e in ("lo", "hi")]
    sides = {
        s: placed.select(
            F.col("point").alias(s), F.col("component").alias(f"c{s}"),
            *[F.col(c).alias(f"{s}_{c}") for c in edges_of], F.inline("touched"),
        )
        for s in ("a", "b")
    }
    left = sides["a"].select(*[c for c in sides["a"].columns if c not in space.marks], F.inline(around(space.marks)))
    gap = None
    for x in space.coords:
        apart = F.greatest(F.col(f"a_lo_{x}") - F.col(f"b_hi_{x}"), F.col(f"b_lo_{x}") - F.col(f"a_hi_{x}"), F.lit(0.0))
        gap = apart * apart if gap is None else gap + apart * apart
    reach = space.eps * space.eps * (1 + 1e-9)
    open_pairs = durable(
        left.join(sides["b"], space.marks).where("ca < cb").where(gap <= reach).drop(*space.marks).distinct()
    )
    if open_pairs.isEmpty():
        return cells.select("cell", F.col("point").alias("node")).join(rough, "node").select(
            "cell", F.col("component").alias("cluster")
        )
    inner = core.join(cells.select("cell", F.col("point").alias("node")), "cell").select("node", *space.coords)
    to_box = None
    for x in space.coords:
        apart = F.greatest(F.col(f"b_lo_{x}") - F.col(x), F.col(x) - F.col(f"b_hi_{x}"), F.lit(0.0))
        to_box = apart * apart if to_box is None else to_box + apart * apart
    edge_side = open_pairs.join(inner.withColumnRenamed("node", "a"), "a").where(to_box <= reach)
    edge_side = edge_side.select("a", "b", "ca", "cb", *[F.col(x).alias(f"q_{x}") for x in space.coords])
    links = (
        edge_side.join(inner.withColumnRenamed("node", "b"), "b")
        .where(_near([f"q_{x}" for x in space.coords], space.coords, space.eps))
        .select(F.col("ca").alias("a"), F.col("cb").alias("b"))
        .distinct()
    )
    roots = rough.select(F.col("component").alias("node")).distinct()
    merged = connected_components(roots, links)
    final = rough.withColumnRenamed("component", "_root").join(
        merged.withColumnRenamed("node", "_root"), "_root"
    ).select("node", "component")
    return cells.select("cell", F.col("point").alias("node")).join(final, "node").select("cell", F.col("component").alias("cluster"))


def dbscan(
    df: DataFrame, cols: Sequence[str], eps: float, min_samples: int, row_id: str = "row_id"
) -> DataFrame:
    """(row_id, prediction, is_core) for every row.

    A cluster is named by its smallest core row id; noise is -1. A border row
    within reach of several clusters takes the smallest name. ``min_samples``
    counts the row itself.
    """
    space = _Space(df, cols, eps, row_id)
    return _labels(space, reaches(space, min_samples), min_samples, row_id)


def _labels(space: _Space, reached: DataFrame, min_samples: int, row_id: str) -> DataFrame:
    core = reached.where(is_core(min_samples)).drop("cell_weight", "reach")
    others = reached.where(~is_core(min_samples))
    core_named = core.join(_cell_components(space, core), "cell")
    border = (
        space.meet(
            others.select("point", *space.coords, *space.marks),
            core_named.select("point", "cluster", *space.coords, *space.marks),
        )
        .where(_near([f"q_{x}" for x in space.coords], space.coords, space.eps))
        .groupBy(F.col("q_point").alias("point"))
        .agg(F.min("cluster").alias("cluster"))
    )
    named = core_named.select("point", "cluster", F.lit(True).alias("is_core")).unionByName(
        border.select("point", "cluster", F.lit(False).alias("is_core"))
    )
    per_point = space.points.select("point", *space.coords).join(named, "point", "left")
    labelled = space.rows.join(per_point.drop("point"), space.coords, "left")
    return labelled.select(
        F.col("row").alias(row_id),
        F.coalesce("cluster", F.lit(NOISE)).cast("long").alias("prediction"),
        F.coalesce("is_core", F.lit(False)).alias("is_core"),
    )


def noise_and_clusters(labels: DataFrame, label: str = "prediction") -> DataFrame:
    """Rows, clusters without noise, and noise rows."""
    sizes = labels.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.count_if(F.col(label) != NOISE).alias("n_clusters"),
        F.coalesce(F.sum(F.when(F.col(label) == NOISE, F.col("n"))), F.lit(0)).alias("n_noise"),
    )


SWEEP_SCHEMA = "method string, eps double, min_samples int, n_clusters long, n_noise long, silhouette double"


def dbscan_settings(
    df: DataFrame, cols: Sequence[str], eps_values: Sequence[float], min_samples: Sequence[int], row_id: str = "row_id"
) -> DataFrame:
    """(row_id, setting, eps, min_samples, label) for every combination, written once.

    Neighbour counts are shared by all ``min_samples`` of an eps, and different
    eps run side by side.
    """
    points = df.select(row_id, *[F.col(f"`{c}`") for c in cols]).persist()

    def run(eps: float) -> list[DataFrame]:
        space = _Space(points, cols, eps, row_id)
        reached = reaches(space, max(min_samples))
        return [
            _labels(space, reached, m, row_id).select(
                row_id,
                F.lit(setting_name(eps, m)).alias("setting"),
                F.lit(float(eps)).alias("eps"),
                F.lit(int(m)).alias("min_samples"),
                F.col("prediction").alias("label"),
            )
            for m in min_samples
        ]

    try:
        with ThreadPoolExecutor(max_workers=min(len(eps_values), 8)) as pool:
            parts = [part for found in pool.map(run, eps_values) for part in found]
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return durable(out)
    finally:
        points.unpersist()


def setting_name(eps: float, min_samples: int) -> str:
    return f"{float(eps)!r}/{int(min_samples)}"


def _sweep(df, labels, cols, row_id, only_without_noise: bool) -> list[tuple]:
    """Counts of all settings in one aggregation, silhouettes of the scorable ones in one pass."""
    sizes = labels.groupBy("setting", "eps", "min_samples", "label").agg(F.count(F.lit(1)).alias("n"))
    counts = (
        sizes.groupBy("setting", "eps", "min_samples")
        .agg(
            F.sum("n").alias("n_rows"),
            F.count_if(F.col("label") != NOISE).alias("n_clusters"),
            F.coalesce(F.sum(F.when(F.col("label") == NOISE, F.col("n"))), F.lit(0)).alias("n_noise"),
        )
        .orderBy("eps", "min_samples")
        .collect()
    )
    fit = [
        r["setting"]
        for r in counts
        if r["n_clusters"] > 1
        and (r["n_noise"] == 0 if only_without_noise else r["n_rows"] - r["n_noise"] > r["n_clusters"])
    ]
    scores = {}
    if fit:
        scorable = labels.where(F.col("setting").isin(fit) & (F.col("label") != NOISE))
        scores = mean_silhouettes(df, scorable.select(row_id, "setting", "label"), cols, row_id)
    return [
        ("dbscan", r["eps"], r["min_samples"], r["n_clusters"], r["n_noise"], scores.get(r["setting"])) for r in counts
    ]


def _labels_of(labels: DataFrame, eps: float, min_samples: int, row_id: str) -> DataFrame:
    chosen = labels.where(F.col("setting") == setting_name(eps, min_samples))
    return chosen.select(row_id, F.col("label").alias("prediction"))


def dbscan_grid(
    df: DataFrame,
    cols: Sequence[str],
    eps_range: tuple[float, float, int] = (0.1, 1.0, 5),
    min_samples_range: tuple[int, int, int] = (5, 20, 4),
    row_id: str = "row_id",
) -> dict:
    """eps × min_samples sweep; noise is left out of the silhouette.

    Returns the sweep table, the valid settings, the chosen setting and its
    labels. Without a valid setting the defaults (0.5, 5) are used. Values of
    eps that are not above zero reach nobody and are left out.
    """
    eps_values = [e for e in linspace(*eps_range) if e > 0] or [DEFAULT_EPS]
    labels = dbscan_settings(df, cols, eps_values, linspace(*min_samples_range, integer=True), row_id)
    sweep = from_rows(df.sparkSession, _sweep(df, labels, cols, row_id, False), SWEEP_SCHEMA)
    valid = valid_settings(sweep, df.count())
    best = best_row(valid, "silhouette", ["eps", "min_samples"]).first()
    if best is None:
        labels = dbscan_settings(df, cols, [DEFAULT_EPS], [DEFAULT_MIN_SAMPLES], row_id)
        found = _labels_of(labels, DEFAULT_EPS, DEFAULT_MIN_SAMPLES, row_id)
        k = noise_and_clusters(found).first()["n_clusters"]
        return {"sweep": sweep, "valid": valid, "setting": (DEFAULT_EPS, DEFAULT_MIN_SAMPLES), "labels": found,
                "n_clusters": k, "silhouette": None}
    setting = (best["eps"], best["min_samples"])
    return {"sweep": sweep, "valid": valid, "setting": setting, "labels": _labels_of(labels, *setting, row_id),
            "n_clusters": best["n_clusters"], "silhouette": best["silhouette"]}


def dbscan_eps_sweep(
    df: DataFrame,
    cols: Sequence[str],
    eps_range: tuple[float, float, int] = PLAIN_EPS,
    min_samples: int = PLAIN_MIN_SAMPLES,
    row_id: str = "row_id",
) -> dict:
    """eps sweep where only runs without any noise get a silhouette (else -1)."""
    labels = dbscan_settings(df, cols, linspace(*eps_range), [min_samples], row_id)
    rows = [(*r[:5], -1.0 if r[5] is None else r[5]) for r in _sweep(df, labels, cols, row_id, True)]
    sweep = from_rows(df.sparkSession, rows, SWEEP_SCHEMA)
    best = best_row(sweep.where("silhouette > -1"), "silhouette", ["eps"]).first()
    return {
        "sweep": sweep,
        "setting": best["eps"] if best else None,
        "labels": _labels_of(labels, best["eps"], min_samples, row_id) if best else None,
        "n_clusters": best["n_clusters"] if best else None,
        "silhouette": best["silhouette"] if best else None,
    }
