"""Exact nearest-neighbour and distance joins.

No cross join and no pair table: rows are written once in blocks around a few
pivots, each bounded in size however many rows a group has. A task has a block of
queries and reads the blocks that may hold a neighbour one after another, the
nearest first; boxes and the triangle inequality rule out the others. Only the k
best are kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from veinworks.functions.numeric import squared_distance
from veinworks.operators.blocks import BLOCK_ROWS, SLACK, Block, deal, least_away, matrix, over_blocks, read, with_cell
from veinworks.operators.sampling import sample_rows
from veinworks.session import durable

ROUGH_CELLS = 1_000_000
EXACT_CELLS = 4_000_000
MAX_PIVOTS = 256
# Neighbours and sample size behind the data-driven eps range,
# and the percentiles that bound it.
EPS_NEIGHBORS = 50
EPS_SAMPLE = 1_000
EPS_LOW, EPS_HIGH = 0.05, 0.95


def _points(df: DataFrame, features, row_id, group) -> DataFrame:
    side = F.col(group).cast("string") if group else F.lit("")
    if isinstance(features, str):
        place = F.col(features).cast("array<double>")
    else:
        place = F.array(*[F.col(f"`{c}`").cast("double") for c in features])
    return df.select(
        F.col(row_id).cast("long").alias("id"), F.coalesce(side, F.lit("\u0000")).alias("grp"), place.alias("v")
    )


def _pivots(points: DataFrame, n: int) -> np.ndarray:
    chosen = sample_rows(points, int(min(MAX_PIVOTS, max(1, math.sqrt(n) / 2))), "id").collect()
    return np.array([r["v"] for r in chosen], dtype=float)


def _best_rows(ids: np.ndarray, places: np.ndarray, d_ids: np.ndarray, d_mat: np.ndarray, k: int, exclude_self: bool):
    """(row, id, distance) of the k best of a block, by row: a matrix product names the few rows whose distances are then taken exactly.

    The ids of the block ascend.
    """
    found, width = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))], places.shape[1]
    if len(ids) and len(d_ids):
        shift = d_mat.mean(0)
        step = max(1, ROUGH_CELLS // len(d_ids))
        for start in range(0, len(ids), step):
            own, mine = places[start : start + step], ids[start : start + step]
            with np.errstate(over="ignore", invalid="ignore"):
                near = _rough(own - shift, d_mat - shift, mine[:, None] == d_ids if exclude_self else None, k)
            row, col = near.nonzero()
            away = np.concatenate([
                np.sqrt(np.einsum("pw,pw->p", diff, diff))
                for at in range(0, len(row), max(1, EXACT_CELLS // width))
                for diff in [own[row[at : at + max(1, EXACT_CELLS // width)]] - d_mat[col[at : at + max(1, EXACT_CELLS // width)]]]
            ] or [np.zeros(0)])
            kept = np.isfinite(away)
            row, col, away = row[kept], col[kept], away[kept]
            order = np.lexsort((col, away, row))  # columns ascend with the id
            row, col, away = row[order], col[order], away[order]
            best = np.arange(len(row)) - np.searchsorted(row, row) < k
            found.append((row[best] + start, d_ids[col[best]], away[best]))
    return [np.concatenate(p) for p in zip(*found, strict=True)]


def _best_in_block(k: int, width: int, exclude_self: bool):
    """The k best of a block of (id, v) for each of a block of queries."""

    def run(queries: pd.DataFrame, data: pd.DataFrame) -> pd.DataFrame:
        (ids, places), known = (_places(pa.Table.from_pandas(part[["id", "v"]]), width) for part in (queries, data))
        row, near, away = _best_rows(ids, places, *known, k, exclude_self)
        return pd.DataFrame({"query_id": ids[row], "neighbor_id": near, "distance": away})

    return run


def _places(rows: pa.Table, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids, ascending, and places of the rows of a block that can be at a finite distance from any."""
    points, ids = matrix(rows["v"], width), rows["id"].to_pandas().to_numpy(dtype="int64")
    kept = np.flatnonzero(np.isfinite(points).all(1))
    kept = kept[ids[kept].argsort(kind="stable")]
    return ids[kept], points[kept]


def _look(asked: list[Block], known: list[Block], k: int, width: int, exclude_self: bool):
    """Of a block of queries the k best of all rows of its group, block by block, the nearest blocks first.

    A block is read for those queries only that it may hold a better row for.
    """
    by_group: dict = {}
    for block in known:
        by_group.setdefault(block.key[0], []).append(block)

    def run(i: int) -> Iterator[pa.RecordBatch]:
        ids, places = _places(read(asked[i].path), width)
        others = by_group.get(asked[i].key[0], [])
        best, who = np.full((len(ids), k), np.inf), np.full((len(ids), k), np.iinfo(np.int64).max)
        if len(ids) and others:
            lower = least_away(places, others)
            for j in lower.min(0).argsort(kind="stable"):
                need = np.flatnonzero(lower[:, j] <= best[:, -1] * (1 + SLACK) + SLACK)
                if not len(need):
                    continue
                row, near, away = _best_rows(ids[need], places[need], *_places(read(others[j].path), width), k, exclude_self)
                place = np.arange(len(row)) - np.searchsorted(row, row)
                new, name = np.full((len(need), k), np.inf), np.full((len(need), k), np.iinfo(np.int64).max)
                new[row, place], name[row, place] = away, near
                new, name = np.concatenate([best[need], new], axis=1), np.concatenate([who[need], name], axis=1)
                order = np.lexsort((name, new), axis=1)[:, :k]
                best[need], who[need] = np.take_along_axis(new, order, 1), np.take_along_axis(name, order, 1)
        row, rank = np.isfinite(best).nonzero()
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[row]), pa.array(who[row, rank]), pa.array(best[row, rank]), pa.array((rank + 1).astype("int32"))],
            ["query_id", "neighbor_id", "distance", "rank"],
        )

    return run


def _rough(own: np.ndarray, data: np.ndarray, barred: np.ndarray | None, k: int) -> np.ndarray:
    """Which rows of ``data`` may be among the k nearest: all within rounding of the k-th squared distance."""
    own_sq, data_sq = (own * own).sum(1), (data * data).sum(1)
    gaps = own_sq[:, None] + data_sq - 2 * own @ data.T
    slack = 16 * (own.shape[1] + 8) * np.finfo(float).eps * (own_sq + data_sq.max())
    open_ = np.ones(gaps.shape, bool) if barred is None else ~barred
    if not np.isfinite(slack).all():  # squares beyond the range of numbers
        return open_
    gaps[~open_] = np.inf
    kth = np.partition(gaps, min(k, len(data)) - 1, axis=1)[:, min(k, len(data)) - 1]
    return open_ & (gaps <= (kth + 2 * slack)[:, None])


def nearest_neighbors(
    data: DataFrame,
    features: Sequence[str] | str,
    k: int,
    queries: DataFrame | None = None,
    row_id: str = "row_id",
    group: str | None = None,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) of the k nearest rows, Euclidean.

    Without ``queries`` each row looks among the other rows of the table. With
    ``group`` only rows of the same group are neighbours. Ties go to the
    smaller id. ``features`` are columns, or the name of one array column.
    """
    spark = data.sparkSession
    same = queries is None
    points = _points(data, features, row_id, group)
    asked = points if same else _points(queries, features, row_id, group)
    n = points.count()
    schema = "query_id long, neighbor_id long, distance double, rank int"
    if n == 0:
        return spark.createDataFrame([], schema)
    pivots = _pivots(points, n)
    width = pivots.shape[1]
    known = deal(with_cell(points, pivots), width, ["grp", "cell"], "id", block_rows)
    looked = known if same else deal(with_cell(asked, pivots), width, ["grp", "cell"], "id", block_rows)
    found = over_blocks(spark, len(looked), _look(looked, known, k, width, same), schema)
    if asked.groupBy("id").count().where("count > 1").isEmpty():
        return found
    w = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")  # equal ids share their neighbours
    return found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def neighbor_votes(neighbors: DataFrame, labels: DataFrame, row_id: str = "row_id", label: str = "label") -> DataFrame:
    """(query_id, prediction, score): majority label of the neighbours.

    ``score`` is the share of neighbours with label 1; ties go to the smaller label.
    """
    voted = neighbors.join(labels.select(F.col(row_id).alias("neighbor_id"), F.col(label).alias("_vote")), "neighbor_id")
    tally = voted.groupBy("query_id", "_vote").agg(F.count(F.lit(1)).alias("_n"))
    return tally.groupBy("query_id").agg(
        F.max_by(F.col("_vote"), F.struct("_n", -F.col("_vote"))).alias("prediction"),
        (F.sum(F.when(F.col("_vote") == 1, F.col("_n")).otherwise(0)) / F.sum("_n")).alias("score"),
    )


def neighbor_votes_by_k(
    neighbors: DataFrame, labels: DataFrame, ks: Sequence[int], row_id: str = "row_id", label: str = "label"
) -> DataFrame:
    """(query_id, k, prediction, score) for many k at once, 0/1 labels.

    The running share of ones along the ranks of a query answers every k; a k
    beyond the last neighbour is answered by all of them.
    """
    voted = neighbors.join(labels.select(F.col(row_id).alias("neighbor_id"), F.col(label).alias("_vote")), "neighbor_id")
    by_rank = Window.partitionBy("query_id").orderBy("rank")
    running = voted.select(
        "query_id",
        "rank",
        F.sum("_vote").over(by_rank.rowsBetween(Window.unboundedPreceding, 0)).alias("_ones"),
        F.max("rank").over(Window.partitionBy("query_id")).alias("_last"),
    )
    wanted = F.array(*[F.lit(int(k)) for k in ks])
    mine = F.filter(wanted, lambda k: F.least(k, F.col("_last")) == F.col("rank"))
    return running.select("query_id", F.explode(mine).alias("k"), "rank", "_ones").select(
        "query_id",
        "k",
        (F.col("_ones") * 2 > F.col("rank")).cast("int").alias("prediction"),
        (F.col("_ones") / F.col("rank")).alias("score"),
    )


def classify_by_neighbors(
    train: DataFrame, test: DataFrame, features: Sequence[str] | str, k: int = 5, row_id: str = "row_id", label: str = "label"
) -> DataFrame:
    """k-nearest-neighbour classification of ``test`` rows: (row_id, prediction, score)."""
    near = nearest_neighbors(train, features, k, queries=test, row_id=row_id)
    return neighbor_votes(near, train, row_id, label).withColumnRenamed("query_id", row_id)


def _grid(cols: Sequence[str], size: float) -> list[Column]:
    return [F.floor(F.col(c) / F.lit(size)) for c in cols]


def around(cells: Sequence[str]) -> Column:
    """Array of all neighbouring grid cells (a cell itself included)."""
    out = [[]]
    for c in cells:
        out = [[*o, F.col(c) + F.lit(d)] for o in out for d in (-1, 0, 1)]
    return F.array(*[F.struct(*[x.alias(c) for x, c in zip(o, cells)]) for o in out])


def pairs_within(df: DataFrame, cols: Sequence[str], eps: float, row_id: str = "row_id", grid: int = 3) -> DataFrame:
    """Pairs (left_id < right_id) of rows at most ``eps`` apart, with the distance.

    An equi-join on grid cells of size ``eps`` over the leading coordinates,
    each row meeting only its neighbouring cells, then the exact test.
    """
    cols = list(cols)
    lead = cols[:grid]
    marks = [f"_g{i}" for i in range(len(lead))]
    base = df.select(row_id, *[F.col(c).cast("double").alias(c) for c in cols]).withColumns(
        dict(zip(marks, _grid(lead, eps)))
    )
    left = base.select(F.col(row_id).alias("left_id"), *[F.col(c).alias(f"_l_{c}") for c in cols], F.inline(around(marks)))
    right = base.select(F.col(row_id).alias("right_id"), *cols, *marks)
    away = F.sqrt(squared_distance([F.col(f"_l_{c}") for c in cols], [F.col(c) for c in cols]))
    return (
        left.join(right, marks)
        .where("left_id < right_id")
        .select("left_id", "right_id", away.alias("distance"))
        .where(F.col("distance") <= eps)
    )


def neighbor_distance_range(
    df: DataFrame, cols: Sequence[str], row_id: str = "row_id", seed: int = 42, sample: int | None = EPS_SAMPLE
) -> tuple[float, float]:
    """5th and 95th percentile of neighbour distances on a scaled sample: an eps range.

    The rule looks at ``sample`` rows, up to 49 neighbours each; ``None`` takes
    all rows, as the segmentation does.
    """
    from veinworks.operators.quantiles import exact_quantiles
    from veinworks.operators.scaling import standardise

    rows = df.select(row_id, *cols)
    scaled = standardise(rows if sample is None else sample_rows(rows, sample, row_id, seed), cols)
    near = durable(nearest_neighbors(scaled, cols, EPS_NEIGHBORS - 1, row_id=row_id))
    low, high = exact_quantiles(near, ["distance"], [EPS_LOW, EPS_HIGH])[()]["distance"]
    return low, high
