"""How well separated clusters are.

``sqeuclidean`` and ``cosine`` need one pass for cluster sums and one for the
scores. ``manhattan`` sums, column by column, the distances to all rows of a
cluster from running counts and totals along the sorted values: n log n, without
a pair of rows. The ``euclidean`` form needs every distance, so its cost grows
with the square of the rows; it is meant for samples and moderate tables.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from veinworks.operators.blocks import deal, matrix, over_blocks, read
from veinworks.operators.quantiles import running_totals
from veinworks.session import from_rows

MAX_CENTERS = 20_000_000  # clusters × columns sent to executors
BLOCK_ROWS = 2_000
CELLS = 1_000_000
PARTS_PER_CORE = 2
CLOSE = 1e-6  # of the squared lengths: nearer pairs are measured by their differences
METRICS = ("sqeuclidean", "euclidean", "manhattan", "cosine")


def cluster_sums(df: DataFrame, cols: Sequence[str], label: str) -> list:
    """Size, sum per column and sum of squares of each cluster, on centred columns."""
    cols = list(cols)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    shift = [means[f"m{i}"] or 0.0 for i in range(len(cols))]
    moved = [F.col(f"`{c}`").cast("double") - F.lit(shift[i]) for i, c in enumerate(cols)]
    squares = None
    for m in moved:
        squares = m * m if squares is None else squares + m * m
    rows = (
        df.groupBy(F.col(label).alias("label"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(squares).alias("q"),
            *[F.sum(m).alias(f"s{i}") for i, m in enumerate(moved)],
        )
        .collect()
    )
    if len(rows) * len(cols) > MAX_CENTERS:
        raise ValueError(f"{len(rows)} clusters × {len(cols)} columns are too many to compare each row with")
    return [shift, sorted(rows, key=lambda r: r["label"])]


def silhouette_samples(
    df: DataFrame, cols: Sequence[str], label: str = "prediction", row_id: str = "row_id", metric: str = "sqeuclidean"
) -> DataFrame:
    """(row_id, label, silhouette) per row: (b - a) / max(a, b), 0 for singletons.

    NULL when there is only one cluster. With ``cosine`` a row of zeros is at
    distance 1 from every other row.
    """
    if metric == "euclidean":
        return _exact_samples(df, list(cols), label, row_id)
    if metric == "manhattan":
        return _manhattan_samples(df, list(cols), label, row_id)
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    cols = list(cols)
    if metric == "cosine":
        df, cols = _unit_rows(df, cols, label, row_id)
    shift, sums = cluster_sums(df, cols, label)
    shift = np.array(shift)
    labels = [r["label"] for r in sums]
    n = np.array([r["n"] for r in sums], dtype=float)
    q = np.array([r["q"] for r in sums], dtype=float)
    s = np.array([[r[f"s{i}"] for i in range(len(cols))] for r in sums], dtype=float).reshape(len(sums), -1)
    place = {c: i for i, c in enumerate(labels)}

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(labels) < 2:
                value = np.full(len(batch), np.nan)
            else:
                x = np.array(batch["v"].tolist(), dtype=float).reshape(len(batch), -1)
                own = batch["label"].map(place).to_numpy()
                value = _cosine_scores(x, own, n, s + n[:, None] * shift) if metric == "cosine" else _scores(x - shift, own, n, q, s)
            yield pd.DataFrame({"row_id": batch["row_id"], "label": batch["label"], "silhouette": value})

    points = df.select(
        F.col(row_id).alias("row_id"),
        F.col(label).alias("label"),
        F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("v"),
    )
    kind = points.schema["row_id"].dataType.simpleString()
    out = points.mapInPandas(score, f"row_id {kind}, label {points.schema['label'].dataType.simpleString()}, silhouette double")
    named = out.select(
        F.col("row_id").alias(row_id), F.col("label").alias(label),
        F.when(~F.isnan("silhouette"), F.col("silhouette")).alias("silhouette"),
    )
    return named


def _unit_rows(df, cols, label, row_id):
    """Rows of length 1 (zeros stay), as columns u0, u1 ..., with their names."""
    values = [F.col(f"`{c}`").cast("double") for c in cols]
    length = F.sqrt(sum((v * v for v in values[1:]), values[0] * values[0]))
    units = [F.coalesce(F.try_divide(v, length), F.lit(0.0)).alias(f"u{i}") for i, v in enumerate(values)]
    return df.select(row_id, label, *units), [f"u{i}" for i in range(len(cols))]


def _manhattan_samples(df, cols, label, row_id):
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    sizes = {r[0]: r[1] for r in df.groupBy(label).count().orderBy(label).collect()}  # one row per cluster
    names, every = list(sizes), range(len(sizes))
    cells = F.array(*[
        F.struct(F.lit(i).alias("dim"), (F.col(f"`{c}`").cast("double") - F.lit(means[f"m{i}"] or 0.0)).alias("value"))
        for i, c in enumerate(cols)
    ])
    points = df.select(F.col(row_id).alias("id"), F.col(label).alias("label"), F.inline(cells))
    # Equal values are one row: however many rows share a value, no range is crowded.
    values = points.groupBy("dim", "value").agg(*[F.count_if(F.col("label") == name).alias(f"n{k}") for k, name in enumerate(names)])
    totals = values.groupBy("dim").agg(*[F.sum(F.col(f"n{k}") * F.col("value")).alias(f"t{k}") for k in every])
    below = {f"c{k}": F.col(f"n{k}") for k in every} | {f"s{k}": F.col(f"n{k}") * F.col("value") for k in every}
    placed = running_totals(values, "value", below, by=["dim"]).join(totals, "dim")
    away = [
        F.col("value") * (2 * F.col(f"c{k}") - F.lit(sizes[name])) + F.col(f"t{k}") - 2 * F.col(f"s{k}") for k, name in enumerate(names)
    ]
    found = points.join(placed.select("dim", "value", *[a.alias(f"a{k}") for k, a in enumerate(away)]), ["dim", "value"])
    sums = found.groupBy("id", "label").agg(*[F.sum(f"a{k}").alias(f"a{k}") for k in every])
    clusters = F.array(*[
        F.struct((F.col("label") == name).alias("own"), F.lit(sizes[name]).alias("n"), F.greatest(F.lit(0.0), F.col(f"a{k}")).alias("total"))
        for k, name in enumerate(names)
    ])
    own = F.get(F.filter(clusters, lambda c: c["own"]), F.lit(0))
    size, total = own["n"], own["total"]
    b = F.array_min(F.transform(F.filter(clusters, lambda c: ~c["own"]), lambda c: c["total"] / c["n"]))
    return _named_scores(sums.select("id", "label", size.alias("size"), F.try_divide(total, size - 1).alias("a"), b.alias("b")), label, row_id)


def _named_scores(rows: DataFrame, label: str, row_id: str) -> DataFrame:
    """(row_id, label, silhouette) from the size of a row's cluster and its mean distances a and b."""
    value = F.when(F.col("b").isNull(), None).when(F.col("size") == 1, 0.0).otherwise(
        F.coalesce(F.try_divide(F.col("b") - F.col("a"), F.greatest("a", "b")), F.lit(0.0))
    )
    return rows.select(F.col("id").alias(row_id), F.col("label").alias(label), value.alias("silhouette"))


def _distances(q: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Euclidean distances of all rows to all: a matrix product, and differences where it would lose digits."""
    shift = d.mean(0)
    with np.errstate(over="ignore", invalid="ignore"):
        a, b = q - shift, d - shift
        scale = (a * a).sum(1)[:, None] + (b * b).sum(1)
        gaps = scale - 2 * a @ b.T
        row, col = (~(gaps > CLOSE * scale) | ~np.isfinite(gaps)).nonzero()
        for at in range(0, len(row), step := max(1, 4 * CELLS // d.shape[1])):
            r, c = row[at : at + step], col[at : at + step]
            diff = q[r] - d[c]
            gaps[r, c] = np.einsum("pw,pw->p", diff, diff)
    return np.sqrt(gaps)


def _exact_samples(df, cols, label, row_id):
    points = df.select(
        F.col(row_id).alias("id"),
        F.col(label).alias("label"),
        F.array(*[F.col(f"`{c}`").cast("double") for c in cols]).alias("v"),
    )
    sizes = points.groupBy(F.col("label").alias("other")).agg(F.count(F.lit(1)).alias("n"))
    names = [r["other"] for r in sizes.where("other is not null").orderBy("other").collect()]  # one per cluster
    known, width, code = deal(points.withColumn("part", F.lit(0)), len(cols), ["part"], "id", BLOCK_ROWS), len(cols), {n: i for i, n in enumerate(names)}
    kinds = {c: points.schema[c].dataType.simpleString() for c in ("id", "label")}
    arrow = to_arrow_schema(points.select("id", "label").schema)

    def run(i: int) -> Iterator[pa.RecordBatch]:
        own = read(known[i].path)
        x, some = matrix(own["v"], width), max(1, CELLS // max(1, len(names)))
        for low in range(0, len(x), some):
            q = x[low : low + some]
            totals = np.zeros((len(q), len(names)))
            for block in known:
                rows = read(block.path)
                codes = np.array([code.get(n, -1) for n in rows["label"].to_pylist()])
                d, codes = matrix(rows["v"], width)[codes >= 0], codes[codes >= 0]
                used, place = np.unique(codes, return_inverse=True)
                member = np.eye(len(used))[place]
                for start in range(0, len(q) if len(d) else 0, step := max(1, CELLS // max(1, len(d)))):
                    totals[start : start + step, used] += _distances(q[start : start + step], d) @ member
            part = own.slice(low, some)
            times = np.repeat(np.arange(len(q)), len(names))
            columns = [part[c].combine_chunks().take(pa.array(times)).cast(arrow.field(c).type) for c in ("id", "label")]
            others = pa.array(names, arrow.field("label").type).take(pa.array(np.tile(np.arange(len(names)), len(q))))
            told = pa.array(totals.ravel(), from_pandas=True)  # null where a row of the cluster has a gap
            yield pa.RecordBatch.from_arrays([*columns, others, told], ["id", "label", "other", "total"])

    # A row per row and cluster, whatever the number of blocks; equal ids are added up.
    totals = over_blocks(df.sparkSession, len(known), run, f"id {kinds['id']}, label {kinds['label']}, other {kinds['label']}, total double")
    joined = totals.groupBy("id", "label", "other").agg(F.sum("total").alias("total")).join(F.broadcast(sizes), "other")
    same = F.col("other") == F.col("label")
    per_row = joined.groupBy("id", "label").agg(
        F.max(F.when(same, F.col("n"))).alias("size"),
        F.max(F.when(same, F.try_divide("total", F.col("n") - 1))).alias("a"),
        F.min(F.when(~same, F.col("total") / F.col("n"))).alias("b"),
    )
    return _named_scores(per_row, label, row_id)


def mean_silhouette(
    df: DataFrame, cols: Sequence[str], label: str = "prediction", row_id: str = "row_id", metric: str = "sqeuclidean"
) -> float | None:
    """Mean over all rows; ``None`` unless there are at least two clusters."""
    return silhouette_samples(df, cols, label, row_id, metric).agg(F.avg("silhouette")).first()[0]


def mean_silhouettes(
    df: DataFrame, labels: DataFrame, cols: Sequence[str], row_id: str = "row_id"
) -> dict[str, float | None]:
    """Mean silhouette (squared Euclidean) of many labellings at once.

    ``labels`` holds (row_id, setting, label). A whole sweep costs one pass for
    the cluster sums of all settings and one for the scores.
    """
    cols = list(cols)
    means = df.agg(*[F.avg(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(cols)]).first()
    moved = [F.col(f"`{c}`").cast("double") - F.lit(means[f"m{i}"] or 0.0) for i, c in enumerate(cols)]
    # Both sides are dealt over all cores: their bytes are few, the scores of a row are not.
    spark = df.sparkSession
    parts = max(PARTS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    points = df.select(row_id, *[m.alias(f"x{i}") for i, m in enumerate(moved)]).repartition(parts, row_id)
    points = points.join(labels.repartition(parts, row_id), row_id)
    coords = [F.col(f"x{i}") for i in range(len(cols))]
    squares = None
    for x in coords:
        squares = x * x if squares is None else squares + x * x
    sums = (
        points.groupBy("setting", "label")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(squares).alias("q"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(coords)])
        .collect()
    )
    if len(sums) * len(cols) > MAX_CENTERS:
        raise ValueError(f"{len(sums)} clusters × {len(cols)} columns are too many to compare each row with")
    known: dict[str, tuple] = {}
    for setting in {r["setting"] for r in sums}:
        mine = [r for r in sums if r["setting"] == setting]
        known[setting] = (
            [r["label"] for r in mine],
            np.array([r["n"] for r in mine], dtype=float),
            np.array([r["q"] for r in mine], dtype=float),
            np.array([[r[f"s{i}"] for i in range(len(cols))] for r in mine], dtype=float),
        )

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = {}
        for batch in batches:
            codes = batch.column(0).dictionary_encode()
            place, x = codes.indices.to_numpy(zero_copy_only=False), batch.column(2).flatten().to_numpy(zero_copy_only=False).reshape(-1, len(cols))
            for i, setting in enumerate(codes.dictionary.to_pylist()):
                names, n, q, s = known[setting]
                if len(n) < 2:
                    continue
                rows = np.flatnonzero(place == i)
                own = pc.index_in(batch.column(1).take(pa.array(rows)), pa.array(names, batch.column(1).type)).to_numpy(zero_copy_only=False)
                value, count = totals.get(setting, (0.0, 0))
                totals[setting] = value + float(_scores(x[rows], own, n, q, s).sum()), count + len(rows)
        columns = [list(totals), [t for t, _ in totals.values()], [c for _, c in totals.values()]]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.float64(), pa.int64()), strict=True)], ["setting", "total", "n"])

    scored = points.select("setting", "label", F.array(*coords).alias("v")).mapInArrow(score, "setting string, total double, n long")
    rows = scored.groupBy("setting").agg((F.sum("total") / F.sum("n")).alias("mean")).collect()
    return {**{s: None for s in known}, **{r["setting"]: r["mean"] for r in rows}}


def _scores(x: np.ndarray, own: np.ndarray, n: np.ndarray, q: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Silhouettes of centred points from cluster sizes, squares and sums."""
    out = np.empty(len(x))
    step = max(1, 4_000_000 // len(n))
    for start in range(0, len(x), step):
        p, o = x[start : start + step], own[start : start + step]
        total = np.maximum((p * p).sum(axis=1)[:, None] * n - 2 * p @ s.T + q, 0.0)
        out[start : start + step] = _from_totals(total, o, n)
    return out


def _cosine_scores(x: np.ndarray, own: np.ndarray, n: np.ndarray, s: np.ndarray) -> np.ndarray:
    """Silhouettes of rows of length 1 (or 0) from cluster sizes and sums of such rows."""
    out = np.empty(len(x))
    step = max(1, 4_000_000 // len(n))
    for start in range(0, len(x), step):
        p, o = x[start : start + step], own[start : start + step]
        total = n - p @ s.T
        total[np.arange(len(p)), o] -= 1 - (p * p).sum(axis=1)  # a row is at no distance from itself
        out[start : start + step] = _from_totals(np.maximum(total, 0.0), o, n)
    return out


def _from_totals(total: np.ndarray, own: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Silhouettes from the summed distances of rows to all clusters."""
    rows = np.arange(len(total))
    a = total[rows, own] / np.maximum(n[own] - 1, 1)
    mean = total / n
    mean[rows, own] = np.inf
    b = mean.min(axis=1)
    top = np.maximum(a, b)
    with np.errstate(invalid="ignore", divide="ignore"):
        return np.where((n[own] == 1) | (top == 0), 0.0, (b - a) / top)


def silhouette_bands(samples: DataFrame, label: str = "prediction", row_id: str = "row_id") -> DataFrame:
    """Per row its place in the cluster's ascending silhouette order.

    A cluster may hold most rows, so places come from range-wise running counts
    rather than from a window over a whole cluster. Clusters are few.
    """
    placed = running_totals(samples, "silhouette", {"position": F.lit(1)}, by=[label], ties=[row_id])
    return placed.select(row_id, label, "silhouette", "position")


def _centers(df, cols, label):
    shift, sums = cluster_sums(df, cols, label)
    return shift, [(r["label"], r["n"], [r[f"s{i}"] / r["n"] for i in range(len(cols))], r["q"]) for r in sums]


def within_sum_of_squares(df: DataFrame, cols: Sequence[str], label: str = "prediction") -> float:
    """Inertia: squared distances of rows to the mean of their cluster."""
    _, centers = _centers(df, list(cols), label)
    return float(sum(q - n * float(np.dot(c, c)) for _, n, c, q in centers))


def calinski_harabasz(df: DataFrame, cols: Sequence[str], label: str = "prediction") -> float | None:
    """Between-cluster over within-cluster dispersion; ``None`` with one cluster."""
    _, centers = _centers(df, list(cols), label)
    n = sum(c[1] for c in centers)
    k = len(centers)
    if k < 2 or n <= k:
        return None
    between = sum(m * float(np.dot(c, c)) for _, m, c, _ in centers)
    within = sum(q - m * float(np.dot(c, c)) for _, m, c, q in centers)
    return (between / (k - 1)) / (within / (n - k)) if within > 0 else 1.0


def davies_bouldin(df: DataFrame, cols: Sequence[str], label: str = "prediction") -> float | None:
    """Mean over clusters of the worst (spread + spread) / centre distance."""
    cols = list(cols)
    shift, centers = _centers(df, cols, label)
    if len(centers) < 2:
        return None
    spark = df.sparkSession
    table = from_rows(
        spark, [(c[0], [x + s for x, s in zip(c[2], shift)]) for c in centers], f"_label {df.schema[label].dataType.simpleString()}, _center array<double>"
    )
    near = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
    gap = F.zip_with(near, "_center", lambda x, y: (x - y) * (x - y))
    away = F.sqrt(F.aggregate(gap, F.lit(0.0), lambda acc, v: acc + v))
    spread = {
        r["_label"]: r["s"]
        for r in df.join(F.broadcast(table), F.col(label) == F.col("_label")).groupBy("_label").agg(F.avg(away).alias("s")).collect()
    }
    worst = []
    for a in centers:
        ratios = []
        for b in centers:
            if a[0] != b[0]:
                dist = math.dist(a[2], b[2])
                ratios.append((spread[a[0]] + spread[b[0]]) / dist if dist else math.inf)
        worst.append(max(ratios))
    return sum(worst) / len(worst)


def clustering_scores(df: DataFrame, cols: Sequence[str], label: str = "prediction", row_id: str = "row_id") -> DataFrame:
    """One row (metric, value) per index; each silhouette names its distance."""
    rows = [
        ("silhouette_sqeuclidean", mean_silhouette(df, cols, label, row_id)),
        ("calinski_harabasz", calinski_harabasz(df, cols, label)),
        ("davies_bouldin", davies_bouldin(df, cols, label)),
        ("inertia", within_sum_of_squares(df, cols, label)),
    ]
    return from_rows(df.sparkSession, rows, "metric string, value double")
