"""Bottom-up hierarchies (ward, complete, average, single) of all rows.

Equal rows are one point that counts as many. While there are more clusters than
one matrix of their distances may hold, a round looks up the nearest other
cluster of each, block against block (``blocks``), and merges all pairs that are
nearest to each other at once: with these linkages a merged pair is never nearer
to a third cluster than its nearer part was, so merging them one by one ends in
the same hierarchy. ``single`` follows the nearest pair of points of every
cluster instead, which gives the minimum spanning tree. The last clusters are
merged two by two on the driver. All distances are those of the rows themselves,
whatever their number; only which of several equally near pairs is merged first
depends on the way.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from veinworks.operators import blocks as B
from veinworks.operators.graph import connected_components
from veinworks.operators.lloyd import vectors_of, with_nearest
from veinworks.operators.sampling import sample_rows
from veinworks.operators.silhouette import _distances
from veinworks.session import durable, from_rows

LINKAGES = ("ward", "complete", "average", "single")
MICRO = 500  # clusters whose distances fit one matrix on the driver
MAX_PIVOTS = 256
CELLS = 1_000_000
FEW_COLUMNS = 8
EDGE = "a long, b long, h double, turn long"


def merges(centers: np.ndarray, weights: np.ndarray, linkage: str = "ward", away: np.ndarray | None = None) -> list[tuple[int, int, float]]:
    """(a, b, distance): the pairs merged in turn, the merged pair keeps the smaller number.

    The nearest pair is merged, of equals the one with the smallest numbers.
    ``ward`` counts the growth of the squared deviations, the others distances;
    weights count for ``ward`` and ``average``. ``away`` has the distances of
    clusters that are no points.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}")
    n, w = len(weights), weights.astype(float).copy()
    if away is not None:
        d = away.copy()
    else:
        gaps = ((centers[:, None, :] - centers[None, :, :]) ** 2).sum(2)
        d = gaps * (w[:, None] * w[None, :]) / (w[:, None] + w[None, :]) if linkage == "ward" else np.sqrt(gaps)
    d[np.tril_indices(n)] = np.inf
    out, alive = [], np.ones(n, bool)
    for _ in range(n - 1):
        a, b = divmod(int(d.argmin()), n)
        away = float(d[a, b])
        others = np.flatnonzero(alive)
        others = others[(others != a) & (others != b)]
        to_a = np.minimum(d[np.minimum(a, others), np.maximum(a, others)], np.inf)
        to_b = d[np.minimum(b, others), np.maximum(b, others)]
        if linkage == "single":
            new = np.minimum(to_a, to_b)
        elif linkage == "complete":
            new = np.maximum(to_a, to_b)
        elif linkage == "average":
            new = (w[a] * to_a + w[b] * to_b) / (w[a] + w[b])
        else:
            new = ((w[a] + w[others]) * to_a + (w[b] + w[others]) * to_b - w[others] * away) / (w[a] + w[b] + w[others])
        d[np.minimum(a, others), np.maximum(a, others)] = new
        d[b, :], d[:, b] = np.inf, np.inf
        w[a] += w[b]
        alive[b] = False
        out.append((a, b, away))
    return out


def cut(merged: list[tuple[int, int, float]], n: int, k: int) -> np.ndarray:
    """The cluster of each of n clusters where k are left, named by its smallest member."""
    name = np.arange(n)
    for a, b, _ in merged[: max(0, n - k)]:
        name[name == b] = a
    return name


def numbered_points(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(name, n, v): the different rows without gaps, numbered from 0 in ascending order, and how many rows equal each."""
    whole = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x))
    points = vectors_of(df, cols).where(whole).groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    placed = durable(points.orderBy("v").withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33).cast("int")
    sizes = {r["part"]: r["n"] for r in placed.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()}
    starts = [sum(sizes.get(p, 0) for p in range(last)) for last in range(max(sizes, default=0) + 1)]
    first = F.element_at(F.array(*[F.lit(s).cast("long") for s in starts]), part + 1)
    return placed.select((first + F.col("at").bitwiseAND((1 << 33) - 1)).alias("name"), "n", "v")


def linkage_labels(
    df: DataFrame, cols: Sequence[str], ks: Sequence[int], linkage: str = "ward", row_id: str = "row_id", micro: int = MICRO,
) -> DataFrame:
    """(row_id, k2, k3, ...): the cluster of every row in one hierarchy of all rows, cut at each of ``ks``.

    Clusters are numbered from 0 by their smallest row id. ``micro`` is the
    number of clusters from which the driver goes on. There are never more
    clusters than different rows. Rows with a missing value get null.
    """
    if linkage not in LINKAGES:
        raise ValueError(f"linkage must be one of {LINKAGES}")
    cols = list(cols)
    rows = df.select(row_id, *[F.col(f"`{c}`") for c in cols])
    points = durable(numbered_points(df, cols))
    most, n = max(1, micro), points.count()
    if n <= most:
        found = points.orderBy("name").collect()
        centers, weights = np.array([r["v"] for r in found], float).reshape(n, len(cols)), np.array([r["n"] for r in found], float)
        tree, placed = merges(centers, weights, linkage) if n else [], durable(
            with_nearest(rows, cols, {"piece": centers}).select(row_id, "piece") if n else rows.select(row_id, F.lit(None).cast("long").alias("piece"))
        )
        pieces = list(range(n))
    else:
        edges = _tree(points, len(cols), linkage, most)
        left = min(max([1, *ks]), n)
        order = [F.desc(c) for c in ("h", "turn", "a", "b")]
        last = [tuple(r)[:3] for r in edges.orderBy(*order).limit(left - 1).collect()][::-1]  # those that no cut keeps all of
        cut_off = from_rows(df.sparkSession, [(a, b) for a, b, _ in last], "a long, b long")
        kept = edges.join(F.broadcast(cut_off), ["a", "b"], "left_anti")  # fewer than the largest k
        named = durable(connected_components(points.select(F.col("name").alias("node")), kept))
        ends = sorted({x for a, b, _ in last for x in (a, b)})
        piece_of = {r["node"]: r["component"] for r in named.where(F.col("node").isin(ends)).collect()} if ends else {}
        pieces = sorted(set(piece_of.values())) or [0]
        at = {p: i for i, p in enumerate(pieces)}
        tree = _renamed([(at[piece_of[a]], at[piece_of[b]], h) for a, b, h in last], len(pieces))
        values = F.array(*[F.col(f"`{c}`").cast("double") for c in cols])
        member = points.join(named, points["name"] == named["node"]).select(F.col("v").alias("_v"), F.col("component").alias("piece"))
        placed = durable(rows.withColumn("_v", values).join(member, "_v", "left").select(row_id, "piece"))
    firsts = {r["piece"]: r["first"] for r in placed.where("piece is not null").groupBy("piece").agg(F.min(row_id).alias("first")).collect()}
    columns = []
    for k in ks:
        name = cut(tree, len(pieces), k).tolist()
        first: dict = {}
        for piece, cluster in zip(pieces, name, strict=True):
            first[cluster] = _least(first.get(cluster), firsts.get(piece))
        order = {c: i for i, c in enumerate(sorted(first, key=lambda c: (first[c] is None, first[c])))}
        columns.append([order[c] for c in name])
    spark, names = df.sparkSession, [f"k{k}" for k in ks]
    table = from_rows(spark, list(zip(pieces, *columns, strict=True)), ", ".join(["piece long", *(f"{n} long" for n in names)]))
    return durable(placed.join(F.broadcast(table), "piece", "left").select(row_id, *names))  # at most ``micro`` or k rows are sent


def _least(a, b):
    return b if a is None else a if b is None else min(a, b)


def _renamed(tree: list[tuple[int, int, float]], n: int) -> list[tuple[int, int, float]]:
    """The same merges between the names that clusters have by then: their smallest members."""
    name, out = list(range(n)), []
    for a, b, h in tree:
        a, b = sorted((name[a], name[b]))
        name = [a if x == b else x for x in name]
        out.append((a, b, h))
    return out


# --------------------------------------------------- rounds over all clusters


def _tree(points: DataFrame, width: int, linkage: str, most: int) -> DataFrame:
    """(a, b, h, turn): the merges of all points, as edges between points, with their heights."""
    spark = points.sparkSession
    sample = sample_rows(points, int(min(MAX_PIVOTS, max(1, points.count() ** 0.5 / 2))), "name").collect()
    pivots = np.array([r["v"] for r in sample], float)
    if linkage == "single":
        return _spanning_tree(points, pivots, most)
    # A row is a point, or with ward a whole cluster and its centre; ``cluster`` is the smallest point, ``h`` the height so far.
    state, left, turn, edges = points.select("name", "n", "v", F.col("name").alias("cluster"), F.lit(0.0).alias("h")), points.count(), 0, None
    while left > most:
        near = durable(_nearest_centers(state, pivots) if linkage == "ward" else _nearest_clusters(state, width, linkage))
        back = near.select(F.col("a").alias("_b"), F.col("b").alias("_a"), F.col("h").alias("_h"))
        both = near.join(back, (F.col("a") == F.col("_a")) & (F.col("b") == F.col("_b")))
        # Rounding must not put a merge below those that it builds on.
        both = both.select("a", "b", F.greatest("away", "h", "_h").alias("h"), F.lit(turn).cast("long").alias("turn"))
        found = durable(both.where("a < b"))
        merged = found.count()
        if not merged:  # nearest to each other but for rounding: the nearest of all
            a, b = F.least("a", "b"), F.greatest("a", "b")
            found = durable(near.orderBy("away", a, b).limit(1).select(a.alias("a"), b.alias("b"), F.greatest("away", "h").alias("h"), F.lit(turn).cast("long").alias("turn")))
            merged = 1
        edges = found if edges is None else edges.unionByName(found)
        ends = F.explode(F.array("a", "b")).alias("cluster")
        moved = state.join(found.select(ends, F.col("a").alias("_into"), F.col("h").alias("_h")), "cluster", "left")
        moved = moved.withColumns({"cluster": F.coalesce("_into", "cluster"), "h": F.coalesce("_h", "h")})
        if linkage == "ward":
            n = F.col("n")
            total = F.sum(n)
            mean = F.array(*[F.sum(n * F.col("v")[i]) / total for i in range(width)])
            moved = moved.groupBy("cluster").agg(total.alias("n"), mean.alias("v"), F.max("h").alias("h")).withColumn("name", F.col("cluster"))
        state, left, turn = durable(moved.select("name", "n", "v", "cluster", "h")), left - merged, turn + 1
    names = [tuple(r) for r in state.groupBy("cluster").agg(F.max("h").alias("h")).orderBy("cluster").collect()]  # at most ``most``
    at = {name: i for i, (name, _) in enumerate(names)}
    weights = {r["cluster"]: r["n"] for r in state.groupBy("cluster").agg(F.sum("n").alias("n")).collect()}
    w, centers, away = np.array([weights[name] for name, _ in names], float), None, None
    if linkage == "ward":
        centers = np.array([r["v"] for r in sorted(state.collect(), key=lambda r: r["cluster"])], float).reshape(-1, width)
    else:
        away = np.full((len(names), len(names)), np.inf)
        for r in _nearest_clusters(state, width, linkage, every=True).collect():
            away[at[r["a"]], at[r["b"]]] = r["away"]
        away = np.minimum(away, away.T)  # the same but for rounding
    high, rows = [h for _, h in names], []
    for i, (a, b, d) in enumerate(merges(centers, w, linkage, away)):
        high[a] = max(d, high[a], high[b])
        rows.append((names[a][0], names[b][0], high[a], turn + i))
    last = from_rows(spark, rows, EDGE)
    return durable(last if edges is None else edges.unionByName(last))


def _better(away: np.ndarray, name: np.ndarray, best: np.ndarray, who: np.ndarray) -> np.ndarray:
    """Where a distance is less, or the same and the name smaller."""
    return (away < best) | ((away == best) & (name < who))


def _nearest_centers(clusters: DataFrame, pivots: np.ndarray) -> DataFrame:
    """(a, b, away, h): for every cluster of height h the one whose merging with it adds least to the squared deviations."""
    width = pivots.shape[1]
    known = B.deal(B.with_cell(clusters.select("name", "n", "v", "h"), pivots), width, ["cell"], "name", weight="n")
    least = np.array([b.least for b in known])

    def run(i: int) -> Iterator[pa.RecordBatch]:
        own = B.read(known[i].path)
        name, w, x = own["name"].to_numpy(), own["n"].to_numpy().astype(float), B.matrix(own["v"], width)
        best, who = np.full(len(x), np.inf), np.full(len(x), np.iinfo(np.int64).max)
        lower = np.maximum(B.least_away(x, known), 0) ** 2 * (w[:, None] * least / (w[:, None] + least))
        for j in lower.min(0).argsort(kind="stable"):
            need = np.flatnonzero(lower[:, j] <= best * (1 + B.SLACK))
            if not len(need):
                continue
            other = own if j == i else B.read(known[j].path)
            names, weights, y = other["name"].to_numpy(), other["n"].to_numpy().astype(float), B.matrix(other["v"], width)
            shift = y.mean(0)
            a, b = x - shift, y - shift
            b_sq = (b * b).sum(1)
            for start in range(0, len(need), step := max(1, CELLS // len(y))):
                r = need[start : start + step]
                factor = w[r, None] * weights / (w[r, None] + weights)
                a_sq = (a[r] * a[r]).sum(1)
                rough = (a_sq[:, None] + b_sq - 2 * a[r] @ b.T) * factor
                room = (16 * (width + 8) * np.finfo(float).eps * (a_sq + b_sq.max()))[:, None] * factor
                room[name[r, None] == names] = np.inf
                at_most = np.minimum(np.where(np.isinf(room), np.inf, rough + room).min(1), best[r])
                row, col = (np.where(np.isinf(room), np.inf, rough - room) <= at_most[:, None]).nonzero()
                for low in range(0, len(row), CELLS):  # the few that may be the nearest, exactly
                    p, q = row[low : low + CELLS], col[low : low + CELLS]
                    diff = x[r[p]] - y[q]
                    away = factor[p, q] * np.einsum("pw,pw->p", diff, diff)
                    order = np.lexsort((names[q], away, p))
                    p, q, away = p[order], q[order], away[order]
                    first = np.flatnonzero(np.r_[True, p[1:] != p[:-1]]) if len(p) else np.zeros(0, int)
                    at, away, mine = r[p[first]], away[first], names[q[first]]
                    won = _better(away, mine, best[at], who[at])
                    best[at[won]], who[at[won]] = away[won], mine[won]
        yield pa.RecordBatch.from_arrays([pa.array(name), pa.array(who), pa.array(best), own["h"].combine_chunks()], ["a", "b", "away", "h"])

    return B.over_blocks(clusters.sparkSession, len(known), run, "a long, b long, away double, h double")


def _runs(cluster: np.ndarray) -> np.ndarray:
    """Where each run of equal values starts."""
    return np.flatnonzero(np.r_[True, cluster[1:] != cluster[:-1]]) if len(cluster) else np.zeros(0, int)


def _write_runs(state: DataFrame, width: int, most: int = B.BLOCK_ROWS) -> list[tuple[B.Block, int, bool]]:
    """Blocks of whole clusters in ascending order, (block, first cluster, whether it is a part of it); more than ``most`` rows make several blocks."""
    folder = B.fresh_folder(state.sparkSession, "runs")
    rows = state.select("cluster", "name", "n", "v", "h").repartitionByRange("cluster").sortWithinPartitions("cluster", "name")

    def told(part: pa.Table, split: bool) -> pa.RecordBatch:
        what = B.about(B.matrix(part["v"], width), B.write(folder, part))
        return pa.RecordBatch.from_pydict({"first": [part["cluster"][0].as_py()], "split": [split], **what}, schema=schema_of)

    schema_of = pa.schema([("first", pa.int64()), ("split", pa.bool_()), ("path", pa.string()), ("n", pa.int64()),
                           *((c, pa.list_(pa.float64())) for c in ("low", "high", "center")), ("radius", pa.float64()), ("least", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, going = None, None  # ``going``: a cluster of which blocks have been written
        for batch in batches:
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            while held.num_rows > most:
                size, split = _block_size(held["cluster"].to_numpy(), most, going, False)
                going = held["cluster"][0].as_py() if split else None
                yield told(held.slice(0, size), split)
                held = held.slice(size)
        while held is not None and held.num_rows:
            size, split = _block_size(held["cluster"].to_numpy(), most, going, True)
            yield told(held.slice(0, size), split)
            going, held = None, held.slice(size)

    found = rows.mapInArrow(run, f"first long, split boolean, {B.ABOUT}").collect()
    return sorted(((b, r["first"], r["split"]) for b, r in zip(B.blocks_of(found, []), found, strict=True)), key=lambda t: (t[1], t[0].path))


def _block_size(cluster: np.ndarray, most: int, going: int | None, done: bool) -> tuple[int, bool]:
    """Rows of the next block, and whether they are a part of a cluster only."""
    start = _runs(cluster)
    if going is not None and cluster[0] == going:
        return (min(most, int(start[1]) if len(start) > 1 else len(cluster)), True)
    if len(cluster) <= most and done:
        return len(cluster), False
    fits = start[(start > 0) & (start <= most)]
    return (int(fits[-1]), False) if len(fits) else (min(most, len(cluster)), True)


def _all_distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    if x.shape[1] > FEW_COLUMNS:
        return _distances(x, y)
    out = np.zeros((len(x), len(y)))
    for i in range(x.shape[1]):
        gap = x[:, i, None] - y[:, i]
        out += gap * gap
    return np.sqrt(out)


def _nearest_clusters(state: DataFrame, width: int, linkage: str, every: bool = False) -> DataFrame:
    """(a, b, away, h): for every cluster of height h the nearest other one by the distances of all their rows, or with ``every`` all others.

    A task has a block of clusters and reads the others block by block; blocks
    beyond the nearest so far are left out. A cluster of many blocks is one part
    per block; the parts are added up afterwards.
    """
    known = _write_runs(state, width)
    weights = {r["cluster"]: float(r["n"]) for r in state.groupBy("cluster").agg(F.sum("n").alias("n")).where(
        F.col("cluster").isin([first for _, first, split in known if split])
    ).collect()} if any(split for _, _, split in known) else {}
    units: list[list[int]] = []  # a block of whole clusters, or all blocks of one cluster
    for i, (_, first, split) in enumerate(known):
        if split and units and known[units[-1][0]][2] and known[units[-1][0]][1] == first:
            units[-1].append(i)
        else:
            units.append([i])
    low = np.array([np.min([known[i][0].low for i in u], axis=0) for u in units])
    high = np.array([np.max([known[i][0].high for i in u], axis=0) for u in units])
    fold = np.add if linkage == "average" else np.maximum
    names_of = ["a", "b", "away", "h", "part"]

    def rows_of(i: int):
        table = B.read(known[i][0].path)
        return table["cluster"].to_numpy(), table["n"].to_numpy().astype(float), B.matrix(table["v"], width), table["h"].to_numpy()

    def between(x, w, y, v, start, starts):
        """Sums (or maxima) of the distances of the clusters of x to those of y."""
        out = []
        bounds = [*start.tolist(), len(x)]
        at = 0
        while at < len(start):  # whole clusters, as many as there is room for
            to = at + 1
            while to < len(start) and (bounds[to + 1] - bounds[at]) * len(y) <= 4 * CELLS:
                to += 1
            part = None
            for lo in range(bounds[at], bounds[to], step := max(1, 4 * CELLS // len(y))):
                hi = min(lo + step, bounds[to])
                away = _all_distances(x[lo:hi], y)
                if linkage == "average":
                    away *= v
                    away *= w[lo:hi, None]
                inner = np.unique(np.r_[0, start[(start > lo) & (start < hi)] - lo])
                away = fold.reduceat(fold.reduceat(away, starts, axis=1), inner, axis=0)
                part = away if part is None else fold(part, away)  # more than one step only within one cluster
            out.append(part)
            at = to
        return np.concatenate(out)

    def run(i: int) -> Iterator[pa.RecordBatch]:
        cluster, w, x, h = rows_of(i)
        start = _runs(cluster)
        a, high_a, part = cluster[start], h[start], known[i][2]
        size = np.array([weights[int(a[0])]]) if part else np.add.reduceat(w, start)
        box_low, box_high = np.minimum.reduceat(x, start), np.maximum.reduceat(x, start)
        lower = np.empty((len(a), len(units)))
        for at in range(0, len(a), step := max(1, 4 * CELLS // low.size)):
            under, over = box_low[at : at + step, None, :], box_high[at : at + step, None, :]
            lower[at : at + step] = np.sqrt((np.maximum(np.maximum(low - over, under - high), 0) ** 2).sum(2)) * (1 - B.SLACK)
        best, who = np.full(len(a), np.inf), np.full(len(a), np.iinfo(np.int64).max)
        for j in lower.min(0).argsort(kind="stable"):
            need = np.ones(len(a), bool) if part or every else lower[:, j] <= best * (1 + B.SLACK)
            if not need.any():
                continue
            mine = np.repeat(need, np.diff(np.r_[start, len(x)]))
            xs, ws, found = x[mine], w[mine], None
            begin, total = _runs(cluster[mine]), 0.0
            for block in units[j]:
                other, v, y, _ = rows_of(block)
                starts = _runs(other)
                got = between(xs, ws, y, v, begin, starts)
                found = got if found is None else fold(found, got)
                total = total + np.add.reduceat(v, starts)
            names = other[starts]
            if linkage == "average":
                found = found / (size[need][:, None] * total)
            found[a[need][:, None] == names] = np.inf
            if part or every:
                row, col = np.isfinite(found).nonzero()
                yield pa.RecordBatch.from_arrays([pa.array(a[need][row]), pa.array(names[col]), pa.array(found[row, col]), pa.array(high_a[need][row]), pa.array(np.full(len(row), part))], names_of)
                continue
            place = found.argmin(1)  # names ascend: the first of equals
            away, name, at = found[np.arange(len(found)), place], names[place], np.flatnonzero(need)
            won = _better(away, name, best[at], who[at])
            best[at[won]], who[at[won]] = away[won], name[won]
        if not (part or every):
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(who), pa.array(best), pa.array(high_a), pa.array(np.zeros(len(a), bool))], names_of)

    found = B.over_blocks(state.sparkSession, len(known), run, "a long, b long, away double, h double, part boolean")
    if not weights:
        return found.drop("part")
    found = durable(found)
    parts = found.where("part").groupBy("a", "b").agg((F.sum("away") if linkage == "average" else F.max("away")).alias("away"), F.max("h").alias("h"))
    if not every:
        parts = parts.groupBy("a").agg(F.min(F.struct("away", "b", "h")).alias("s")).select("a", "s.b", "s.away", "s.h")
    return found.where("not part").drop("part").unionByName(parts)


def _spanning_tree(points: DataFrame, pivots: np.ndarray, most: int) -> DataFrame:
    """(a, b, h, turn): the minimum spanning tree of the points: every cluster follows its nearest pair of points, until one is left."""
    width, edges, turn = pivots.shape[1], None, 0
    state = points.select("name", "v", F.col("name").alias("cluster"))
    while state.agg(F.min("cluster") < F.max("cluster")).first()[0]:
        near = durable(_nearest_outside(B.deal(B.with_cell(state, pivots), width, ["cell"], "name"), width, state.sparkSession))
        picked = near.groupBy("cluster").agg(F.min(F.struct("h", "a", "b", "other")).alias("s")).select("cluster", "s.*")
        picked = durable(picked)
        new = durable(picked.select("a", "b", "h").distinct().withColumn("turn", F.lit(turn).cast("long")))
        edges = new if edges is None else edges.unionByName(new)
        links = picked.select(F.col("cluster").alias("a"), F.col("other").alias("b"))
        if picked.count() <= most:
            joined = from_rows(state.sparkSession, _joined([tuple(r) for r in links.collect()]), "node long, component long")
        else:
            joined = connected_components(picked.select(F.col("cluster").alias("node")), links)
        state = durable(state.join(joined, F.col("cluster") == F.col("node")).select("name", "v", F.col("component").alias("cluster")))
        turn += 1
    return edges


def _joined(links: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """(node, smallest node linked to it) of a few links."""
    name = {x: x for link in links for x in link}

    def root(x: int) -> int:
        while name[x] != x:
            name[x] = x = name[name[x]]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        name[b] = a
    return [(x, root(x)) for x in name]


def _nearest_outside(known: list[B.Block], width: int, spark) -> DataFrame:
    """(cluster, h, a, b, other): per block and cluster the nearest pair of points of which the other is in another cluster."""
    top = np.iinfo(np.int64).max

    def run(i: int) -> Iterator[pa.RecordBatch]:
        own = B.read(known[i].path)
        name, cluster, x = own["name"].to_numpy(), own["cluster"].to_numpy(), B.matrix(own["v"], width)
        order = cluster.argsort(kind="stable")
        name, cluster, x = name[order], cluster[order], x[order]
        start = _runs(cluster)
        group = np.repeat(np.arange(len(start)), np.diff(np.r_[start, len(x)]))
        best = np.full(len(start), np.inf)
        ends = np.full((len(start), 3), top)  # smaller point, larger point, cluster of the other
        lower = np.maximum(B.least_away(x, known), 0)
        for j in lower.min(0).argsort(kind="stable"):
            need = np.flatnonzero(lower[:, j] <= best[group] * (1 + B.SLACK))
            if not len(need):
                continue
            other = B.read(known[j].path)
            names, theirs, y = other["name"].to_numpy(), other["cluster"].to_numpy(), B.matrix(other["v"], width)
            for at in range(0, len(need), step := max(1, CELLS // len(y))):
                r = need[at : at + step]
                away = _all_distances(x[r], y)
                away[cluster[r, None] == theirs] = np.inf
                row, col = (np.isfinite(away) & (away <= away.min(1, keepdims=True)) & (away <= best[group[r], None])).nonzero()
                if not len(row):
                    continue
                d, g = away[row, col], group[r[row]]
                p, q = np.minimum(name[r[row]], names[col]), np.maximum(name[r[row]], names[col])
                by = np.lexsort((q, p, d, g))
                first = by[_runs(g[by])]
                for f in first:
                    key, now = (d[f], p[f], q[f]), (best[g[f]], ends[g[f], 0], ends[g[f], 1])
                    if key < now:
                        best[g[f]], ends[g[f]] = d[f], (p[f], q[f], theirs[col[f]])
        hit = np.isfinite(best)
        yield pa.RecordBatch.from_arrays(
            [pa.array(cluster[start][hit]), pa.array(best[hit]), *(pa.array(np.ascontiguousarray(ends[hit, c])) for c in range(3))], ["cluster", "h", "a", "b", "other"]
        )

    return B.over_blocks(spark, len(known), run, "cluster long, h double, a long, b long, other long")
