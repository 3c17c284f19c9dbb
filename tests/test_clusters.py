"""Neighbours, density, hierarchy and separation against brute force."""

import itertools
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from veinworks.operators import clustering as K
from veinworks.operators import density as D
from veinworks.operators import graph as G
from veinworks.operators import linkage as LK
from veinworks.operators import lloyd as LL
from veinworks.operators import neighbors as NB
from veinworks.operators import ranking as RK
from veinworks.operators import silhouette as SI


def frame(spark, points, extra=None):
    dims = len(points[0])
    rows = [(i, *map(float, p), *([extra[i]] if extra is not None else [])) for i, p in enumerate(points)]
    schema = "row_id long, " + ", ".join(f"x{d} double" for d in range(dims)) + (", prediction long" if extra is not None else "")
    return spark.createDataFrame(rows, schema).repartition(5), [f"x{d}" for d in range(dims)]


def blobs(n, dims, k, seed=0, spread=0.3):
    draw = np.random.default_rng(seed)
    centers = draw.uniform(-4, 4, size=(k, dims))
    return [tuple(centers[i % k] + draw.normal(0, spread, dims)) for i in range(n)]


def brute_dbscan(points, eps, m):
    n = len(points)
    near = [[j for j in range(n) if math.dist(points[i], points[j]) <= eps] for i in range(n)]
    core = [len(x) >= m for x in near]
    label = [-1] * n
    for i in range(n):
        if core[i] and label[i] == -1:
            stack, label[i] = [i], i
            while stack:
                for j in near[stack.pop()]:
                    if core[j] and label[j] == -1:
                        label[j] = i
                        stack.append(j)
    for i in range(n):
        if not core[i]:
            owners = [label[j] for j in near[i] if core[j]]
            label[i] = min(owners) if owners else -1
    return {i: (label[i], core[i]) for i in range(n)}


@pytest.mark.parametrize("dims,eps,m,seed", [(1, 0.1, 3, 1), (2, 0.25, 4, 2), (3, 0.5, 5, 3), (5, 0.9, 4, 4)])
def test_dbscan_equals_brute_force(spark, dims, eps, m, seed):
    points = blobs(220, dims, 4, seed)
    points += [points[0]] * 6 + [points[7]] * 2  # copies
    df, cols = frame(spark, points)
    got = {r["row_id"]: (r["prediction"], r["is_core"]) for r in D.dbscan(df, cols, eps, m).collect()}
    assert got == brute_dbscan(points, eps, m)


def test_dbscan_joins_cells_through_inner_points(spark):
    # Two dense cells whose extreme points are far apart but whose inner points touch.
    left = [(0.0, y / 10) for y in range(11)] + [(0.45, 0.5)]
    right = [(1.4, y / 10) for y in range(11)] + [(0.95, 0.5)]
    points = left + right
    df, cols = frame(spark, points)
    got = {r["row_id"]: (r["prediction"], r["is_core"]) for r in D.dbscan(df, cols, 0.5, 2).collect()}
    assert got == brute_dbscan(points, 0.5, 2)


def test_dbscan_all_noise_and_one_cluster(spark):
    df, cols = frame(spark, [(i * 10.0, 0.0) for i in range(5)])
    assert {r["prediction"] for r in D.dbscan(df, cols, 1.0, 2).collect()} == {-1}
    df, cols = frame(spark, [(1.0, 1.0)] * 8)
    assert {r["prediction"] for r in D.dbscan(df, cols, 0.1, 8).collect()} == {0}


def test_dbscan_salts_crowded_cells(spark, monkeypatch):
    monkeypatch.setattr(D, "ROWS_PER_SALT", 10)
    points = blobs(150, 2, 2, 5)
    df, cols = frame(spark, points)
    got = {r["row_id"]: (r["prediction"], r["is_core"]) for r in D.dbscan(df, cols, 0.3, 5).collect()}
    assert got == brute_dbscan(points, 0.3, 5)


def test_dbscan_grid_and_defaults(spark):
    points = [(0.0 + i / 100, 0.0) for i in range(20)] + [(5.0 + i / 100, 0.0) for i in range(20)] + [(50.0, 50.0)]
    df, cols = frame(spark, points)
    found = D.dbscan_grid(df, cols, (0.1, 0.5, 2), (3, 5, 2))
    assert found["n_clusters"] == 2 and found["setting"] == (0.1, 3) and found["silhouette"] > 0.9
    assert found["labels"].where("prediction = -1").count() == 1
    lost = D.dbscan_grid(df, cols, (100.0, 200.0, 2), (3, 5, 2))
    assert lost["setting"] == (0.5, 5) and lost["silhouette"] is None and lost["n_clusters"] == 2
    sweep = D.dbscan_eps_sweep(df, cols, (0.1, 60.0, 2))
    assert [r["silhouette"] for r in sweep["sweep"].orderBy("eps").collect()] == [-1.0, -1.0]
    assert sweep["labels"] is None


def test_components_equal_brute_force(spark):
    edges = [(i, i + 1) for i in range(40) if i % 10 != 9] + [(100, 3), (7, 7)] + [(200, x) for x in range(201, 230)]
    nodes = sorted({x for e in edges for x in e} | {999})
    n = spark.createDataFrame([(x,) for x in nodes], "node long")
    e = spark.createDataFrame(edges, "a long, b long")
    got = {r["node"]: r["component"] for r in G.connected_components(n, e).collect()}
    want = {x: x for x in nodes}
    for _ in nodes:
        for a, b in edges:
            want[a] = want[b] = min(want[a], want[b])
    assert got == want


@pytest.mark.parametrize("block,n,dims", [(7, 90, 2), (2000, 300, 6)])
def test_nearest_neighbors_equal_brute_force(spark, block, n, dims):
    points = blobs(n, dims, 3, 6) + [(0.0,) * dims] * 4
    df, cols = frame(spark, points)
    got = {}
    for r in NB.nearest_neighbors(df, cols, 4, block_rows=block).collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["neighbor_id"]))
    for i, p in enumerate(points):
        want = sorted((math.dist(p, q), j) for j, q in enumerate(points) if j != i)[:4]
        assert [j for _, j in sorted(got[i])] == [j for _, j in want]


def test_pairs_of_blocks_copy_no_rows(spark, monkeypatch):
    points = blobs(200, 3, 3, 41, 1.0)
    df, cols = frame(spark, points, [i % 3 for i in range(200)])
    written = []
    for module in (NB, SI):  # rows go into files once, and no row is exploded over blocks
        monkeypatch.setattr(module, "deal", lambda *a, deal=module.deal: written.append(deal(*a)) or written[-1])
    monkeypatch.setattr(SI, "BLOCK_ROWS", 20)
    near = NB.nearest_neighbors(df, cols, 4, block_rows=20)
    scores = SI.silhouette_samples(df, cols, metric="euclidean")
    assert [sum(b.n for b in known) for known in written] == [200, 200] and all(b.n < 60 for known in written for b in known)
    for made in (near, scores):
        plan = made._jdf.queryExecution().toString()
        assert "Generate" not in plan and "FlatMapCoGroups" not in plan
    assert near.count() == 800 and scores.count() == 200


def test_neighbors_of_equal_ids_are_shared(spark):
    twice = spark.createDataFrame([(0, 0.0), (0, 10.0), (1, 1.0), (2, 9.5), (3, 30.0)], "row_id long, x double")
    got = [(r["query_id"], r["rank"], r["neighbor_id"]) for r in NB.nearest_neighbors(twice, ["x"], 2).where("query_id < 2").orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 2), (0, 2, 1), (1, 1, 0), (1, 2, 2)]


def test_the_segmentation_looks_at_the_neighbours_of_all_rows(spark, monkeypatch):
    df, cols = frame(spark, blobs(60, 2, 3, 42, 0.3))
    whole = NB.neighbor_distance_range(df, cols, sample=None)
    monkeypatch.setattr(NB.neighbor_distance_range, "__defaults__", ("row_id", 42, 5))
    found = K.segmentation(df, (2, 3), all_columns=True, methods=("dbscan",))["results"]["DBSCAN"]["sweep"]
    tried = sorted({r["eps"] for r in found.collect()})
    assert (tried[0], tried[-1]) == pytest.approx(whole)


def test_neighbors_within_groups_and_for_other_rows(spark):
    points = blobs(60, 2, 3, 8)
    df, cols = frame(spark, points, extra=[i % 3 for i in range(60)])
    for r in NB.nearest_neighbors(df, cols, 3, group="prediction").collect():
        assert r["query_id"] % 3 == r["neighbor_id"] % 3 and r["query_id"] != r["neighbor_id"]
    asked, _ = frame(spark, [(0.0, 0.0), points[5]])
    near = NB.nearest_neighbors(df, cols, 1, queries=asked).collect()
    assert {r["query_id"]: r["neighbor_id"] for r in near}[1] == 5
    few, _ = frame(spark, [(0.0, 0.0), (1.0, 0.0)])
    assert NB.nearest_neighbors(few, cols, 5).count() == 2


def test_vote_ties_go_to_the_smaller_label(spark):
    near = spark.createDataFrame([(1, 10), (1, 11), (2, 10), (2, 12)], "query_id long, neighbor_id long")
    labels = spark.createDataFrame([(10, 1), (11, 0), (12, 1)], "row_id long, label int")
    out = {r["query_id"]: (r["prediction"], r["score"]) for r in NB.neighbor_votes(near, labels).collect()}
    assert out == {1: (0, 0.5), 2: (1, 1.0)}


def test_pairs_within_equal_brute_force(spark):
    points = blobs(120, 4, 3, 9)
    df, cols = frame(spark, points)
    got = {(r["left_id"], r["right_id"]) for r in NB.pairs_within(df, cols, 0.5).collect()}
    assert got == {(i, j) for i, j in itertools.combinations(range(120), 2) if math.dist(points[i], points[j]) <= 0.5}


def brute_silhouette(points, labels, square):
    out = {}
    for i, p in enumerate(points):
        away = {}
        for j, q in enumerate(points):
            if i != j:
                d = math.dist(p, q)
                away.setdefault(labels[j], []).append(d * d if square else d)
        own = away.pop(labels[i], [])
        if not own:
            out[i] = 0.0
            continue
        a, b = sum(own) / len(own), min(sum(v) / len(v) for v in away.values())
        out[i] = (b - a) / max(a, b)
    return out


@pytest.mark.parametrize("metric", ["sqeuclidean", "euclidean"])
def test_silhouettes_equal_brute_force(spark, metric, monkeypatch):
    monkeypatch.setattr(SI, "BLOCK_ROWS", 17)
    points = blobs(80, 3, 3, 10, 1.5)
    labels = [i % 3 for i in range(79)] + [9]  # 9 is a singleton
    df, cols = frame(spark, points, labels)
    want = brute_silhouette(points, labels, metric == "sqeuclidean")
    got = {r["row_id"]: r["silhouette"] for r in SI.silhouette_samples(df, cols, metric=metric).collect()}
    assert got == pytest.approx(want)
    if metric == "sqeuclidean":
        wide = df.select("row_id", F.lit("a").alias("setting"), F.col("prediction").alias("label"))
        one = df.select("row_id", F.lit("b").alias("setting"), F.lit(0).cast("long").alias("label"))
        many = SI.mean_silhouettes(df, wide.unionByName(one), cols)
        assert many == {"a": pytest.approx(sum(want.values()) / 80), "b": None}


@pytest.mark.parametrize("metric", SI.METRICS)
def test_silhouettes_equal_brute_force_for_every_metric(spark, metric):
    points = blobs(60, 3, 4, 31, 1.5) + [(0.0, 0.0, 0.0)] * 3 + [(9.0, 9.0, 9.0)]
    labels = [i % 4 for i in range(60)] + [0, 1, 1, 7]
    df, cols = frame(spark, points, labels)
    x = np.array(points)
    if metric == "cosine":
        length = np.sqrt((x * x).sum(1, keepdims=True))
        unit = np.divide(x, length, where=length > 0, out=np.zeros_like(x))
        d = 1 - unit @ unit.T
        np.fill_diagonal(d, 0)
    else:
        gaps = np.abs(x[:, None] - x[None])
        d = gaps.sum(2) if metric == "manhattan" else (gaps**2).sum(2) ** (1 if metric == "sqeuclidean" else 0.5)
    got = {r["row_id"]: r["silhouette"] for r in SI.silhouette_samples(df, cols, metric=metric).collect()}
    for i, own in enumerate(labels):
        mine = [j for j in range(len(labels)) if labels[j] == own and j != i]
        b = min(np.mean([d[i, j] for j in range(len(labels)) if labels[j] == c]) for c in set(labels) - {own})
        a = np.mean([d[i, j] for j in mine]) if mine else None
        assert got[i] == pytest.approx((b - a) / max(a, b) if mine else 0.0, abs=1e-9)


def test_one_cluster_has_no_scores(spark):
    df, cols = frame(spark, [(0.0, 1.0), (2.0, 3.0)], [0, 0])
    assert SI.mean_silhouette(df, cols) is None
    assert SI.calinski_harabasz(df, cols) is None and SI.davies_bouldin(df, cols) is None


def plain_linkage(points, k, linkage):
    """Merge the two nearest groups, distances from their members, until k are left."""
    groups = [[i] for i in range(len(points))]
    x = np.array(points, float)

    def away(a, b):
        d = np.sqrt(((x[a][:, None] - x[b][None]) ** 2).sum(2))
        if linkage == "ward":
            return len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(0) - x[b].mean(0)) ** 2).sum()
        return {"single": d.min, "complete": d.max, "average": d.mean}[linkage]()

    while len(groups) > k:
        a, b = min(itertools.combinations(range(len(groups)), 2), key=lambda p: away(groups[p[0]], groups[p[1]]))
        groups[a] += groups.pop(b)
    return {frozenset(g) for g in groups}


def grouped(df, column):
    out = {}
    for r in df.collect():
        out.setdefault(r[column], set()).add(r["row_id"])
    assert sorted(out, key=lambda c: min(out[c])) == list(range(len(out)))  # numbered by smallest row id
    return {frozenset(g) for g in out.values()}


@pytest.mark.parametrize("linkage", LK.LINKAGES)
def test_linkages_equal_their_definition(spark, linkage):
    points = blobs(40, 2, 3, 21, 0.8)
    points += points[:5] * 2  # copies
    df, cols = frame(spark, points)
    found = LK.linkage_labels(df, cols, [2, 3, 5, 9], linkage)
    for k in (2, 3, 5, 9):
        assert grouped(found, f"k{k}") == plain_linkage(points, k, linkage)
    with pytest.raises(ValueError):
        LK.merges(np.zeros((2, 1)), np.ones(2), "median")


@pytest.mark.parametrize("linkage", ["ward", "complete", "average"])
def test_micro_clusters_stand_for_their_rows(spark, linkage):
    df, cols = frame(spark, blobs(400, 3, 4, 22, 0.2))
    found = LK.linkage_labels(df, cols, [4], linkage, micro=30)
    assert grouped(found, "k4") == {frozenset(range(i, 400, 4)) for i in range(4)}


@pytest.mark.parametrize("linkage", LK.LINKAGES)
def test_hierarchies_are_exact_beyond_one_matrix(spark, linkage, monkeypatch):
    rng = np.random.default_rng(31)
    points = [tuple(p) for c in (0.0, 5.0) for p in rng.normal(c, 1.0, (30, 2)).tolist()] + [(40.0, 40.0), (43.0, 40.0)]
    points += points[:5]  # copies
    df, cols = frame(spark, points)
    monkeypatch.setattr(LK._write_runs, "__defaults__", (7,))  # a cluster of several blocks
    found = LK.linkage_labels(df, cols, [2, 3, 6, 45], linkage, micro=12)
    for k in (2, 3, 6, 45):
        assert grouped(found, f"k{k}") == plain_linkage(points, k, linkage)


def test_rows_with_a_gap_have_no_place_in_a_hierarchy(spark):
    df = spark.createDataFrame([(0, 1.0), (1, None), (2, 5.0), (3, 1.5), (4, float("nan"))], "row_id long, x double")
    for micro in (LK.MICRO, 2):
        assert {r["row_id"]: r["k2"] for r in LK.linkage_labels(df, ["x"], [2], micro=micro).collect()} == {0: 0, 1: None, 2: 1, 3: 0, 4: None}


def test_lloyd_equals_one_fit_at_a_time(spark):
    points = blobs(90, 2, 3, 23, 0.6)
    df, cols = frame(spark, points)
    x = np.array(points)
    many = LL.fit_many(df, cols, {2: 3, 3: 3, 5: 4}, tolerance=0.0)
    for k, found in many.items():
        d = ((x[:, None] - found.points[None]) ** 2).sum(2)
        assert len(found.points) == k and found.cost == pytest.approx(d.min(1).sum())
        for c in range(k):  # a fixed point: every centre is the mean of its rows
            assert np.allclose(x[d.argmin(1) == c].mean(0), found.points[c])
        assert found.cost <= LL.fit_many(df, cols, {k: 1}, tolerance=0.0)[k].cost + 1e-9
    same, cols = frame(spark, [(1.0, 2.0)] * 5)
    assert LL.fit_many(same, cols, {3: 2})[3].points.tolist() == [[1.0, 2.0]]
    gaps = spark.createDataFrame([(0, 1.0), (1, None)], "row_id long, x double")
    near = {r["row_id"]: r["p"] for r in LL.with_nearest(gaps, ["x"], {"p": np.array([[0.0], [1.0]])}).collect()}
    assert near == {0: 1, 1: None}


def test_hierarchy_finds_clear_groups_and_nests(spark):
    df, cols = frame(spark, blobs(120, 2, 2, 12, 0.1))
    for linkage in ("ward", "halving"):
        halves = {r["row_id"]: r["prediction"] for r in K.hierarchical_labels(df, cols, 2, linkage=linkage).collect()}
        assert len({(k % 2, p) for k, p in halves.items()}) == 2 == len(set(halves.values()))
    leaves = {r["row_id"]: r["prediction"] for r in K.hierarchical_labels(df, cols, 4, linkage="halving").collect()}
    assert len(set(leaves.values())) == 4 == len({(p, halves[k]) for k, p in leaves.items()})
    # Rows around the origin, where a relative step has no length.
    centred, cols = frame(spark, [(float(x), float(y)) for x in (-1, 1) for y in (-1, 1)] * 5)
    assert K.hierarchical_labels(centred, cols, 4, linkage="halving").select("prediction").distinct().count() == 4
    same, cols = frame(spark, [(1.0, 1.0)] * 6)
    assert K.hierarchical_labels(same, cols, 3).select("prediction").distinct().count() == 1


def test_no_column_is_left_out_of_reports(spark):
    df, cols = frame(spark, blobs(40, 12, 2, 5))
    labels = df.select("row_id", (F.col("row_id") % 2).alias("prediction"))
    assert len(K.pair_plot_data(df, labels, cols).columns) == 14 and len(K.pair_plot_data(df, labels, cols, n=3).columns) == 5
    boxes = K.cluster_overview(df, labels, cols)["boxes"]
    assert boxes.select("feature").distinct().count() == 12
    assert K.normalised_profile(K.cluster_profile(df.join(labels, "row_id"), cols), cols).count() == 24


def test_kmeans_takes_the_cheapest_start_and_the_sweep_finds_k(spark):
    points = blobs(120, 2, 3, 13, 0.2)
    df, cols = frame(spark, points)
    _, cost = K.fit_kmeans(df, cols, 3, starts=3)
    for i in range(3):
        _, one = K.fit_kmeans(df, cols, 3, seed=K.SEED + i, starts=1)
        assert cost <= one + 1e-9
    found = K.kmeans_sweep(df, cols, (2, 5), starts=3)
    assert found["n_clusters"] == 3
    assert K.cluster_counts_to_try((2, 10), 45) == [2, 3, 4]


def test_a_start_is_the_best_of_a_few_draws():
    pool = np.arange(40.0)[:, None]
    cost = lambda c: ((pool - c[:, 0]) ** 2).min(1).sum()
    for seed in range(5):
        rng, one = np.random.default_rng(seed), np.random.default_rng(seed)
        first = int(one.choice(40, p=np.full(40, 1 / 40)))
        p = (pool[:, 0] - first) ** 2
        drawn = one.choice(40, 2, p=p / p.sum())
        found = LL._start(pool, np.ones(40), 2, rng)
        assert cost(found) == min(cost(pool[[first, d]]) for d in drawn)


def test_nearest_center_breaks_ties_by_number(spark):
    df, cols = frame(spark, [(0.0,), (2.0,), (1.0,)])
    out = {r["row_id"]: r["prediction"] for r in K.nearest_center(df, cols, [[0.0], [2.0]]).collect()}
    assert out == {0: 0, 1: 1, 2: 0}


def test_run_clustering_and_segmentation(spark):
    points = [(x * 40 + 100, y * 40) for x, y in blobs(90, 2, 3, 14, 0.2)]
    df, cols = frame(spark, points)
    found = K.run_clustering(df, cols, (2, 4), starts=2)
    assert found["n_clusters"] == 3 and found["profile"].count() == 3
    assert {r["method"] for r in found["sweep"].collect()} == {"kmeans", "hierarchical", "dbscan"}
    seg = K.segmentation(df, (2, 4), all_columns=True, starts=2)
    assert seg["n_clusters"] >= 3 and seg["labels"].count() == 90
    with pytest.raises(ValueError):
        K.run_clustering(df, cols, methods=["spectral"])


def test_best_row_and_elbow(spark):
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0), ("c", 2.0), ("d", None)], "m string, s double")
    assert RK.best_row(df, "s", ["m"]).first()["m"] == "b"
    assert RK.best_row(df.where("m = 'x'"), "s", ["m"]).first() is None
    k = spark.createDataFrame([(2, 100.0), (3, 60.0), (5, 1.0), (6, 0.5)], "k int, inertia double")
    assert RK.elbow(k).first()["k"] == 3


def test_kmeans_spreads_the_rows_of_one_file_over_all_cores(spark, monkeypatch):
    seen, sums = [], LL._sums

    def watched(points, centers, shift):
        seen.append(points.rdd.getNumPartitions())
        return sums(points, centers, shift)

    monkeypatch.setattr(LL, "_sums", watched)
    df, cols = frame(spark, blobs(60, 2, 3))
    found = LL.fit_many(df.coalesce(1), cols, {3: 2}, max_iter=2)
    assert len(found[3].points) == 3 and set(seen) == {LL.PARTS_PER_CORE * spark.sparkContext.defaultParallelism}


def test_sums_of_more_centres_than_a_group_adds_up(spark, monkeypatch):
    monkeypatch.setattr(LL, "CENTERS_PER_GROUP", 2)
    points = blobs(80, 2, 5)
    df, cols = frame(spark, points)
    x, shift = np.array(points), np.zeros(2)
    centers = [x[:3], x[3:8]]
    got = LL._sums(LL.vectors_of(df, cols), centers, shift)
    for own, part in zip(centers, (got[:3], got[3:])):
        near = LL.squared_gaps(x, own).argmin(1)
        assert np.allclose(part[:, 0], np.bincount(near, minlength=len(own)))
        assert np.allclose(part[:, 1:-1], [x[near == i].sum(0) for i in range(len(own))])


def test_best_of_a_block_measures_few_rows_exactly(monkeypatch):
    """Ties, copies, missing and huge values come out as from all exact distances; few pairs are measured so."""
    import pandas as pd

    draw, measured, einsum = np.random.default_rng(5), [], np.einsum

    def watched(names, left, right):
        measured.append(left.size)
        return einsum(names, left, right)

    monkeypatch.setattr(np, "einsum", watched)
    x = draw.normal(size=(400, 8)) + 1000
    x[50:60] = x[50]
    rows = pd.DataFrame({"id": draw.permutation(400), "v": list(x)})
    found = NB._best_in_block(5, 8, True)(rows, rows)
    assert sum(measured) < 400 * 60 * 8
    for extra in ([], [[math.nan] * 8, [1e200] * 8, [1e200] * 8]):
        points = np.concatenate([x, np.array(extra).reshape(-1, 8)])
        every = pd.DataFrame({"id": np.arange(len(points)), "v": list(points)})
        found = NB._best_in_block(5, 8, True)(every, every)
        got = {}
        for q, n, d in found.itertuples(index=False):
            got.setdefault(q, []).append((d, n))
        for q, p in enumerate(points):
            with np.errstate(over="ignore", invalid="ignore"):
                away = np.sqrt(((points - p) ** 2).sum(1))
            want = sorted((a, i) for i, a in enumerate(away) if i != q and np.isfinite(a))[:5]
            assert [n for _, n in sorted(got.get(q, []))] == [i for _, i in want]
            assert np.allclose([d for d, _ in sorted(got.get(q, []))], [a for a, _ in want], atol=0)


def test_distances_of_blocks_measure_few_differences(monkeypatch):
    draw, measured, einsum = np.random.default_rng(6), [], np.einsum

    def watched(names, left, right):
        measured.append(left.size)
        return einsum(names, left, right)

    monkeypatch.setattr(np, "einsum", watched)
    x = draw.normal(size=(300, 4)) + 500
    x[10:20], x[20] = x[10], x[10] + 1e-9
    for points, most in ((x, 300 * 8 * 4), (np.concatenate([x, [[math.nan] * 4, [1e200] * 4]]), math.inf)):
        measured.clear()
        with np.errstate(over="ignore", invalid="ignore"):
            want = np.sqrt(((points[:, None] - points[None]) ** 2).sum(2))
        assert np.allclose(SI._distances(points, points), want, rtol=1e-8, atol=0, equal_nan=True)
        assert 0 < sum(measured) <= most


def test_kmeans_works_on_different_rows_only(spark, monkeypatch):
    rows = [(i, float(i % 20), float((i * i) % 20)) for i in range(400)]
    df, seen, sums = spark.createDataFrame(rows, "row_id long, x double, y double"), [], LL._sums
    monkeypatch.setattr(LL, "_sums", lambda points, *rest: seen.append(points.count()) or sums(points, *rest))
    found = LL.fit_many(df, ["x", "y"], {3: 2})[3]
    assert set(seen) == {20}
    x = np.array([r[1:] for r in rows])
    gaps = ((x[:, None] - found.points[None]) ** 2).sum(2)
    assert abs(gaps.min(1).sum() - found.cost) < 1e-6  # every row counts
    for c in range(3):
        assert np.allclose(x[gaps.argmin(1) == c].mean(0), found.points[c], atol=0.2)


@pytest.mark.parametrize("width", [2, 12])
def test_sums_of_few_and_many_centres_agree_with_brute_force(spark, width):
    draw = np.random.default_rng(4)
    x, weight = draw.normal(size=(300, width)), draw.integers(1, 5, 300)
    centers = [draw.normal(size=(k, width)) for k in (1, 3, 60)]
    points = spark.createDataFrame([(v.tolist(), int(n)) for v, n in zip(x, weight)], "v array<double>, n long").repartition(3)
    found, low = LL._sums(points, centers, np.zeros(width)), 0
    for own in centers:
        gaps = ((x[:, None] - own[None]) ** 2).sum(2)
        for c in range(len(own)):
            mine = gaps.argmin(1) == c
            want = [weight[mine].sum(), *(x * weight[:, None])[mine].sum(0), (gaps[:, c] * weight)[mine].sum()]
            assert np.allclose(found[low + c], want)
        low += len(own)


def test_the_first_of_equally_near_centres_among_many():
    draw = np.random.default_rng(5)
    centers = draw.integers(0, 4, (80, 3)).astype(float) + 1e8  # many are equal, far from the origin
    x = draw.integers(0, 8, (200, 3)) / 2 + 1e8
    place, gap = LL._first_nearest(x, centers)
    gaps = ((x[:, None] - centers[None]) ** 2).sum(2)
    assert (place == gaps.argmin(1)).all() and (gap == gaps.min(1)).all()


def test_silhouettes_of_many_settings_are_dealt_over_all_cores(spark):
    draw = np.random.default_rng(6)
    df = spark.createDataFrame([(i, *map(float, draw.normal(size=2))) for i in range(90)], "row_id long, x double, y double")
    labels = df.select("row_id", F.explode(F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("setting"))
    labels = labels.withColumn("label", F.when(F.col("setting") == "c", F.lit(1)).otherwise(F.col("row_id") % F.when(F.col("setting") == "a", 2).otherwise(5)).cast("long"))
    found, seen, run = SI.mean_silhouettes(df, labels, ["x", "y"]), [], type(df).mapInArrow
    for name, k in (("a", 2), ("b", 5)):
        want = SI.mean_silhouette(df.withColumn("prediction", F.col("row_id") % k), ["x", "y"])
        assert abs(found[name] - want) < 1e-9
    assert found["c"] is None
    try:
        type(df).mapInArrow = lambda self, *a, **kw: seen.append(self.rdd.getNumPartitions()) or run(self, *a, **kw)
        SI.mean_silhouettes(df, labels, ["x", "y"])
    finally:
        type(df).mapInArrow = run
    assert seen and seen[0] >= 2 * spark.sparkContext.defaultParallelism


def test_candidates_for_starts_do_not_grow_with_the_rows(spark):
    draws = LL._draws(np.array([-(2**63), -1, 0, 2**63 - 1]))
    assert draws.min() == 0 and draws.max() <= 1
    shift = np.zeros(2)
    for rows in (4_000, 16_000):
        points = spark.range(rows).select(
            F.array((F.col("id") % 127).cast("double"), F.col("id").cast("double") / 100).alias("v"), F.lit(1).cast("long").alias("n")
        )
        pool, weight = LL._pool(points, rows, shift, 3, 42)
        assert 3 <= len(pool) <= 2 * LL.POOL_ROUNDS * LL.POOL_LEAST and weight.sum() == rows
    few = spark.createDataFrame([([1.0, 2.0], 3), ([0.0, 5.0], 1)], "v array<double>, n long")
    pool, weight = LL._pool(few, 2, shift, 3, 42)
    assert pool.tolist() == [[0.0, 5.0], [1.0, 2.0]] and weight.tolist() == [1, 3]
