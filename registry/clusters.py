"""Neighbour, silhouette, clustering and segmentation queries."""

import re

from pyspark.sql import DataFrame, functions as F

from registry.base import FEATURES, customer_features, facts, facts_sql, hash_sql, query, r, rounded, table, union_all
from veinworks.operators import clustering as K
from veinworks.operators import density as D
from veinworks.operators import neighbors as NB
from veinworks.operators import ranking as RK
from veinworks.operators import silhouette as SI
from veinworks.operators.columns import attach_labels, drop_noise, fill_missing
from veinworks.operators.linkage import linkage_labels
from veinworks.operators.lloyd import fit_many, with_nearest
from veinworks.operators.quantiles import medians
from veinworks.operators.sampling import oversample, split_rows
from veinworks.operators.scaling import standardise, winsorise
from veinworks.session import durable

W = "WITH" + FEATURES
WIDTH = 64
DIMS = [f"e{i}" for i in range(WIDTH)]


def vectors(spark, sf):
    e = table(spark, sf, "embeddings")
    spread = [F.element_at("embedding", i + 1).cast("double").alias(c) for i, c in enumerate(DIMS)]
    return e.select(F.col("vec_id").alias("row_id"), F.col("label").cast("long").alias("label"), *spread)


VEC = "v AS (SELECT vec_id AS id, label::BIGINT AS label, embedding::DOUBLE[] AS e FROM embeddings)"

# ---------------------------------------------------------------- flagship

SEGMENT_COLS = ["acctbal", "total_spend", "n_orders"]
# Illustrative segment centres in standardised units.
CENTERS = [[-1.0, -0.8, -0.8], [1.0, -0.8, -0.8], [-0.5, 1.0, 1.0], [1.0, 1.2, 1.0]]


def prepared_customers(spark, sf):
    """Numbers filled, clamped and standardised."""
    f = customer_features(spark, sf).select(
        "row_id", F.col("acctbal_gaps").alias("acctbal"), "total_spend", F.col("n_orders").cast("double").alias("n_orders")
    )
    filled = fill_missing(f, medians(f, SEGMENT_COLS))
    return standardise(winsorise(filled, SEGMENT_COLS), SEGMENT_COLS)


def segmented_customers(spark, sf):
    return K.nearest_center(prepared_customers(spark, sf), SEGMENT_COLS, CENTERS).drop("squared_distance")


def _prepared_sql():
    med = ", med AS (SELECT median(acctbal_gaps) AS acctbal, median(total_spend) AS total_spend, median(n_orders) AS n_orders FROM features)"
    fill = (", filled AS (SELECT f.row_id, COALESCE(f.acctbal_gaps, m.acctbal) AS acctbal, COALESCE(f.total_spend, m.total_spend) AS total_spend, "
            "COALESCE(f.n_orders, m.n_orders)::DOUBLE AS n_orders FROM features f, med m)")
    bnd = ", bnd AS (SELECT " + ", ".join(f"quantile_cont({c}, 0.05) AS {c}_lo, quantile_cont({c}, 0.95) AS {c}_hi" for c in SEGMENT_COLS) + " FROM filled)"
    clip = ", clipped AS (SELECT row_id, " + ", ".join(f"least(greatest({c}, {c}_lo), {c}_hi) AS {c}" for c in SEGMENT_COLS) + " FROM filled, bnd)"
    st = ", st AS (SELECT " + ", ".join(f"AVG({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in SEGMENT_COLS) + " FROM clipped)"
    z = ", z AS (SELECT row_id, " + ", ".join(f"({c} - {c}_m) / {c}_s AS {c}" for c in SEGMENT_COLS) + " FROM clipped, st)"
    centers = ", centers AS (" + union_all(
        [f"SELECT {i} AS prediction, " + ", ".join(f"{x}::DOUBLE AS c_{c}" for x, c in zip(center, SEGMENT_COLS)) for i, center in enumerate(CENTERS)]
    ) + ")"
    dist = " + ".join(f"({c} - c_{c}) * ({c} - c_{c})" for c in SEGMENT_COLS)
    seg = f", seg AS (SELECT z.*, arg_min(prediction, {dist}) AS prediction FROM z, centers GROUP BY ALL)"
    return W + med + fill + bnd + clip + st + z + centers + seg


SEG = _prepared_sql()


@query(
    "segment_profiles",
    SEG + " SELECT prediction, COUNT(*) AS count, round(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS percentage, "
    + ", ".join(f"round(AVG({c}), 6) AS {c}" for c in SEGMENT_COLS) + " FROM seg GROUP BY prediction",
)
def _(spark, sf):
    seg = segmented_customers(spark, sf)
    sizes = K.cluster_sizes(seg)
    return rounded(sizes.join(K.cluster_profile(seg, SEGMENT_COLS), "prediction"), ["percentage", *SEGMENT_COLS])


@query("nearest_center", SEG + " SELECT row_id, prediction FROM seg")
def _(spark, sf):
    return segmented_customers(spark, sf).select("row_id", "prediction")


@query(
    "attach_labels",
    SEG + " SELECT c_custkey AS row_id, c_mktsegment AS segment, prediction FROM customer JOIN seg ON row_id = c_custkey",
)
def _(spark, sf):
    c = table(spark, sf, "customer").select(F.col("c_custkey").alias("row_id"), F.col("c_mktsegment").alias("segment"))
    return attach_labels(c, segmented_customers(spark, sf).select("row_id", "prediction"))


@query(
    "cluster_sizes",
    "SELECT label AS prediction, COUNT(*) AS count, round(COUNT(*) * 100.0::DOUBLE / SUM(COUNT(*)) OVER (), 6) AS percentage FROM embeddings GROUP BY label",
)
def _(spark, sf):
    return rounded(K.cluster_sizes(table(spark, sf, "embeddings"), "label"), ["percentage"])


@query(
    "cluster_medians",
    SEG + union_all([f"SELECT prediction, '{c}' AS feature, round(median({c}), 6) + 0.0::DOUBLE AS median FROM seg GROUP BY prediction" for c in SEGMENT_COLS]),
)
def _(spark, sf):
    return rounded(K.cluster_medians(segmented_customers(spark, sf), SEGMENT_COLS), ["median"])


_MEANS = "m AS (SELECT label AS prediction, " + ", ".join(f"AVG(embedding[{i + 1}]::DOUBLE) AS e{i}" for i in range(WIDTH)) + " FROM embeddings GROUP BY label)"
_LONG_MEANS = "l AS (" + union_all([f"SELECT prediction, 'e{i}' AS feature, e{i} AS value FROM m" for i in range(WIDTH)]) + ")"


@query(
    "between_cluster_variance",
    f"WITH {_MEANS}, {_LONG_MEANS} SELECT feature, round(var_samp(value), 8) AS variance FROM l GROUP BY feature",
)
def _(spark, sf):
    profile = K.cluster_profile(vectors(spark, sf), DIMS, "label")
    return rounded(K.between_cluster_variance(profile, DIMS), ["variance"], 8)


@query(
    "normalised_profile",
    f"""WITH {_MEANS}, {_LONG_MEANS}, n AS (SELECT prediction, feature, (value - MIN(value) OVER w) / nullif(MAX(value) OVER w - MIN(value) OVER w, 0) AS scaled
      FROM l WINDOW w AS (PARTITION BY feature)),
    t AS (SELECT feature FROM n GROUP BY feature ORDER BY var_samp(scaled) DESC, substr(feature, 2)::INTEGER LIMIT 10)
    SELECT prediction::BIGINT AS prediction, feature, round(scaled, 6) AS scaled FROM n JOIN t USING (feature)""",
)
def _(spark, sf):
    profile = K.cluster_profile(vectors(spark, sf), DIMS, "label")
    return rounded(K.normalised_profile(profile, DIMS, n=10), ["scaled"])


@query(
    "dashboard_profile",
    f"""WITH {_MEANS}, {_LONG_MEANS}, t AS (SELECT feature FROM l GROUP BY feature ORDER BY var_samp(value) DESC, substr(feature, 2)::INTEGER LIMIT 8)
    SELECT prediction::BIGINT AS prediction, feature, round(COALESCE((value - MIN(value) OVER w) / nullif(MAX(value) OVER w - MIN(value) OVER w, 0), 0), 6) AS scaled
      FROM l JOIN t USING (feature) WINDOW w AS (PARTITION BY feature)""",
)
def _(spark, sf):
    return rounded(K.segment_dashboard(vectors(spark, sf), DIMS, "label", n=8)["profile"], ["scaled"])


@query(
    "dashboard_medians",
    f"""WITH {_MEANS}, {_LONG_MEANS}, t AS (SELECT feature FROM l GROUP BY feature ORDER BY var_samp(value) DESC, substr(feature, 2)::INTEGER LIMIT 8),
    x AS ({union_all([f"SELECT label, 'e{i}' AS feature, embedding[{i + 1}]::DOUBLE AS value FROM embeddings" for i in range(WIDTH)])})
    SELECT label::BIGINT AS prediction, feature, round(median(value), 6) AS median FROM x JOIN t USING (feature) GROUP BY label, feature""",
)
def _(spark, sf):
    return rounded(K.segment_dashboard(vectors(spark, sf), DIMS, "label", n=8)["medians"], ["median"])


@query(
    "pair_plot_data",
    f"""WITH x AS ({union_all([f"SELECT vec_id, label, 'e{i}' AS feature, embedding[{i + 1}]::DOUBLE AS value FROM embeddings" for i in range(WIDTH)])}),
    t AS (SELECT feature FROM x GROUP BY feature ORDER BY var_samp(value) DESC, substr(feature, 2)::INTEGER LIMIT 8)
    SELECT vec_id AS row_id, label::BIGINT AS prediction, feature, round(value, 6) AS value FROM x JOIN t USING (feature)""",
)
def _(spark, sf):
    from veinworks.operators.columns import wide_to_long

    v = vectors(spark, sf)
    data = K.pair_plot_data(v.drop("label"), v.select("row_id", F.col("label").alias("prediction")), DIMS, n=8)
    shown = [c for c in data.columns if c not in ("row_id", "prediction")]
    return rounded(wide_to_long(data, shown, ["row_id", "prediction"]), ["value"])


# ------------------------------------------------------- separation indices

_PAIR_MEANS = (
    "WITH " + VEC + ", p AS (SELECT a.id, a.label, b.label AS other, {d} AS d, a.id = b.id AS self FROM v a, v b), "
    "m AS (SELECT id, label, other, SUM(d) AS s, COUNT(*) AS n FROM p GROUP BY ALL), "
    "ab AS (SELECT id, label, MAX(CASE WHEN other = label THEN n END) AS size, MAX(CASE WHEN other = label AND n > 1 THEN s / (n - 1) END) AS a, "
    "MIN(CASE WHEN other <> label THEN s / n END) AS b FROM m GROUP BY id, label), "
    "sil AS (SELECT id, label, CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END AS s FROM ab)"
)
_SQ = "list_distance(a.e, b.e) ** 2"
_EU = "list_distance(a.e, b.e)"


@query("silhouette_samples", _PAIR_MEANS.format(d=_SQ) + " SELECT id AS row_id, label, round(s, 6) + 0.0::DOUBLE AS silhouette FROM sil")
def _(spark, sf):
    return rounded(SI.silhouette_samples(vectors(spark, sf), DIMS, "label"), ["silhouette"])


@query("silhouette_samples_euclidean", _PAIR_MEANS.format(d=_EU) + " SELECT id AS row_id, label, round(s, 6) + 0.0::DOUBLE AS silhouette FROM sil")
def _(spark, sf):
    return rounded(SI.silhouette_samples(vectors(spark, sf), DIMS, "label", metric="euclidean"), ["silhouette"])


for _metric, _away in (
    ("manhattan", "list_sum(list_transform(list_zip(a.e, b.e), lambda z: abs(z[1] - z[2])))"), ("cosine", "CASE WHEN a.id = b.id THEN 0 ELSE list_cosine_distance(a.e, b.e) END"),
):

    @query(f"silhouette_samples_{_metric}", _PAIR_MEANS.format(d=_away) + " SELECT id AS row_id, label, round(s, 6) + 0.0::DOUBLE AS silhouette FROM sil")
    def _(spark, sf, metric=_metric):
        return rounded(SI.silhouette_samples(vectors(spark, sf), DIMS, "label", metric=metric), ["silhouette"])


@query(
    "silhouette_bands",
    _PAIR_MEANS.format(d=_SQ) + " SELECT id AS row_id, label, row_number() OVER (PARTITION BY label ORDER BY s, id) AS position FROM sil",
)
def _(spark, sf):
    samples = SI.silhouette_samples(vectors(spark, sf), DIMS, "label")
    return SI.silhouette_bands(samples, "label").select("row_id", "label", F.col("position").cast("long").alias("position"))


_SUMS = ("x AS (SELECT vec_id AS id, label, unnest(embedding::DOUBLE[]) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings), "
         "c AS (SELECT label, i, AVG(v) AS c, COUNT(*) AS n FROM x GROUP BY label, i), g AS (SELECT i, AVG(v) AS g FROM x GROUP BY i), "
         "k AS (SELECT COUNT(DISTINCT label) AS k, COUNT(DISTINCT id) AS n FROM x)")


@query(
    "clustering_scores",
    _PAIR_MEANS.format(d=_SQ) + ", " + _SUMS + """,
    w AS (SELECT SUM((v - c) ** 2) AS w FROM x JOIN c USING (label, i)), b AS (SELECT SUM(n * (c - g) ** 2) AS b FROM c JOIN g USING (i)),
    pd AS (SELECT id, label, sqrt(SUM((v - c) ** 2)) AS d FROM x JOIN c USING (label, i) GROUP BY id, label),
    sp AS (SELECT label, AVG(d) AS s FROM pd GROUP BY label),
    cd AS (SELECT p.label AS l1, q.label AS l2, sqrt(SUM((p.c - q.c) ** 2)) AS d FROM c p JOIN c q ON p.i = q.i AND p.label <> q.label GROUP BY ALL),
    db AS (SELECT l1, MAX((s1.s + s2.s) / d) AS r FROM cd JOIN sp s1 ON l1 = s1.label JOIN sp s2 ON l2 = s2.label GROUP BY l1)
    SELECT 'silhouette_sqeuclidean' AS metric, round(AVG(s), 6) + 0.0::DOUBLE AS value FROM sil
    UNION ALL SELECT 'calinski_harabasz', round((b / (k - 1)) / (w / (n - k)), 6) FROM w, b, k
    UNION ALL SELECT 'davies_bouldin', round(AVG(r), 6) FROM db UNION ALL SELECT 'inertia', round(w, 6) FROM w""",
)
def _(spark, sf):
    return rounded(SI.clustering_scores(vectors(spark, sf), DIMS, "label"), ["value"])


# ------------------------------------------------------------- neighbours


@query(
    "nearest_neighbors",
    f"""WITH {VEC}, p AS (SELECT a.id AS query_id, b.id AS neighbor_id, {_EU} AS d FROM v a JOIN v b ON a.id <> b.id),
    k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, neighbor_id) AS rank FROM p)
    SELECT query_id, neighbor_id, round(d, 6) AS distance, rank::INTEGER AS rank FROM k WHERE rank <= 50""",
)
def _(spark, sf):
    return rounded(NB.nearest_neighbors(vectors(spark, sf), DIMS, 50), ["distance"])


@query(
    "nearest_neighbors_by_class",
    f"""WITH {VEC}, p AS (SELECT a.id AS query_id, b.id AS neighbor_id, {_EU} AS d FROM v a JOIN v b ON a.id <> b.id AND a.label = b.label),
    k AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY d, neighbor_id) AS rank FROM p)
    SELECT query_id, neighbor_id, round(d, 6) AS distance, rank::INTEGER AS rank FROM k WHERE rank <= 5""",
)
def _(spark, sf):
    return rounded(NB.nearest_neighbors(vectors(spark, sf), DIMS, 5, group="label"), ["distance"])


@query(
    "neighbor_classification",
    f"""WITH {VEC}, y AS (SELECT id, e, (label < 5)::INTEGER AS y, {hash_sql('id')} < 429496729 AS test FROM v),
    p AS (SELECT a.id AS row_id, b.y, row_number() OVER (PARTITION BY a.id ORDER BY {_EU}, b.id) AS rank
      FROM y a JOIN y b ON a.test AND NOT b.test)
    SELECT row_id, CASE WHEN AVG(y) > 0.5 THEN 1 ELSE 0 END::INTEGER AS prediction, round(AVG(y), 6) AS score FROM p WHERE rank <= 5 GROUP BY row_id""",
)
def _(spark, sf):
    v = vectors(spark, sf).withColumn("label", (F.col("label") < 5).cast("int"))
    train, test = split_rows(v, 0.2)
    return rounded(NB.classify_by_neighbors(train, test, DIMS, 5), ["score"])


@query(
    "neighbor_distance_range",
    W + f""", s AS (SELECT row_id, acctbal, total_spend FROM features ORDER BY {hash_sql('row_id')}, row_id LIMIT 1000),
    z AS (SELECT row_id, (acctbal - AVG(acctbal) OVER ()) / stddev_pop(acctbal) OVER () AS x, (total_spend - AVG(total_spend) OVER ()) / stddev_pop(total_spend) OVER () AS y FROM s),
    p AS (SELECT a.row_id, sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS d, b.row_id AS o FROM z a JOIN z b ON a.row_id <> b.row_id),
    k AS (SELECT d, row_number() OVER (PARTITION BY row_id ORDER BY d, o) AS rank FROM p)
    SELECT round(quantile_cont(d, 0.05), 6) AS eps_low, round(quantile_cont(d, 0.95), 6) AS eps_high FROM k WHERE rank <= 49""",
)
def _(spark, sf):
    low, high = NB.neighbor_distance_range(customer_features(spark, sf), ["acctbal", "total_spend"])
    return spark.createDataFrame([(round(low, 6), round(high, 6))], "eps_low double, eps_high double")


def plane(spark, sf):
    """Two standardised coordinates per customer."""
    f = customer_features(spark, sf).select("row_id", F.col("acctbal").alias("x"), F.col("total_spend").alias("y"))
    return standardise(f, ["x", "y"])


PLANE = W + (", z AS (SELECT row_id, (acctbal - AVG(acctbal) OVER ()) / stddev_pop(acctbal) OVER () AS x, "
             "(total_spend - AVG(total_spend) OVER ()) / stddev_pop(total_spend) OVER () AS y FROM features)")


@query(
    "pairs_within",
    PLANE + "SELECT a.row_id AS left_id, b.row_id AS right_id, round(sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2), 6) AS distance "
    "FROM z a JOIN z b ON a.row_id < b.row_id AND abs(a.x - b.x) <= 0.05 WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= 0.05",
)
def _(spark, sf):
    return rounded(NB.pairs_within(plane(spark, sf), ["x", "y"], 0.05), ["distance"])


def _dbscan_sql(eps, min_samples):
    return PLANE.replace("WITH", "WITH RECURSIVE", 1) + f""", pairs AS (SELECT a.row_id AS a, b.row_id AS b FROM z a JOIN z b
      ON abs(a.x - b.x) <= {eps} AND abs(a.y - b.y) <= {eps} WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= {eps}),
    core AS (SELECT a AS id FROM pairs GROUP BY a HAVING COUNT(*) >= {min_samples}),
    edges AS (SELECT a, b FROM pairs JOIN core c1 ON a = c1.id JOIN core c2 ON b = c2.id),
    walk(node, root) AS (SELECT id, id FROM core UNION SELECT e.b, w.root FROM walk w JOIN edges e ON e.a = w.node WHERE w.root < e.b),
    comp AS (SELECT node, MIN(root) AS cluster FROM walk GROUP BY node),
    border AS (SELECT p.a AS node, MIN(c.cluster) AS cluster FROM pairs p JOIN comp c ON c.node = p.b WHERE p.a NOT IN (SELECT id FROM core) GROUP BY p.a),
    named AS (SELECT node, cluster, true AS is_core FROM comp UNION ALL SELECT node, cluster, false FROM border),
    labels AS (SELECT row_id, COALESCE(cluster, -1)::BIGINT AS prediction, COALESCE(is_core, false) AS is_core FROM z LEFT JOIN named ON node = row_id)"""


for _name, _eps, _min in (("dbscan", 0.12, 5), ("dbscan_small_eps", 0.08, 5), ("dbscan_many_samples", 0.2, 20)):

    @query(_name, _dbscan_sql(_eps, _min) + " SELECT row_id, prediction, is_core FROM labels")
    def _(spark, sf, eps=_eps, m=_min):
        return D.dbscan(plane(spark, sf), ["x", "y"], eps, m)


@query(
    "noise_and_clusters",
    _dbscan_sql(0.12, 5) + " SELECT COUNT(*) AS n_rows, COUNT(DISTINCT prediction) FILTER (prediction <> -1) AS n_clusters, COUNT(*) FILTER (prediction = -1) AS n_noise FROM labels",
)
def _(spark, sf):
    return D.noise_and_clusters(D.dbscan(plane(spark, sf), ["x", "y"], 0.12, 5))


@query("drop_noise", _dbscan_sql(0.12, 5) + " SELECT row_id, prediction FROM labels WHERE prediction <> -1")
def _(spark, sf):
    return drop_noise(D.dbscan(plane(spark, sf), ["x", "y"], 0.12, 5)).select("row_id", "prediction")


def _grid_sql(eps_values, min_samples, only_without_noise=False):
    """Counts and silhouette of every setting; labels spread from row to row in as many steps as the plane is wide."""
    ctes, parts = [PLANE.replace("WITH", "WITH RECURSIVE", 1)], []
    for j, eps in enumerate(eps_values):
        steps = 150 if eps < 0.25 else 40
        ctes.append(
            f"p{j} AS MATERIALIZED (SELECT a.row_id AS a, b.row_id AS b FROM z a JOIN z b ON abs(a.x - b.x) <= {eps} "
            f"WHERE sqrt((a.x - b.x) ** 2 + (a.y - b.y) ** 2) <= {eps}), c{j} AS (SELECT a AS id, COUNT(*) AS n FROM p{j} GROUP BY a)"
        )
        for m in min_samples:
            i = f"{j}_{m}"
            ctes.append(
                f"k{i} AS MATERIALIZED (SELECT id FROM c{j} WHERE n >= {m}), "
                f"e{i} AS MATERIALIZED (SELECT a, b FROM p{j} JOIN k{i} u ON a = u.id JOIN k{i} v ON b = v.id), "
                f"w{i}(step, node, root) AS (SELECT 0, id, id FROM k{i} UNION ALL SELECT step + 1, e.a, MIN(root) FROM w{i} JOIN e{i} e ON e.b = node WHERE step < {steps} GROUP BY step, e.a), "
                f"f{i} AS MATERIALIZED (SELECT node, root AS cluster FROM w{i} WHERE step = {steps}), "
                f"o{i} AS (SELECT a AS node, MIN(cluster) AS cluster FROM p{j} JOIN f{i} ON node = b WHERE a NOT IN (SELECT id FROM k{i}) GROUP BY a), "
                f"q{i} AS MATERIALIZED (SELECT row_id AS id, x, y, cluster AS label FROM z JOIN (FROM f{i} UNION ALL FROM o{i}) ON node = row_id), "
                f"m{i} AS (SELECT a.id, a.label, b.label AS other, SUM((a.x - b.x) ** 2 + (a.y - b.y) ** 2) AS s, COUNT(*) AS n FROM q{i} a, q{i} b GROUP BY ALL), "
                f"ab{i} AS (SELECT id, MAX(CASE WHEN other = label THEN n END) AS size, MAX(CASE WHEN other = label AND n > 1 THEN s / (n - 1) END) AS a, "
                f"MIN(CASE WHEN other <> label THEN s / n END) AS b FROM m{i} GROUP BY id)"
            )
            noise = f"(SELECT COUNT(*) FROM z) - (SELECT COUNT(*) FROM q{i})"
            score = f"(SELECT round(AVG(CASE WHEN size = 1 THEN 0 ELSE (b - a) / greatest(a, b) END), 6) FROM ab{i} WHERE b IS NOT NULL)"
            if only_without_noise:
                score = f"CASE WHEN {noise} = 0 THEN COALESCE({score}, -1) ELSE -1 END"
            parts.append(
                f"SELECT 'dbscan' AS method, {eps}::DOUBLE AS eps, {m}::INTEGER AS min_samples, "
                f"(SELECT COUNT(DISTINCT label) FROM q{i}) AS n_clusters, {noise} AS n_noise, {score} AS silhouette"
            )
    return ", ".join(ctes) + union_all(parts)


@query("dbscan_grid", _grid_sql((0.1, 0.325, 0.55, 0.775, 1.0), (5, 10, 15, 20)))
def _(spark, sf):
    found = D.dbscan_grid(plane(spark, sf), ["x", "y"])["sweep"]
    return rounded(rounded(found, ["eps"], 3), ["silhouette"])


_EPS = tuple(0.1 + 1.9 * i / 9 for i in range(10))


@query("dbscan_eps_sweep", "SELECT * REPLACE (round(eps, 3) AS eps) FROM (" + _grid_sql(_EPS, (5,), True) + ")")
def _(spark, sf):
    found = D.dbscan_eps_sweep(plane(spark, sf), ["x", "y"])["sweep"]
    return rounded(rounded(found, ["eps"], 3), ["silhouette"])


_SWEEP = """s AS (SELECT l_tax AS eps, l_linenumber AS min_samples, COUNT(DISTINCT l_suppkey) - 95 AS n_clusters,
    COUNT(*) FILTER (l_returnflag = 'R') AS n_noise, CASE WHEN AVG(l_discount) > 0.0495 THEN AVG(l_discount) END AS silhouette
    FROM lineitem GROUP BY 1, 2)"""


def _sweep_table(spark, sf):
    """A table shaped like a sweep, derived from order lines."""
    li = table(spark, sf, "lineitem")
    return li.groupBy(F.col("l_tax").alias("eps"), F.col("l_linenumber").alias("min_samples")).agg(
        (F.count_distinct("l_suppkey") - 95).alias("n_clusters"),
        F.count_if(F.col("l_returnflag") == "R").alias("n_noise"),
        F.when(F.avg("l_discount") > 0.0495, F.avg("l_discount")).alias("silhouette"),
    )


@query(
    "valid_settings",
    f"WITH {_SWEEP} SELECT eps, min_samples, n_clusters, n_noise, round(silhouette, 6) AS silhouette FROM s WHERE n_clusters >= 2 AND n_noise < 0.5 * 700 AND silhouette IS NOT NULL",
)
def _(spark, sf):
    return rounded(RK.valid_settings(_sweep_table(spark, sf), 700), ["silhouette"])


@query(
    "setting_matrix",
    f"WITH {_SWEEP} SELECT eps, " + ", ".join(
        f'COALESCE(round(MAX(silhouette) FILTER (min_samples = {m}), 6), 0) AS "{m}"' for m in range(1, 8)
    ) + " FROM s GROUP BY eps",
)
def _(spark, sf):
    return rounded(RK.setting_matrix(_sweep_table(spark, sf), range(1, 8)), [str(m) for m in range(1, 8)])


@query(
    "best_setting",
    f"WITH {_SWEEP} SELECT eps, min_samples, round(silhouette, 6) AS silhouette FROM s ORDER BY s.silhouette DESC NULLS LAST, eps, min_samples LIMIT 1",
)
def _(spark, sf):
    best = RK.best_row(_sweep_table(spark, sf), "silhouette", ["eps", "min_samples"])
    return rounded(best.select("eps", "min_samples", "silhouette"), ["silhouette"])


@query(
    "elbow",
    """WITH k AS (SELECT (l_linenumber + CASE WHEN l_linenumber > 4 THEN 2 ELSE 1 END)::INTEGER AS k, SUM(l_extendedprice) / l_linenumber AS inertia FROM lineitem GROUP BY l_linenumber),
    d AS (SELECT k, inertia, lag(k) OVER (ORDER BY k) AS pk, CASE WHEN lag(k) OVER (ORDER BY k) = k - 1 THEN lag(inertia) OVER (ORDER BY k) - inertia ELSE 0 END AS drop FROM k)
    SELECT k, round(inertia, 2) AS inertia, round("drop", 2) AS "drop" FROM d WHERE pk IS NOT NULL ORDER BY d."drop" DESC, k LIMIT 1""",
)
def _(spark, sf):
    n = F.col("l_linenumber")
    k = table(spark, sf, "lineitem").groupBy(n).agg((F.sum("l_extendedprice") / n).alias("inertia"))
    k = k.select((n + F.when(n > 4, 2).otherwise(1)).alias("k"), "inertia")
    return rounded(RK.elbow(k), ["inertia", "drop"], 2)


# ------------------------------------- clustering, checked by what must hold

_EMBEDDED = "SELECT COUNT(*) FROM embeddings"
_CUSTOMERS = "SELECT COUNT(*) FROM customer"


def _sweep_facts(spark, found, n_rows) -> DataFrame:
    """Settings tried, whether the winner has the best score, and the rows labelled."""
    rows = [r for r in found["sweep"].collect() if r["silhouette"] is not None]
    best = max((r["silhouette"] for r in rows), default=None)
    return facts(
        spark, settings=found["sweep"].count(), winner_is_best=found["silhouette"] == best,
        in_range=all(-1 <= r["silhouette"] <= 1 for r in rows), rows=n_rows, labelled=found["labels"].count(),
        clusters_match=found["labels"].select("prediction").distinct().where("prediction >= 0").count() == found["n_clusters"],
    )


def _sweep_facts_sql(settings: str, rows: str) -> str:
    return facts_sql(settings=settings, winner_is_best=1, in_range=1, rows=rows, labelled=rows, clusters_match=1)


@query("kmeans", facts_sql(rows=_EMBEDDED, clusters=10, misplaced=0, cheapest=1))
def _(spark, sf):
    v = vectors(spark, sf)
    model, cost = K.fit_kmeans(v, DIMS, 10)
    found = K.assign_kmeans(v, DIMS, model)
    nearest = K.nearest_center(v, DIMS, [list(c) for c in model.clusterCenters()]).select("row_id", F.col("prediction").alias("nearest"))
    seen = found.join(nearest, "row_id").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("prediction").alias("clusters"), F.count_if(F.col("prediction") != F.col("nearest")).alias("misplaced")
    ).first()
    return facts(spark, **seen.asDict(), cheapest=cost <= K.fit_kmeans(v, DIMS, 10, starts=1)[1] + 1e-6)


_BALANCES = "x AS (SELECT c_custkey AS id, c_acctbal AS v FROM customer WHERE c_acctbal IS NOT NULL)"


@query(
    "kmeans_one_column",
    f"""WITH {_BALANCES}, s AS (SELECT row_number() OVER (ORDER BY v, id) AS i, SUM(v) OVER o AS s, SUM(v * v) OVER o AS q, COUNT(*) OVER () AS n FROM x
      WINDOW o AS (ORDER BY v, id ROWS UNBOUNDED PRECEDING)),
    t AS (SELECT n, s AS total, q AS squares FROM s WHERE i = n), c AS (SELECT i, s FROM s WHERE i < n),
    two AS (SELECT squares - s * s / i - (total - s) ** 2 / (n - i) AS cost, i AS n1, n - i AS n2, 0 AS n3 FROM c, t),
    three AS (SELECT squares - a.s * a.s / a.i - (b.s - a.s) ** 2 / (b.i - a.i) - (total - b.s) ** 2 / (n - b.i) AS cost,
      a.i AS n1, b.i - a.i AS n2, n - b.i AS n3 FROM c a JOIN c b ON a.i < b.i, t)
    SELECT * FROM (SELECT 2 AS k, round(cost / 1e6, 3) AS cost, n1, n2, n3 FROM two ORDER BY two.cost LIMIT 1)
    UNION ALL SELECT * FROM (SELECT 3 AS k, round(cost / 1e6, 3) AS cost, n1, n2, n3 FROM three ORDER BY three.cost LIMIT 1)""",
)
def _(spark, sf):
    """Cost and sizes of the best clusters of one column, where the optimum can be found from split points."""
    rows = table(spark, sf, "customer").where("c_acctbal is not null").select(F.col("c_custkey").alias("row_id"), F.col("c_acctbal").alias("v"))
    fitted = fit_many(rows, ["v"], {2: 10, 3: 10}, tolerance=0.0)
    ordered = {k: m.points[m.points[:, 0].argsort()] for k, m in fitted.items()}
    labels = with_nearest(rows, ["v"], {f"k{k}": c for k, c in ordered.items()})
    parts = []
    for k, c in ordered.items():
        near = labels.join(F.broadcast(spark.createDataFrame([(i, float(x[0])) for i, x in enumerate(c)], "c long, m double")), F.col(f"k{k}") == F.col("c"))
        sizes = [F.count_if(F.col("c") == i).alias(f"n{i + 1}") for i in range(3)]
        parts.append(near.agg(F.round(F.sum((F.col("v") - F.col("m")) ** 2) / 1e6, 3).alias("cost"), *sizes).withColumn("k", F.lit(k)))
    return parts[0].unionByName(parts[1]).select("k", "cost", "n1", "n2", "n3")


_LINKED = {
    "single": ("sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2)", "MIN(d)"),
    "complete": ("sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2)", "MAX(d)"),
    "average": ("sqrt((p.x - q.x) ** 2 + (p.y - q.y) ** 2)", "SUM(wm * d) / SUM(wm)"),
    "ward": ("((p.x - q.x) ** 2 + (p.y - q.y) ** 2) / 2", "(SUM((wm + wo) * d) - ANY_VALUE(wo) * ANY_VALUE(m.d)) / (SUM(wm) + ANY_VALUE(wo))"),
}
_CUTS = (2, 4, 7)


def _linkage_sql(linkage: str) -> str:
    """Merge the nearest pair step by step; the distances of a merged pair follow from its parts."""
    first, joined = _LINKED[linkage]
    cuts = ", ".join(f"(SELECT COUNT(*) - {k} FROM v) AS s{k}" for k in _CUTS)
    walks = "".join(
        f", w{k}(id, node) AS (SELECT id, id FROM v UNION ALL SELECT w{k}.id, m.a FROM w{k} JOIN merged m ON m.b = w{k}.node, cutoff WHERE m.step < cutoff.s{k}), "
        f"l{k} AS (SELECT id, MIN(node) AS root FROM w{k} GROUP BY id)" for k in _CUTS
    )
    labels = ", ".join(f"dense_rank() OVER (ORDER BY l{k}.root) - 1 AS k{k}" for k in _CUTS)
    joins = " ".join(f"JOIN l{k} USING (id)" for k in _CUTS)
    return f"""WITH RECURSIVE v AS (SELECT s_suppkey AS id, s_acctbal / 1000 AS x, s_nationkey / 5.0 AS y FROM supplier),
    p(step, a, b, d, wa, wb) AS (SELECT 0, p.id, q.id, {first}, 1.0::DOUBLE, 1.0::DOUBLE FROM v p JOIN v q ON p.id < q.id
      UNION ALL
      SELECT step, na, nb, CASE WHEN COUNT(*) = 1 THEN ANY_VALUE(d) ELSE {joined} END, MAX(ua), MAX(ub) FROM (
        SELECT step + 1 AS step, m, d, least(ea, eb) AS na, greatest(ea, eb) AS nb, CASE WHEN ea < eb THEN va ELSE vb END AS ua, CASE WHEN ea < eb THEN vb ELSE va END AS ub,
          CASE WHEN ea = m.a THEN wa ELSE wb END AS wm, CASE WHEN ea = m.a THEN wb ELSE wa END AS wo FROM (
          SELECT *, CASE WHEN a = m.b THEN m.a ELSE a END AS ea, CASE WHEN b = m.b THEN m.a ELSE b END AS eb,
            CASE WHEN a IN (m.a, m.b) THEN m.wa + m.wb ELSE wa END AS va, CASE WHEN b IN (m.a, m.b) THEN m.wa + m.wb ELSE wb END AS vb FROM (
            SELECT *, first_value({{'a': a, 'b': b, 'd': d, 'wa': wa, 'wb': wb}}) OVER (ORDER BY d, a, b) AS m FROM p) WHERE NOT (a = m.a AND b = m.b)))
      GROUP BY step, na, nb),
    merged AS (SELECT step, arg_min(a, d) AS a, arg_min(b, d) AS b FROM p GROUP BY step), cutoff AS (SELECT {cuts}){walks}
    SELECT id AS row_id, {labels} FROM v {joins}"""


for _linkage in _LINKED:

    @query(f"hierarchical_{_linkage}", _linkage_sql(_linkage))
    def _(spark, sf, linkage=_linkage):
        rows = table(spark, sf, "supplier").select(
            F.col("s_suppkey").alias("row_id"), (F.col("s_acctbal") / 1000).alias("x"), (F.col("s_nationkey") / 5).alias("y")
        )
        return linkage_labels(rows, ["x", "y"], _CUTS, linkage)


@query("kmeans_sweep", _sweep_facts_sql("9", _CUSTOMERS))
def _(spark, sf):
    found = K.kmeans_sweep(prepared_customers(spark, sf), SEGMENT_COLS)
    return _sweep_facts(spark, found, table(spark, sf, "customer").count())


@query("hierarchical", facts_sql(rows=_EMBEDDED, clusters=10, nested=1))
def _(spark, sf):
    v = vectors(spark, sf)
    fine = K.hierarchical_labels(v, DIMS, 10)
    both = fine.join(K.hierarchical_labels(v, DIMS, 2).withColumnRenamed("prediction", "half"), "row_id")
    groups = both.groupBy("prediction").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("half").alias("halves"))
    seen = groups.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("clusters"), (F.max("halves") == 1).cast("int").alias("nested")).first()
    return facts(spark, **seen.asDict())


@query("hierarchical_sweep", _sweep_facts_sql("9", _CUSTOMERS))
def _(spark, sf):
    found = K.hierarchical_sweep(prepared_customers(spark, sf), SEGMENT_COLS)
    return _sweep_facts(spark, found, table(spark, sf, "customer").count())


@query("run_clustering", facts_sql(methods=3, kmeans_settings=9, hierarchical_settings=9, winner_is_best=1, labelled=_CUSTOMERS))
def _(spark, sf):
    found = K.run_clustering(prepared_customers(spark, sf), SEGMENT_COLS)
    rows = found["sweep"].collect()
    methods = [r["method"] for r in rows]
    best = max(r["silhouette"] for r in rows if r["silhouette"] is not None)
    return facts(
        spark, methods=len(set(methods)), kmeans_settings=methods.count("kmeans"), hierarchical_settings=methods.count("hierarchical"),
        winner_is_best=abs(best - found["silhouette"]) < 1e-9, labelled=found["labels"].count(),
    )


@query("segmentation", facts_sql(methods=3, winner_is_best=1, rows=_CUSTOMERS, clusters_match=1))
def _(spark, sf):
    f = customer_features(spark, sf).select(
        "row_id", F.col("acctbal_gaps").alias("Income"), F.col("n_orders").alias("NumStorePurchases"), F.col("total_spend").alias("MntTotal")
    )
    found = K.segmentation(f)
    scores = {r["method"]: r["silhouette"] for r in found["scores"].collect()}
    sizes = K.cluster_sizes(found["labels"]).collect()
    return facts(
        spark, methods=len(scores), winner_is_best=scores[found["method"]] == max(scores.values()), rows=sum(r["count"] for r in sizes),
        clusters_match=sum(r["prediction"] >= 0 for r in sizes) == found["n_clusters"],
    )


@query("cluster_overview", facts_sql(rows=_EMBEDDED, clusters="SELECT COUNT(DISTINCT label) FROM embeddings", ordered=1, uncorrelated=1))
def _(spark, sf):
    v = vectors(spark, sf)
    points = K.cluster_overview(v.drop("label"), v.select("row_id", F.col("label").alias("prediction")), DIMS)["projection"]
    seen = points.agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("prediction").alias("clusters"),
        (F.var_samp("pc1") >= F.var_samp("pc2")).cast("int").alias("ordered"), (F.abs(F.corr("pc1", "pc2")) < 1e-6).cast("int").alias("uncorrelated"),
    ).first()
    return facts(spark, **seen.asDict())


@query(
    "cluster_overview_boxes",
    f"""WITH x AS ({union_all([f"SELECT label::BIGINT AS prediction, 'e{i}' AS feature, embedding[{i + 1}]::DOUBLE AS value FROM embeddings" for i in range(WIDTH)])})
    SELECT prediction, feature, round(quantile_cont(value, 0.25), 6) AS q1, round(quantile_cont(value, 0.5), 6) AS median, round(quantile_cont(value, 0.75), 6) AS q3 FROM x GROUP BY ALL""",
)
def _(spark, sf):
    v = vectors(spark, sf)
    tables = K.cluster_overview(v.drop("label"), v.select("row_id", F.col("label").alias("prediction")), DIMS)
    return rounded(tables["boxes"].select("prediction", "feature", "q1", "median", "q3"), ["q1", "median", "q3"])


@query(
    "clustering_report",
    facts_sql(projected=_EMBEDDED, silhouettes=_EMBEDDED, sizes="SELECT COUNT(DISTINCT label) FROM embeddings", in_range=1, same_mean=1),
)
def _(spark, sf):
    v = vectors(spark, sf)
    tables = K.clustering_report(v.drop("label"), v.select("row_id", F.col("label").alias("prediction")), DIMS)
    seen = tables["silhouettes"].agg(F.count("silhouette").alias("n"), F.min("silhouette").alias("low"), F.max("silhouette").alias("high"), F.avg("silhouette").alias("mean")).first()
    scores = {r[0]: r["value"] for r in tables["scores"].collect()}
    return facts(
        spark, projected=tables["projection"].count(), silhouettes=seen["n"], sizes=tables["dashboard_sizes"].count(),
        in_range=-1 <= seen["low"] <= seen["high"] <= 1, same_mean=any(v is not None and abs(v - seen["mean"]) < 1e-6 for v in scores.values()),
    )


# ------------------------------------------------------------ oversampling

_SMOTE = f"""WITH d AS (SELECT d.doc_id, quality, n_chars::DOUBLE AS n_chars, toxic::DOUBLE AS toxic FROM documents d JOIN labels l ON d.doc_id = l.doc_id),
    c AS (SELECT quality, COUNT(*) AS n FROM d GROUP BY quality), big AS (SELECT MAX(n) AS b FROM c),
    r AS (SELECT d.*, n, b, row_number() OVER (PARTITION BY d.quality ORDER BY {hash_sql('doc_id')}, doc_id) AS place
      FROM d JOIN c USING (quality), big WHERE n > 1 AND n < b),
    u AS (SELECT *, (b - n) // n + CASE WHEN place <= (b - n) % n THEN 1 ELSE 0 END AS uses FROM r),
    draws AS (SELECT doc_id, quality, n_chars, toxic, n, unnest(range(1, uses + 1)) AS draw FROM u WHERE uses > 0),
    p AS (SELECT a.doc_id AS id, b.doc_id AS near, b.n_chars AS nc, b.toxic AS nt, row_number() OVER (PARTITION BY a.doc_id
      ORDER BY sqrt((a.n_chars - b.n_chars) ** 2 + (a.toxic - b.toxic) ** 2), b.doc_id) AS rank
      FROM r a JOIN r b ON a.quality = b.quality AND a.doc_id <> b.doc_id),
    made AS (SELECT doc_id, quality, n_chars, toxic, nc, nt, {hash_sql('doc_id * 31 + draw', 44)} / 2147483647.0::DOUBLE AS step
      FROM draws JOIN p ON p.id = doc_id AND p.rank = {hash_sql('doc_id * 31 + draw', 43)} % least(5, n - 1) + 1)
    SELECT doc_id, quality, n_chars, toxic, false AS synthetic FROM d
    UNION ALL SELECT doc_id, quality, round(n_chars + step * (nc - n_chars), 6), round(toxic + step * (nt - toxic), 6), true FROM made"""


@query("oversample", _SMOTE)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "n_chars").join(table(spark, sf, "labels"), "doc_id")
    return rounded(oversample(d, "quality", ["n_chars", "toxic"], "doc_id"), ["n_chars", "toxic"])
