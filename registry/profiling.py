"""Profiling queries."""

from pyspark.sql import functions as F

from registry.base import AS_OF, FEATURES, NUMBERS, customer_features, query, r, rounded, table, union_all
from veinworks.operators import columns as C
from veinworks.operators import correlation as R
from veinworks.operators import profile as P
from veinworks.operators import quantiles as Q
from veinworks.operators.columns import wide_to_long

GAPPY = NUMBERS + ["mostly_missing", "constant_col"]


@query(
    "describe_source",
    "SELECT COUNT(*) AS n_rows, CAST(6 AS INTEGER) AS n_columns, "
    "'o_orderkey,o_custkey,o_orderstatus,o_totalprice,o_orderdate,o_orderpriority' AS columns FROM orders",
)
def _(spark, sf):
    out = C.describe_source(table(spark, sf, "orders"))
    return out.withColumn("columns", F.array_join("columns", ","))


@query(
    "missing_values",
    "WITH" + FEATURES + ", n AS (SELECT COUNT(*) AS n FROM features), m AS ("
    + union_all(
        [
            f"SELECT '{c}' AS feature, COUNT(*) - COUNT({c}) AS missing FROM features"
            for c in ["mostly_missing", "acctbal_gaps", "segment_gaps", "avg_order", "first_order_date",
                      "last_order_date", "segment", "acctbal", "high_card"]
        ]
    )
    + ") SELECT feature, missing, round(missing * 100.0::DOUBLE / n, 6) AS missing_pct FROM m, n WHERE missing > 0",
)
def _(spark, sf):
    return rounded(P.missing_values(customer_features(spark, sf)), ["missing_pct"])


@query(
    "describe_numeric",
    "WITH" + FEATURES + ", n AS (SELECT COUNT(*) AS n FROM features)"
    + union_all(
        [
            f"""SELECT '{c}' AS feature, COUNT({c}) AS count, round(AVG({c}), 4) AS mean,
            round(STDDEV_SAMP({c}), 4) AS std, round(MIN({c})::DOUBLE, 4) AS min,
            round(quantile_cont({c}::DOUBLE, 0.25), 4) AS p25, round(quantile_cont({c}::DOUBLE, 0.5), 4) AS p50,
            round(quantile_cont({c}::DOUBLE, 0.75), 4) AS p75, round(MAX({c})::DOUBLE, 4) AS max,
            COUNT(*) - COUNT({c}) AS missing, round((COUNT(*) - COUNT({c})) * 100.0::DOUBLE / COUNT(*), 4) AS missing_pct
            FROM features"""
            for c in GAPPY
        ]
    ),
)
def _(spark, sf):
    out = P.describe_numeric(customer_features(spark, sf), GAPPY)
    return rounded(out, ["mean", "std", "min", "p25", "p50", "p75", "max", "missing_pct"], 4)


@query(
    "lineitem_quantiles",
    union_all(
        [
            f"""SELECT '{c}' AS feature, quantile_cont({c}, 0.05) AS p05, quantile_cont({c}, 0.5) AS p50,
            quantile_cont({c}, 0.95) AS p95 FROM lineitem"""
            for c in ["l_quantity", "l_extendedprice", "l_discount"]
        ]
    ).replace("quantile_cont(", "round(quantile_cont(").replace("05) AS", "05), 4) AS").replace("0.5) AS", "0.5), 4) AS").replace("95) AS", "95), 4) AS"),
)
def _(spark, sf):
    out = Q.quantile_table(
        table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], [0.05, 0.5, 0.95],
        ["p05", "p50", "p95"],
    )
    return rounded(out, ["p05", "p50", "p95"], 4)


@query(
    "median_per_column",
    "WITH" + FEATURES
    + union_all([f"SELECT '{c}' AS feature, round(median({c}::DOUBLE), 6) AS median FROM features" for c in GAPPY]),
)
def _(spark, sf):
    out = Q.quantile_table(customer_features(spark, sf), GAPPY, [0.5], ["median"])
    return rounded(out, ["median"])


@query(
    "distinct_counts",
    "WITH" + FEATURES
    + union_all(
        [f"SELECT '{c}' AS feature, COUNT(DISTINCT {c}) AS n_distinct FROM features" for c in ["segment", "segment_gaps", "high_card"]]
    ),
)
def _(spark, sf):
    return P.distinct_counts(customer_features(spark, sf), ["segment", "segment_gaps", "high_card"])


@query(
    "value_counts",
    "WITH" + FEATURES + """, n AS (SELECT COUNT(*) AS n FROM features)
    SELECT segment_gaps AS value, COUNT(*) AS count, round(COUNT(*) * 100.0::DOUBLE / MAX(n), 6) AS percentage
    FROM features, n WHERE segment_gaps IS NOT NULL GROUP BY segment_gaps""",
)
def _(spark, sf):
    return rounded(P.value_counts(customer_features(spark, sf), "segment_gaps"), ["percentage"])


@query(
    "top_values",
    """SELECT p_type AS value, COUNT(*) AS count, round(COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM part), 6) AS percentage
    FROM part WHERE p_type IS NOT NULL GROUP BY p_type ORDER BY count DESC, value LIMIT 10""",
)
def _(spark, sf):
    return rounded(P.top_values(table(spark, sf, "part"), "p_type"), ["percentage"])


@query(
    "value_range",
    "WITH" + FEATURES
    + "SELECT round(least(MIN(acctbal), MIN(n_orders), MIN(total_spend)), 4) AS low, "
    "round(greatest(MAX(acctbal), MAX(n_orders), MAX(total_spend)), 4) AS high, "
    "greatest(MAX(acctbal), MAX(n_orders), MAX(total_spend)) > 10 OR least(MIN(acctbal), MIN(n_orders), MIN(total_spend)) < -10 AS needs_scaling FROM features",
)
def _(spark, sf):
    f = customer_features(spark, sf)
    cols = ["acctbal", "n_orders", "total_spend"]
    low, high = P.value_range(f, cols)
    return rounded(spark.createDataFrame([(low, high, high > 10 or low < -10)], "low double, high double, needs_scaling boolean"), ["low", "high"], 4)


_CORR_COLS = NUMBERS + ["constant_col"]
_PAIRS = [(a, b) for i, a in enumerate(_CORR_COLS) for b in _CORR_COLS[i + 1:]]
_PAIRS_SQL = union_all(
    [
        f"""SELECT '{a}' AS feature1, '{b}' AS feature2, CASE WHEN stddev_pop({a}) FILTER ({b} IS NOT NULL) > 0
        AND stddev_pop({b}) FILTER ({a} IS NOT NULL) > 0 THEN corr({a}, {b}) END AS correlation FROM features"""
        for a, b in _PAIRS
    ]
)


@query(
    "correlation_pairs",
    "WITH" + FEATURES + ", pairs AS (" + _PAIRS_SQL + ") SELECT feature1, feature2, round(correlation, 6) AS correlation FROM pairs",
)
def _(spark, sf):
    return rounded(R.correlation_pairs(customer_features(spark, sf), _CORR_COLS), ["correlation"])


@query(
    "correlation_matrix",
    union_all(
        [
            f"SELECT '{a}' AS feature1, '{b}' AS feature2, round(corr({a}, {b}), 6) AS correlation FROM lineitem"
            for a in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
            for b in ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
        ]
    ),
)
def _(spark, sf):
    cols = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
    return rounded(R.correlation_matrix(table(spark, sf, "lineitem"), cols), ["correlation"])


for _name, _sql_order in (("top_positive_correlations", "DESC"), ("top_negative_correlations", "ASC")):

    @query(
        _name,
        "WITH" + FEATURES + ", pairs AS (" + _PAIRS_SQL + ") SELECT feature1, feature2, round(correlation, 6) AS correlation "
        f"FROM pairs ORDER BY pairs.correlation {_sql_order} NULLS LAST, feature1, feature2 LIMIT 10",
    )
    def _(spark, sf, negative=_sql_order == "ASC"):
        pairs = R.correlation_pairs(customer_features(spark, sf), _CORR_COLS)
        return rounded(R.strongest_pairs(pairs, 10, negative), ["correlation"])


_HIST = ["acctbal", "total_spend", "n_orders", "acctbal_gaps", "constant_col"]


@query(
    "histograms",
    "WITH" + FEATURES + ", long AS ("
    + union_all([f"SELECT '{c}' AS feature, {c}::DOUBLE AS value FROM features WHERE {c} IS NOT NULL" for c in _HIST])
    + """), ranges AS (SELECT feature, MIN(value) AS lo, MAX(value) AS hi FROM long GROUP BY feature),
    binned AS (SELECT l.feature, lo, hi, CASE WHEN hi = lo THEN 0 ELSE least(floor((value - lo) / ((hi - lo) / 10)), 9) END::INTEGER AS bin
      FROM long l JOIN ranges r ON l.feature = r.feature)
    SELECT feature, bin, round(lo + bin * ((hi - lo) / 10), 4) AS bin_low, round(lo + (bin + 1) * ((hi - lo) / 10), 4) AS bin_high,
    COUNT(*) AS count FROM binned GROUP BY feature, bin, lo, hi""",
)
def _(spark, sf):
    return rounded(P.histogram(customer_features(spark, sf), _HIST, 10), ["bin_low", "bin_high"], 4)


def _box_sql(keys: str, source: str) -> str:
    k = f"{keys}, " if keys else ""
    on = " AND ".join(f"l.{c} = q.{c}" for c in [*keys.split(", ")] if c) + (" AND " if keys else "")
    pre = "".join(f"l.{c}, " for c in keys.split(", ") if c)
    return f""", long AS ({source}), q AS (SELECT {k}feature, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
      quantile_cont(value, 0.75) AS q3 FROM long GROUP BY {k}feature)
    SELECT {pre}l.feature, round(q1, 4) AS q1, round(median, 4) AS median, round(q3, 4) AS q3,
      round(MIN(value) FILTER (value BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)), 4) AS whisker_low,
      round(MAX(value) FILTER (value BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)), 4) AS whisker_high,
      COUNT(*) FILTER (NOT value BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1)) AS n_outliers
    FROM long l JOIN q ON {on} l.feature = q.feature GROUP BY {pre}l.feature, q1, median, q3"""


_BOX = ["q1", "median", "q3", "whisker_low", "whisker_high"]
_BOX_COLS = ["acctbal", "total_spend", "n_orders", "acctbal_gaps"]


@query(
    "box_statistics",
    "WITH" + FEATURES
    + _box_sql("", union_all([f"SELECT '{c}' AS feature, {c}::DOUBLE AS value FROM features WHERE {c} IS NOT NULL" for c in _BOX_COLS])),
)
def _(spark, sf):
    return rounded(Q.box_statistics(customer_features(spark, sf), _BOX_COLS), _BOX, 4)


@query(
    "box_statistics_by_group",
    "WITH" + FEATURES
    + _box_sql(
        "segment",
        union_all([f"SELECT segment, '{c}' AS feature, {c}::DOUBLE AS value FROM features WHERE {c} IS NOT NULL" for c in _BOX_COLS]),
    ),
)
def _(spark, sf):
    return rounded(Q.box_statistics(customer_features(spark, sf), _BOX_COLS, ["segment"]), _BOX, 4)


@query(
    "feature_variance",
    "WITH" + FEATURES
    + union_all([f"SELECT '{c}' AS feature, round(var_samp({c}), 4) AS variance FROM features" for c in ["acctbal", "n_orders", "n_urgent"]]),
)
def _(spark, sf):
    long = wide_to_long(customer_features(spark, sf), ["acctbal", "n_orders", "n_urgent"])
    return long.groupBy("feature").agg(r(F.var_samp("value"), 4).alias("variance"))


@query(
    "profile_numeric_summary_orders",
    "SELECT 'o_totalprice' AS feature, COUNT(o_totalprice) AS count, round(AVG(o_totalprice), 3) AS mean, "
    "round(STDDEV_SAMP(o_totalprice), 3) AS std, round(quantile_cont(o_totalprice, 0.5), 3) AS p50 FROM orders",
)
def _(spark, sf):
    tables = P.profile(table(spark, sf, "orders"), numeric=["o_totalprice"], categorical=["o_orderstatus"])
    return rounded(tables["numerical_summary"].select("feature", "count", "mean", "std", "p50"), ["mean", "std", "p50"], 3)
