"""Preparation queries: columns, encoding, scaling, sampling."""

from pyspark.sql import functions as F

from registry.base import (
    AS_OF, FEATURES, NUMBERS, customer_features, hash_sql, query, r, rounded, table, union_all,
)
from veinworks.functions import numeric as N
from veinworks.operators import columns as C
from veinworks.operators import encoding as E
from veinworks.operators import sampling as S
from veinworks.operators import scaling as Z
from veinworks.operators.correlation import drop_redundant_columns
from veinworks.operators.profile import distinct_counts
from veinworks.operators.quantiles import medians
from veinworks.operators.scoring import class_counts
from veinworks.plans.preprocess import Preprocess

W = "WITH" + FEATURES


@query("separate_target", W + "SELECT row_id, segment FROM features")
def _(spark, sf):
    f = customer_features(spark, sf)
    features, target = C.split_target(f, "segment")
    return C.attach_labels(features.select("row_id"), target)


@query("select_features", W + "SELECT row_id, round(acctbal, 6) AS acctbal, n_orders FROM features")
def _(spark, sf):
    return rounded(C.keep_columns(customer_features(spark, sf), ["row_id", "acctbal", "n_orders"]), ["acctbal"])


@query(
    "columns_by_type",
    W + """SELECT 'number' AS kind, 'row_id,nation_key,acctbal,n_orders,total_spend,avg_order,max_order,n_urgent,mostly_missing,acctbal_gaps,constant_col' AS columns, COUNT(*) AS n_rows FROM features
    UNION ALL SELECT 'string', 'segment,segment_gaps,high_card', COUNT(*) FROM features
    UNION ALL SELECT 'date', 'first_order_date,last_order_date', COUNT(*) FROM features""",
)
def _(spark, sf):
    f = customer_features(spark, sf)
    found = {
        "number": C.columns_by_type(f, "number"),
        "string": C.columns_by_type(f, "string"),
        "date": C.columns_by_name(f, contains="date"),
    }
    kinds = F.array(
        *[F.struct(F.lit(k).alias("kind"), F.lit(",".join(v)).alias("columns")) for k, v in found.items()]
    )
    return f.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(kinds))


@query("columns_by_group", "SELECT l_quantity, l_tax, l_returnflag, l_linestatus FROM lineitem")
def _(spark, sf):
    li = table(spark, sf, "lineitem")
    groups = [["l_quantity", "l_absent", "l_tax"], C.columns_by_name(li, prefixes=["l_return", "l_linestatus"])]
    return C.keep_columns(li, C.available_members(li, groups))


@query(
    "drop_sparse_columns",
    W + "SELECT COUNT(*) AS n_rows, 15::INTEGER AS n_columns, false AS has_sparse, "
    "round(SUM(acctbal_gaps), 2) AS gaps_sum FROM features",
)
def _(spark, sf):
    kept = C.drop_sparse_columns(customer_features(spark, sf), 0.9)
    return kept.agg(F.count(F.lit(1)).alias("n_rows"), r(F.sum("acctbal_gaps"), 2).alias("gaps_sum")).select(
        "n_rows",
        F.lit(len(kept.columns)).alias("n_columns"),
        F.lit("mostly_missing" in kept.columns).alias("has_sparse"),
        "gaps_sum",
    )


@query("drop_wide_categories", W + "SELECT segment, segment_gaps, COUNT(*) AS n FROM features GROUP BY ALL")
def _(spark, sf):
    f = customer_features(spark, sf).select("segment", "segment_gaps", "high_card")
    kept = C.drop_wide_categories(f, 50)
    return kept.groupBy(*kept.columns).agg(F.count(F.lit(1)).alias("n"))


@query(
    "drop_redundant_columns",
    W + "SELECT row_id, round(acctbal, 4) AS acctbal, n_orders, round(max_order, 4) AS max_order, n_urgent FROM features",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", "acctbal", "n_orders", "total_spend", "max_order", "n_urgent")
    return rounded(
        drop_redundant_columns(f, ["acctbal", "n_orders", "total_spend", "max_order", "n_urgent"], 0.8),
        ["acctbal", "max_order"], 4,
    )


@query(
    "drop_incomplete_rows",
    W + "SELECT row_id, round(acctbal_gaps, 4) AS acctbal_gaps FROM features WHERE acctbal_gaps IS NOT NULL AND avg_order IS NOT NULL",
)
def _(spark, sf):
    f = C.drop_incomplete_rows(customer_features(spark, sf), ["acctbal_gaps", "avg_order"])
    return rounded(f.select("row_id", "acctbal_gaps"), ["acctbal_gaps"], 4)


@query(
    "clean_names",
    'SELECT l_orderkey AS "key_replace_bracket_open_0_replace_bracket_close_", l_quantity AS "q_smaller_than_51_days" FROM lineitem',
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("key[0]"), F.col("l_quantity").alias("q<51"))
    return C.clean_names(C.add_suffix(li, "q<51", "_days"))


@query(
    "label_codes",
    """SELECT o_orderpriority AS label, (row_number() OVER (ORDER BY MIN(o_orderkey)) - 1)::INTEGER AS code
    FROM orders GROUP BY o_orderpriority""",
)
def _(spark, sf):
    return E.label_codes(table(spark, sf, "orders"), "o_orderpriority", "o_orderkey")


@query(
    "encode_label",
    W + """, codes AS (SELECT segment_gaps AS label, (row_number() OVER (ORDER BY MIN(row_id)) - 1) AS code FROM features
      WHERE segment_gaps IS NOT NULL GROUP BY segment_gaps)
    SELECT row_id, COALESCE(code, -1)::INTEGER AS segment_gaps FROM features LEFT JOIN codes ON segment_gaps = label""",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", "segment_gaps")
    return E.encode_label(f, "segment_gaps")


@query("distinct_labels", "SELECT DISTINCT event_type FROM events")
def _(spark, sf):
    return table(spark, sf, "events").select("event_type").distinct()


@query(
    "union_of_results",
    """SELECT 'a' AS part, o_orderstatus AS status, COUNT(*) AS n, NULL::DOUBLE AS total FROM orders GROUP BY o_orderstatus
    UNION ALL SELECT 'b', o_orderstatus, NULL, round(SUM(o_totalprice), 2) FROM orders GROUP BY o_orderstatus""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status"))
    a = o.agg(F.count(F.lit(1)).alias("n")).withColumn("part", F.lit("a"))
    b = o.agg(r(F.sum("o_totalprice"), 2).alias("total")).withColumn("part", F.lit("b"))
    return a.unionByName(b, allowMissingColumns=True)


@query(
    "days_since",
    W + f"""SELECT row_id, floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_order_date)) / 86400000000.0)::BIGINT AS last_order_date_days FROM features""",
)
def _(spark, sf):
    f = customer_features(spark, sf)
    return f.select("row_id", N.elapsed_days(F.col("last_order_date"), AS_OF).alias("last_order_date_days"))


@query(
    "parse_date",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE date_trunc('day', o_orderdate)::TIMESTAMP END AS parsed FROM orders""",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    text = F.when(F.col("o_orderkey") % 7 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return o.select("o_orderkey", N.parse_date(text).cast("timestamp_ntz").alias("parsed"))


@query("unparsed_dates", "SELECT COUNT(*) FILTER (o_orderkey % 7 = 0 AND o_orderkey % 5 <> 0) AS n_bad, COUNT(*) AS n_rows FROM orders")
def _(spark, sf):
    key = F.col("o_orderkey")
    text = F.when(key % 5 == 0, F.lit(None)).when(key % 7 == 0, F.lit("not a date")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return table(spark, sf, "orders").agg(F.count_if(N.unparsed(text)).alias("n_bad"), F.count(F.lit(1)).alias("n_rows"))


_FILL = ["acctbal_gaps", "mostly_missing"]


@query(
    "fill_median",
    W + ", m AS (SELECT median(acctbal_gaps) AS a, median(mostly_missing) AS b FROM features) "
    "SELECT row_id, round(COALESCE(acctbal_gaps, a), 4) AS acctbal_gaps, round(COALESCE(mostly_missing, b), 4) AS mostly_missing FROM features, m",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", *_FILL)
    return rounded(C.fill_missing(f, medians(f, _FILL)), _FILL, 4)


@query(
    "winsorise",
    W + ", b AS (SELECT quantile_cont(acctbal_gaps, 0.05) AS lo, quantile_cont(acctbal_gaps, 0.95) AS hi, "
    "quantile_cont(total_spend, 0.05) AS tlo, quantile_cont(total_spend, 0.95) AS thi FROM features) "
    "SELECT row_id, round(CASE WHEN acctbal_gaps IS NULL THEN NULL ELSE least(greatest(acctbal_gaps, lo), hi) END, 4) AS acctbal_gaps, "
    "round(least(greatest(total_spend, tlo), thi), 4) AS total_spend FROM features, b",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", "acctbal_gaps", "total_spend")
    return rounded(Z.winsorise(f, ["acctbal_gaps", "total_spend"]), ["acctbal_gaps", "total_spend"], 4)


@query(
    "standardise",
    W + ", s AS (SELECT AVG(acctbal) AS m1, stddev_pop(acctbal) AS s1, AVG(n_orders) AS m2, stddev_pop(n_orders) AS s2 FROM features) "
    "SELECT row_id, round((acctbal - m1) / s1, 5) + 0.0::DOUBLE AS acctbal, round((n_orders - m2) / s2, 5) + 0.0::DOUBLE AS n_orders, "
    "0.0::DOUBLE AS constant_col FROM features, s",
)
def _(spark, sf):
    cols = ["acctbal", "n_orders", "constant_col"]
    return rounded(Z.standardise(customer_features(spark, sf).select("row_id", *cols), cols), cols, 5)


@query(
    "standardise_if_wide",
    "WITH s AS (SELECT AVG(l_quantity) AS m, stddev_pop(l_quantity) AS s FROM lineitem) "
    "SELECT l_orderkey, l_linenumber, round((l_quantity - m) / s, 5) + 0.0::DOUBLE AS scaled, l_discount AS unscaled FROM lineitem, s",
)
def _(spark, sf):
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", "l_discount")
    wide = Z.standardise_if_wide(li, ["l_quantity"])
    both = Z.standardise_if_wide(wide, ["l_discount"])
    return both.select("l_orderkey", "l_linenumber", r("l_quantity", 5).alias("scaled"), F.col("l_discount").alias("unscaled"))


@query(
    "min_max_scale",
    W + ", b AS (SELECT MIN(acctbal) AS lo, MAX(acctbal) AS hi FROM features) "
    "SELECT row_id, round((acctbal - lo) / (hi - lo), 6) AS acctbal, NULL::DOUBLE AS constant_col FROM features, b",
)
def _(spark, sf):
    cols = ["acctbal", "constant_col"]
    return rounded(Z.rescale(customer_features(spark, sf).select("row_id", *cols), cols), cols)


@query(
    "percentages_and_ratios",
    "SELECT o_orderstatus AS status, round(COUNT(*) * 100.0::DOUBLE / (SELECT COUNT(*) FROM orders), 6) AS share, "
    "round(abs(AVG(o_totalprice) - 100000), 2) AS distance FROM orders GROUP BY o_orderstatus",
)
def _(spark, sf):
    o = table(spark, sf, "orders")
    total = o.agg(F.count(F.lit(1)).alias("n"))
    per = o.groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.count(F.lit(1)).alias("c"), F.abs(F.avg("o_totalprice") - 100000).alias("d")
    )
    return per.join(F.broadcast(total)).select(
        "status", r(N.percentage(F.col("c"), F.col("n"))).alias("share"), r("d", 2).alias("distance")
    )


@query(
    "evenly_spaced",
    """WITH b AS (SELECT o_orderstatus AS status, MIN(o_totalprice) AS lo, MAX(o_totalprice) AS hi FROM orders GROUP BY 1)
    SELECT status, i::INTEGER AS step, round(lo + i * (hi - lo) / 9, 3) AS value FROM b, range(10) t(i)""",
)
def _(spark, sf):
    b = table(spark, sf, "orders").groupBy(F.col("o_orderstatus").alias("status")).agg(
        F.min("o_totalprice").alias("lo"), F.max("o_totalprice").alias("hi")
    )
    grid = N.linspace_col(F.col("lo"), F.col("hi"), 10)
    return b.select("status", F.posexplode(grid).alias("step", "value")).withColumn("value", r("value", 3))


_SEGMENTS = ["BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "one_hot_missing",
    W + "SELECT row_id, " + ", ".join(
        f"COALESCE((segment_gaps = '{s}')::INTEGER, 0)::DOUBLE AS \"segment_gaps_{s}\"" for s in _SEGMENTS
    ) + ", (segment_gaps IS NULL)::INTEGER::DOUBLE AS segment_gaps_nan FROM features",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", "segment_gaps", "high_card")
    return E.one_hot(f)


@query(
    "one_hot",
    W + "SELECT row_id, " + ", ".join(
        f"COALESCE((segment = '{s}')::INTEGER, 0)::DOUBLE AS \"segment_{s}\"" for s in _SEGMENTS
    ) + " FROM features",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", "segment")
    return E.one_hot(f, missing=False)


@query(
    "encode_by_name",
    W + """, codes AS (SELECT segment AS label, (row_number() OVER (ORDER BY MIN(row_id)) - 1) AS code FROM features GROUP BY segment)
    SELECT row_id, code::INTEGER AS segment FROM features JOIN codes ON segment = label""",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", "segment")
    return E.encode_categories(f, ["segment"], "label")


@query(
    "encode_target_mean",
    "WITH d AS (SELECT d.doc_id, lang, quality FROM documents d JOIN labels l ON d.doc_id = l.doc_id) "
    "SELECT doc_id, round(AVG(quality) OVER (PARTITION BY lang), 6) AS lang_target FROM d",
)
def _(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")
    out = E.encode_categories(d, ["lang"], "target", label="quality", row_id="doc_id")
    return out.select("doc_id", r("lang_target").alias("lang_target"))


@query(
    "sample_rows",
    f"SELECT l_orderkey, o FROM (SELECT o_orderkey AS l_orderkey, o_orderpriority AS o FROM orders ORDER BY {hash_sql('o_orderkey')}, o_orderkey LIMIT 500)",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("o"))
    return S.sample_rows(o, 500, "l_orderkey")


@query(
    "sample_per_class",
    f"""SELECT o_orderkey, o_orderstatus FROM (SELECT *, row_number() OVER (PARTITION BY o_orderstatus
    ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS rn FROM orders) WHERE rn <= 100""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.sample_per_class(o, "o_orderstatus", 100, "o_orderkey")


@query(
    "stratified_downsample",
    f"""WITH n AS (SELECT COUNT(*) AS n FROM orders), t AS (SELECT n, least(10000, n // 2) AS target FROM n),
    c AS (SELECT o_orderpriority AS p, COUNT(*) AS c FROM orders GROUP BY 1),
    s AS (SELECT p, CASE WHEN n <= 10000 THEN c ELSE floor(target * c / n::DOUBLE) END AS k FROM c, t)
    SELECT o_orderkey, o_orderpriority FROM (SELECT *, row_number() OVER (PARTITION BY o_orderpriority
    ORDER BY {hash_sql('o_orderkey')}, o_orderkey) AS rn FROM orders) JOIN s ON p = o_orderpriority WHERE rn <= k""",
)
def _(spark, sf):
    o = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return S.stratified_downsample(o, "o_orderpriority", "o_orderkey")


@query(
    "class_counts",
    "SELECT quality::BIGINT AS label, COUNT(*) AS count FROM labels GROUP BY quality",
)
def _(spark, sf):
    return class_counts(table(spark, sf, "labels").withColumn("quality", F.col("quality").cast("long")), "quality")


@query(
    "class_weights",
    "SELECT quality AS label, round((SELECT COUNT(*) FROM labels) / (2.0::DOUBLE * COUNT(*)), 6) AS weight FROM labels GROUP BY quality",
)
def _(spark, sf):
    return rounded(S.class_weights(table(spark, sf, "labels"), "quality"), ["weight"])


@query(
    "train_test_split",
    f"SELECT c_custkey, CASE WHEN {hash_sql('c_custkey')} < 429496729 THEN 'test' ELSE 'train' END AS part FROM customer",
)
def _(spark, sf):
    train, test = S.split_rows(table(spark, sf, "customer").select("c_custkey"), 0.2, "c_custkey")
    return train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))


_P_NUM = ["nation_key", "acctbal", "n_orders", "total_spend", "avg_order", "max_order", "n_urgent",
          "first_order_date_days", "last_order_date_days", "acctbal_gaps", "constant_col"]


def _preprocess_sql(threshold: float) -> str:
    """Staged CTEs: days, medians, bounds, then the filter and the scale."""
    days = W + f""", dated AS (SELECT row_id, segment, segment_gaps, nation_key::DOUBLE AS nation_key, acctbal, n_orders::DOUBLE AS n_orders,
      total_spend, avg_order, max_order, n_urgent::DOUBLE AS n_urgent,
      floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(first_order_date)) / 86400000000.0)::DOUBLE AS first_order_date_days,
      floor((epoch_us(TIMESTAMP '{AS_OF}') - epoch_us(last_order_date)) / 86400000000.0)::DOUBLE AS last_order_date_days,
      acctbal_gaps, constant_col FROM features)"""
    med = ", med AS (SELECT " + ", ".join(f"median({c}) AS {c}" for c in _P_NUM) + " FROM dated)"
    fill = ", filled AS (SELECT row_id, segment, segment_gaps, " + ", ".join(
        f"COALESCE(d.{c}, m.{c}) AS {c}" for c in _P_NUM) + " FROM dated d, med m)"
    bnd = ", bnd AS (SELECT " + ", ".join(
        f"quantile_cont({c}, 0.05) AS {c}_lo, quantile_cont({c}, 0.95) AS {c}_hi" for c in _P_NUM) + " FROM filled)"
    clip = ", clipped AS (SELECT row_id, segment, segment_gaps, " + ", ".join(
        f"least(greatest({c}, {c}_lo), {c}_hi) AS {c}" for c in _P_NUM) + " FROM filled, bnd)"
    st = ", st AS (SELECT " + ", ".join(
        f"AVG({c}) AS {c}_m, stddev_pop({c}) AS {c}_s" for c in _P_NUM) + " FROM clipped)"
    drops = ", cor AS (SELECT " + ", ".join(
        f"COALESCE(greatest({', '.join(['0::DOUBLE'] + [f'CASE WHEN {a}_s > 0 AND {b}_s > 0 THEN abs({a}_{b}) ELSE 0 END' for a in _P_NUM[:j]])}) > {threshold}, false) AS {b}_drop"
        for j, b in enumerate(_P_NUM)
    ) + " FROM (SELECT " + ", ".join(
        f"CASE WHEN stddev_pop({a}) > 0 AND stddev_pop({b}) > 0 THEN corr({a}, {b}) END AS {a}_{b}"
        for j, b in enumerate(_P_NUM) for a in _P_NUM[:j]
    ) + " FROM clipped), st)"
    indicator = ", ".join(
        [f"COALESCE((segment = '{s}')::INTEGER, 0)::DOUBLE AS \"segment_{s}\"" for s in _SEGMENTS]
        + ["(segment IS NULL)::INTEGER::DOUBLE AS segment_nan"]
        + [f"COALESCE((segment_gaps = '{s}')::INTEGER, 0)::DOUBLE AS \"segment_gaps_{s}\"" for s in _SEGMENTS]
        + ["(segment_gaps IS NULL)::INTEGER::DOUBLE AS segment_gaps_nan"]
    )
    scaled = ", ".join(
        f"CASE WHEN NOT {c}_drop THEN round(COALESCE(({c} - {c}_m) / nullif({c}_s, 0), 0), 4) + 0.0::DOUBLE END AS {c}"
        for c in _P_NUM
    )
    return days + med + fill + bnd + clip + st + drops + f" SELECT row_id, {indicator}, {scaled} FROM clipped, st, cor"


def _prepared(spark, sf, threshold):
    """A dropped column shows as NULL, so that the result has fixed columns."""
    f = customer_features(spark, sf)
    model = Preprocess(asOf=AS_OF, correlationThreshold=threshold).fit(f)
    out = model.transform(f)
    numbers = [r(c, 4).alias(c) if c in out.columns else F.lit(None).cast("double").alias(c) for c in _P_NUM]
    return out.select("row_id", *[c for c in out.columns if c.startswith("segment")], *numbers)


@query("preprocess", _preprocess_sql(0.9))
def _(spark, sf):
    return _prepared(spark, sf, 0.9)


@query("preprocess_strict_correlation", _preprocess_sql(0.5))
def _(spark, sf):
    return _prepared(spark, sf, 0.5)


@query(
    "preprocess_with_label",
    W + """, codes AS (SELECT segment AS label, (row_number() OVER (ORDER BY MIN(row_id)) - 1) AS code FROM features GROUP BY segment),
    s AS (SELECT AVG(acctbal) AS m, stddev_pop(acctbal) AS s FROM (SELECT least(greatest(acctbal, lo), hi) AS acctbal FROM features,
      (SELECT quantile_cont(acctbal, 0.05) AS lo, quantile_cont(acctbal, 0.95) AS hi FROM features)))
    SELECT row_id, code::INTEGER AS segment, round((least(greatest(acctbal, lo), hi) - m) / s, 4) + 0.0::DOUBLE AS acctbal
    FROM features JOIN codes ON segment = label, s, (SELECT quantile_cont(acctbal, 0.05) AS lo, quantile_cont(acctbal, 0.95) AS hi FROM features)""",
)
def _(spark, sf):
    f = customer_features(spark, sf).select("row_id", "segment", "acctbal", "high_card")
    return rounded(Preprocess(label="segment").fit(f).transform(f), ["acctbal"], 4).select("row_id", "segment", "acctbal")


@query(
    "segmentation_preparation",
    W + ", m AS (SELECT median(acctbal_gaps) AS a FROM features) SELECT row_id, round(COALESCE(acctbal_gaps, a), 4) AS \"Income\", "
    "n_orders::DOUBLE AS \"NumStorePurchases\", round(total_spend, 4) AS \"MntTotal\", "
    + ", ".join(f"COALESCE((segment_gaps = '{s}')::INTEGER, 0)::DOUBLE AS \"Education_{s}\"" for s in _SEGMENTS)
    + " FROM features, m",
)
def _(spark, sf):
    from veinworks.operators.clustering import segmentation_features

    f = customer_features(spark, sf).select(
        "row_id",
        F.col("acctbal_gaps").alias("Income"),
        F.col("n_orders").alias("NumStorePurchases"),
        F.col("total_spend").alias("MntTotal"),
        F.col("segment_gaps").alias("Education"),
        F.col("high_card").alias("Other"),
    )
    return rounded(segmentation_features(f), ["Income", "MntTotal"], 4)
