"""Preparation, quantiles, correlation and their edge cases."""

import math
import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from veinworks.functions import numeric as N
from veinworks.operators import columns as C
from veinworks.operators import correlation as R
from veinworks.operators import encoding as E
from veinworks.operators import profile as P
from veinworks.operators import quantiles as Q
from veinworks.operators import sampling as S
from veinworks.operators import scaling as Z
from veinworks.plans.preprocess import Preprocess, preprocess


def linear_quantile(values, p):
    values = sorted(values)
    rank = p * (len(values) - 1)
    low = int(rank)
    high = min(low + 1, len(values) - 1)
    return values[low] + (values[high] - values[low]) * (rank - low)


def test_quantiles_between_heavy_ties(spark):
    import numpy as np

    values = [1.0] * 4000 + [2.0] * 4000 + [1.0 + i / 3000 for i in range(1, 1500)] + [5.0, -3.0]
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(4)
    probs = [0.0, 0.3, 0.41, 0.4205, 0.46, 0.5, 0.5786, 0.9, 1.0]
    got = Q.exact_quantiles(df, ["x"], probs, small=20)[()]["x"]
    assert got == pytest.approx(list(np.quantile(values, probs)), abs=1e-12)


@pytest.mark.parametrize("small", [5, 50, 100_000])
def test_exact_quantiles_whatever_the_path(spark, small):
    draw = random.Random(1)
    values = [draw.choice([1.0, 1.0, 1.0, draw.random() * 10, -5.0]) for _ in range(3000)]
    df = spark.createDataFrame([(v,) for v in values] + [(None,)], "x double")
    got = Q.exact_quantiles(df, ["x"], [0.0, 0.05, 0.5, 0.8333, 0.95, 1.0], small=small)[()]["x"]
    want = [linear_quantile(values, p) for p in [0.0, 0.05, 0.5, 0.8333, 0.95, 1.0]]
    assert got == pytest.approx(want)


@pytest.mark.parametrize("small", [5, 100_000])
def test_exact_quantiles_per_group(spark, small):
    rows = [(g, float((i * 37) % 101)) for g in (0, 1) for i in range(200 + 300 * g)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = Q.exact_quantiles(df, ["x"], [0.25, 0.5], ["g"], small=small)
    for g in (0, 1):
        mine = [x for k, x in rows if k == g]
        assert got[(g,)]["x"] == pytest.approx([linear_quantile(mine, 0.25), linear_quantile(mine, 0.5)])


def test_quantiles_of_an_empty_column(spark):
    df = spark.createDataFrame([(None,), (None,)], "x double")
    assert Q.medians(df, ["x"]) == {"x": None}


def test_running_totals_match_a_plain_loop(spark):
    rows = [(g, float(i % 50) + i / 1000, i) for g in ("a", "b") for i in range(300)]
    df = spark.createDataFrame(rows, "g string, k double, w long").repartition(7)
    out = Q.running_totals(df, "k", {"total": F.col("w")}, by=["g"]).collect()
    for g in ("a", "b"):
        seen, want = 0, {}
        for _, k, w in sorted(r for r in rows if r[0] == g):
            seen += w
            want[k] = seen
        assert {r["k"]: r["total"] for r in out if r["g"] == g} == want


def test_nan_becomes_null_and_nulls_stay_null_when_clamped(spark):
    df = N.nan_to_null(spark.createDataFrame([(float("nan"),), (None,), (9.0,)], "x double"))
    assert df.where("x is null").count() == 2
    out = [r[0] for r in df.select(N.clamp(F.col("x"), 0.0, 5.0)).collect()]
    assert sorted(out, key=str) == [5.0, None, None]


def test_elapsed_days_are_floored(spark):
    df = spark.createDataFrame([("2020-01-01 12:00:00",), ("2020-01-03 00:00:01",)], "t string")
    out = [r[0] for r in df.select(N.elapsed_days(F.to_timestamp("t"), "2020-01-02 11:00:00")).collect()]
    assert out == [0, -1]


def test_bad_dates_become_null(spark):
    df = spark.createDataFrame([("2020-02-30",), ("2020-02-28",)], "t string")
    assert [r[0] is None for r in df.select(N.parse_date(F.col("t"))).collect()] == [True, False]


def test_linspace():
    assert N.linspace(0.1, 1.0, 4) == pytest.approx([0.1, 0.4, 0.7, 1.0])
    assert N.linspace(5, 20, 4, integer=True) == [5, 10, 15, 20]
    assert N.linspace(5, 20, 3, integer=True) == [5, 12, 20]


def test_correlation_with_gaps_constants_and_one_row(spark):
    rows = [(1.0, 2.0, None, 3.0), (2.0, 4.0, 1.0, 3.0), (3.0, 5.0, 4.0, 3.0), (None, 1.0, 2.0, 3.0)]
    df = spark.createDataFrame(rows, "a double, b double, c double, k double")
    found = R.correlations(df, ["a", "b", "c", "k"])
    xs, ys = [1.0, 2.0, 3.0], [2.0, 4.0, 5.0]
    assert found["a", "b"] == pytest.approx(statistics.correlation(xs, ys))
    assert found["a", "k"] is None and found["b", "k"] is None
    assert R.redundant_columns(df, ["a", "b", "c", "k"], 0.5)[0] == "b"
    assert all(v is None for v in R.correlations(df.limit(1), ["a", "b"]).values())


def test_pairwise_correlations_of_many_columns_in_one_scan(spark):
    width, rows = 1000, 40
    draw = np.random.default_rng(4)
    x = draw.normal(1e6, 1.0, size=(rows, width))
    x[:, 7] = 5.0
    x[draw.random((rows, width)) < 0.2] = np.nan
    data = [(k, [None if np.isnan(v) else float(v) for v in r]) for k, r in enumerate(x)]
    wide = spark.createDataFrame(data, "k int, v array<double>").repartition(3)
    cols = [f"c{i}" for i in range(width)]
    wide = wide.select(*[F.get("v", F.lit(i)).alias(c) for i, c in enumerate(cols)])
    found = R.correlation_rows(wide, cols)
    assert found.count() == width * (width + 1) // 2
    for r in found.where("i % 250 = 7 and j % 90 = 12 or i = 7 and j < 9 or i = 11 and j = 11").collect():
        both = ~np.isnan(x[:, r["i"]]) & ~np.isnan(x[:, r["j"]])
        a, b = x[both, r["i"]], x[both, r["j"]]
        assert r["n"] == both.sum()
        assert r["correlation"] is None if 7 in (r["i"], r["j"]) else r["correlation"] == pytest.approx(np.corrcoef(a, b)[0, 1], abs=1e-9)


def test_merged_parts_equal_parts_of_all_rows():
    draw = np.random.default_rng(5)
    x = draw.normal(50, 3, size=(60, 4))
    x[draw.random(x.shape) < 0.3] = np.nan
    x[:20, 1] = np.nan
    total = np.zeros((len(R.PARTS), 4, 4))
    for part in np.split(x, [0, 20, 21, 45]):
        total = R.merged(total, R.pair_sums(part))
    assert np.allclose(total, R.pair_sums(x))


def test_a_dropped_column_still_counts_against_later_ones(spark):
    rows = [(float(i), i + 0.1 * (i % 2), i + 0.2 * (i % 3)) for i in range(50)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    assert R.redundant_columns(df, ["a", "b", "c"], 0.9) == ["b", "c"]


def test_threshold_for_missing_columns_is_strict(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, 5), (4, 6)], "a int, b int")
    assert C.drop_sparse_columns(df, 0.5).columns == ["a"]
    assert C.drop_sparse_columns(df, 0.51).columns == ["a", "b"]


def test_one_hot_names_and_missing(spark):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "row_id int, x string")
    out = E.one_hot(df)
    assert out.columns == ["row_id", "x_b", "x_c", "x_nan"]
    assert [tuple(r)[1:] for r in out.orderBy("row_id").collect()] == [(1, 0, 0), (0, 0, 0), (0, 0, 1), (0, 1, 0)]
    assert E.one_hot(df, missing=False).columns == ["row_id", "x_b", "x_c"]
    assert E.one_hot(df, most=2).columns == ["row_id"]


def test_labels_are_numbered_by_first_row(spark):
    df = spark.createDataFrame([(5, "x"), (1, "z"), (3, "y"), (4, "z"), (2, None)], "row_id long, y string")
    assert E.label_dictionary(df, "y") == {"z": 0, "y": 1, "x": 2}
    out = {r["row_id"]: r["y"] for r in E.encode_label(df, "y").collect()}
    assert out == {1: 0, 2: -1, 3: 1, 4: 0, 5: 2}


def test_preprocess_edge_columns(spark):
    rows = [
        (i, float(i), 3.0, None, "a" if i % 2 else "b", None if i % 4 == 0 else float(i % 5), f"2020-01-{i + 1:02d}", i % 2 == 0, i % 2)
        for i in range(20)
    ]
    schema = "row_id long, `n[0]` double, k double, void double, c string, gap double, start_Date string, flag boolean, y int"
    df = spark.createDataFrame(rows, schema)
    out = preprocess(df, "y", "2020-03-01 00:00:00", correlationThreshold=0.99)
    assert "void" not in out.columns
    assert "n_replace_bracket_open_0_replace_bracket_close_" in out.columns
    assert "start_Date_days" not in out.columns  # runs exactly against n[0]
    assert {"c_b", "c_nan", "flag", "y", "gap", "k"} <= set(out.columns)
    assert out.where("k <> 0 or gap is null").count() == 0
    stats = out.agg(F.avg("gap"), F.stddev_pop("gap")).first()
    assert stats[0] == pytest.approx(0, abs=1e-9) and stats[1] == pytest.approx(1)


def test_preprocess_needs_a_moment_for_dates(spark):
    df = spark.createDataFrame([(1, "2020-01-01")], "row_id long, date string")
    with pytest.raises(ValueError):
        Preprocess().fit(df)


def test_preprocess_does_not_depend_on_partitions(spark):
    rows = [(i, float(i * i % 17), "ab"[i % 2]) for i in range(200)]
    df = spark.createDataFrame(rows, "row_id long, x double, c string")
    one = preprocess(df.repartition(1)).orderBy("row_id").collect()
    many = preprocess(df.repartition(9)).orderBy("row_id").collect()
    for a, b in zip(one, many):
        assert tuple(a) == pytest.approx(tuple(b))


def test_preprocess_on_rows_it_has_not_seen(spark):
    df = spark.createDataFrame([(i, float(i), "ab"[i % 2]) for i in range(10)], "row_id long, x double, c string")
    model = Preprocess().fit(df)
    new = spark.createDataFrame([(99, 1e9, "zzz"), (98, None, None)], "row_id long, x double, c string")
    out = {r["row_id"]: r for r in model.transform(new).collect()}
    assert out[99]["c_b"] == 0 and out[98]["c_nan"] == 1 and out[98]["x"] == pytest.approx(0)


def test_standardise_constants_and_scale_rule(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, k double")
    assert [tuple(r) for r in Z.standardise(df, ["x", "k"]).collect()] == [(-1.0, 0.0), (1.0, 0.0)]
    assert Z.standardise_if_wide(df, ["x", "k"]).collect() == df.collect()
    assert [r[0] for r in Z.rescale(df, ["k"], constant=0.0).select("k").collect()] == [0.0, 0.0]


def test_profile_of_an_empty_table(spark):
    df = spark.createDataFrame([], "row_id long, x double, y double, c string")
    row = P.describe_numeric(df, ["x"]).first()
    assert row["count"] == 0 and row["mean"] is None and row["missing_pct"] is None
    assert P.missing_values(df).count() == 0


def test_histogram_puts_the_maximum_into_the_last_bin(spark):
    df = spark.createDataFrame([(float(i),) for i in range(11)], "x double")
    out = {r["bin"]: r["count"] for r in P.histogram(df, ["x"], 5).collect()}
    assert out == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_names_are_cleaned():
    assert C.clean_name("a[1]<2") == "a_replace_bracket_open_1_replace_bracket_close__smaller_than_2"


def test_missing_target_is_reported(spark):
    with pytest.raises(ValueError):
        C.require_column(spark.range(1), "nope")


def test_column_groups(spark):
    df = spark.createDataFrame([(1, 2.0, 3, 4, 5, 6)], "row_id int, MntWines double, Income int, AcceptedCmp1 int, Response int, other int")
    assert C.segmentation_columns(df) == ["Income", "MntWines", "AcceptedCmp1", "Response"]


def test_samples_are_exact_and_spread(spark):
    df = spark.range(1000).withColumnRenamed("id", "row_id").withColumn("c", F.col("row_id") % 3)
    assert S.sample_rows(df, 100).count() == 100
    mean = S.sample_rows(df, 200).agg(F.avg("row_id")).first()[0]
    assert 400 < mean < 600
    assert {r["c"]: r["count"] for r in S.sample_per_class(df, "c", 7).groupBy("c").count().collect()} == {0: 7, 1: 7, 2: 7}
    train, test = S.split_rows(df, 0.3)
    assert train.count() + test.count() == 1000 and 250 < test.count() < 350
    folds = [r["count"] for r in df.groupBy(S.fold_column()).count().collect()]
    assert len(folds) == 5 and min(folds) > 150


def test_oversampling_levels_the_classes(spark):
    rows = [(i, 0 if i < 80 else 1, float(i % 11), float(i % 7)) for i in range(100)]
    df = spark.createDataFrame(rows, "row_id long, y int, a double, b double")
    out = S.oversample(df, "y", ["a", "b"])
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 80, 1: 80}
    made = out.where("synthetic").agg(F.min("a"), F.max("a")).first()
    minority = [r for r in rows if r[1] == 1]
    assert min(r[2] for r in minority) <= made[0] and made[1] <= max(r[2] for r in minority)
    single = df.where("y = 0")
    assert S.oversample(single, "y", ["a"]).count() == 80


def test_class_weights(spark):
    df = spark.createDataFrame([(0,)] * 3 + [(1,)], "y int")
    assert {r["label"]: r["weight"] for r in S.class_weights(df, "y").collect()} == {0: pytest.approx(4 / 6), 1: 2.0}


def test_value_counts_leave_out_null_but_count_it(spark):
    df = spark.createDataFrame([("a",), ("a",), (None,), ("b",)], "c string")
    out = {r["value"]: (r["count"], r["percentage"]) for r in P.value_counts(df, "c").collect()}
    assert out == {"a": (2, 50.0), "b": (1, 25.0)}
    assert math.isclose(sum(p for _, p in out.values()), 75.0)
