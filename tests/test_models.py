"""Scores, selection, classifiers, runs, sources and sinks."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from veinworks.operators import classification as M
from veinworks.operators import components as PC
from veinworks.operators import scoring as SC
from veinworks.operators import selection as SEL
from veinworks.plans import runs
from veinworks.plans.preprocess import Preprocess
from veinworks.plans.settings import Settings, apply_in_batches
from veinworks.plans.steps import SelectFeatures
from veinworks.sources import tables as ST


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(240):
        y = int(i % 4 == 0)
        rows.append((i, y, float(draw.normal(2.5 * y, 1)), float(draw.normal(-1.5 * y, 1)), float(draw.normal()), float(draw.normal())))
    return spark.createDataFrame(rows, "row_id long, y int, a double, b double, n1 double, n2 double").cache()


COLS = ["a", "b", "n1", "n2"]


def test_metrics_on_edge_cases(spark):
    none = spark.createDataFrame([(1, 0, 0.1), (0, 0, 0.1)], "label int, prediction int, score double")
    assert tuple(SC.threshold_metrics(none).first()) == (0.5, 0.0, 0.0, 0.0)
    assert SC.roc_auc(none).first()[0] == 0.5  # one tied score
    single = spark.createDataFrame([(1, 1, 0.9), (1, 0, 0.2)], "label int, prediction int, score double")
    assert SC.roc_auc(single).first()[0] is None
    assert "roc" not in SC.classification_report(single)
    full = {(r["label"], r["prediction"]): r["count"] for r in SC.confusion_matrix(single).collect()}
    assert full == {(0, 0): 0, (0, 1): 0, (1, 0): 1, (1, 1): 1}


def test_metric_names():
    assert SC.metric_name("roc auc") == "ROC AUC" and SC.metric_name("F1 SCORE") == "F1 Score"
    with pytest.raises(ValueError, match="Accuracy"):
        SC.metric_name("kappa")


def test_auc_equals_pair_counting(spark):
    rows = [(i % 2, float((i * 7) % 5)) for i in range(41)]
    pos, neg = [s for y, s in rows if y], [s for y, s in rows if not y]
    want = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    df = spark.createDataFrame(rows, "label int, score double")
    assert SC.roc_auc(df).first()[0] == pytest.approx(want)
    assert SC.trapezoid_area(SC.roc_curve(df), "fpr", "tpr").first()[0] == pytest.approx(want)


def test_components_of_two_columns(spark):
    draw = np.random.default_rng(5)
    x = draw.normal(size=200)
    y = 0.8 * x + draw.normal(size=200) * 0.5
    df = spark.createDataFrame([(float(a), float(b), 1.0) for a, b in zip(x, y)], "x double, y double, k double")
    loadings, share = PC.fit_components(df, ["x", "y", "k"], 3)
    r = np.corrcoef(x, y)[0, 1]
    assert share[:2] == pytest.approx([(1 + r) / 2, (1 - r) / 2])
    assert loadings[0] == pytest.approx([2**-0.5, 2**-0.5, 0.0])


def test_auto_feature_count():
    assert PC.auto_feature_count([0.5, 0.2, 0.15, 0.1], 40) == 5
    assert PC.auto_feature_count([0.1] * 10, 40) == 9 or PC.auto_feature_count([0.1] * 10, 40) == 8
    assert PC.auto_feature_count([0.05] * 10, 40) == 5  # none passes the share
    assert PC.auto_feature_count([0.09] * 10, 14) == 7


def test_unsupervised_ranking(spark, data):
    with_constant = data.withColumn("k", F.lit(7.0))
    ranking, _ = SEL.rank_unsupervised(with_constant, [*COLS, "k"])
    rows = {r["feature"]: r for r in ranking.collect()}
    assert rows["k"]["score"] == 0.0 and rows["k"]["variance"] == 0.0 and rows["a"]["variance"] == 1.0
    assert "k" not in SEL.select_unsupervised(with_constant, [*COLS, "k"], 3)
    assert -1 <= SEL.selection_quality(data, ["a", "b"]) <= 1


def test_elimination_keeps_what_matters(spark, data):
    found = SEL.select_features(data, "y", n_features=2, max_depth=4)
    assert "a" in found["features"] and len(found["features"]) <= 2
    assert [r["n_features"] for r in found["curve"].orderBy("n_features").collect()] == [1, 2, 3, 4]
    line = data.withColumn("t", F.col("a") * 3 - F.col("n1"))
    reg = SEL.select_features(line, "t", "regression", cols=COLS)
    assert {"a", "n1"} <= set(reg["features"])
    with pytest.raises(ValueError):
        SEL.select_features(data, None, "classification")
    with pytest.raises(ValueError):
        SEL.select_features(data, "y", "ranking")


def test_linear_elimination_equals_fits_of_their_own(spark):
    draw = np.random.default_rng(8)
    x = draw.normal(1000, 1, size=(90, 5))
    x[:, 3] *= 7
    x[:, 4] = x[:, 0] + draw.normal(0, 0.1, 90)
    y = 3 * x[:, 0] - 2 * x[:, 1] + 0.01 * x[:, 2] + draw.normal(0, 0.2, 90)
    cols = [f"x{i}" for i in range(5)]
    rows = [(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))] + [(900, *[None] * 5, 1.0)]
    df = spark.createDataFrame(rows, "row_id long, " + ", ".join(f"{c} double" for c in (*cols, "t"))).repartition(3)
    folds = {r["row_id"]: r["f"] for r in df.select("row_id", SEL.fold_column("row_id", 4, 1).alias("f")).collect()}
    fold, want = np.array([folds[i] for i in range(90)]), {n: [] for n in range(1, 6)}

    def fitted(rows, kept):
        return np.linalg.lstsq(np.column_stack([np.ones(rows.sum()), x[rows][:, kept]]), y[rows], rcond=None)[0]

    for f in range(4):
        kept = list(range(5))
        while kept:
            b = fitted(fold != f, kept)
            off = y[fold == f] - b[0] - x[fold == f][:, kept] @ b[1:]
            want[len(kept)].append(1 - (off**2).sum() / ((y[fold == f] - y[fold == f].mean()) ** 2).sum())
            kept.pop(int(np.abs(b[1:]).argmin()))
    curve, eliminated = SEL.eliminate_linear(df, cols, "t", folds=4, seed=1)
    assert [n for n, _ in curve] == [1, 2, 3, 4, 5]
    assert [s for _, s in curve] == pytest.approx([np.mean(want[n]) for n in range(1, 6)], abs=1e-6)
    kept, weights = eliminated(5)
    assert kept == [0, 1, 2, 3, 4] and weights == pytest.approx(np.abs(fitted(fold >= 0, kept)[1:]), rel=1e-4, abs=1e-5)


@pytest.mark.parametrize("name", list(M.DEFAULTS))
def test_every_classifier_beats_chance(spark, data, name):
    train, test = data.where("row_id % 5 <> 1"), data.where("row_id % 5 = 1")
    params = {**M.DEFAULTS[name], **({"n_estimators": 10, "max_depth": 3} if "n_estimators" in M.DEFAULTS[name] else {})}
    fitted = M.FITTERS[name](train, COLS, "y", "row_id", **params)
    scored = M.labelled(fitted.score(test), test, "y", "row_id")
    assert scored.count() == test.count()
    assert SC.roc_auc(scored).first()[0] > 0.75


def test_compare_and_search(spark, data):
    train, test = data.where("row_id % 5 <> 1"), data.where("row_id % 5 = 1")
    grids = {"Logistic Regression": {"C": [0.01, 1], "max_iter": [50]}, "KNN": {"n_neighbors": [1, 7]}}
    found = M.compare_models(train, test, COLS, "y", models=list(grids), search="grid", metric="accuracy", grids=grids, balance=False)
    assert found["leaderboard"].count() == 2 and found["searches"].count() == 4
    board = {r["Model"]: r["Accuracy"] for r in found["leaderboard"].collect()}
    assert board[found["best"].name] == max(board.values())
    importances = M.feature_importances(M.fit_logistic(train, COLS, "y", "row_id"))
    assert importances.first()["feature"] == "a"
    assert M.feature_importances(M.fit_neighbors(train, COLS, "y", "row_id")) is None
    assert len(M.drawn_combinations(M.GRIDS["KNN"])) == 10
    assert M.drawn_combinations(M.GRIDS["KNN"]) == M.drawn_combinations(M.GRIDS["KNN"])
    with pytest.raises(ValueError):
        M.compare_models(train, test, COLS, "y", search="annealing")


def test_settings_are_checked():
    for bad in (
        dict(task="ranking"), dict(task="classification"), dict(task="clustering", metric="kappa"),
        dict(task="clustering", k_range=(5, 2)), dict(task="clustering", test_fraction=0.0),
        dict(task="clustering", methods=("spectral",)), dict(task="clustering", missing_threshold=0.0),
    ):
        with pytest.raises(ValueError):
            Settings(**bad)


def test_runs_end_to_end(spark, data, tmp_path):
    out = str(tmp_path / "runs")
    s = Settings("classification", label="y", models=("Logistic Regression",), n_features=3, output=out, balance=False, options={"max_depth": 3, "folds": 2})
    found = runs.run(data, s)
    assert found["tables"]["leaderboard"].first()["ROC AUC"] > 0.7
    assert ST.read_delimited(spark, f"{out}/{s.run_id}/leaderboard").count() == 1
    assert M.load_fitted(spark, f"{out}/{s.run_id}/model").name == "Logistic Regression"
    c = Settings("clustering", n_features=2, k_range=(2, 3), starts=1, methods=("kmeans",), output=out, run_id="c1")
    grouped = runs.run(data.drop("y"), c)
    assert grouped["labelled"].count() == 240 and grouped["n_clusters"] in (2, 3)
    assert spark.read.parquet(f"{out}/labelled").where("run_id = 'c1'").count() == 240
    summary = {(r["section"], r["key"]): r["value"] for r in grouped["tables"]["summary"].collect()}
    assert summary["clusters", "best_method"] == "KMeans" and summary["data", "rows"] == "240"


def test_steps_chain_and_reload(spark, data, tmp_path):
    model = Pipeline(stages=[Preprocess(label="y"), SelectFeatures(label="y", nFeatures=2)]).fit(data)
    path = ST.save_model(model, str(tmp_path / "model"))
    again = ST.load_model(path, PipelineModel)
    a = model.transform(data).orderBy("row_id").collect()
    assert a == again.transform(data).orderBy("row_id").collect()
    assert set(model.transform(data).columns) >= {"row_id", "y"} and len(a[0]) == 4


def test_sources_and_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a,b", 1.5, ["x"]), (2, 'q"t', None, [])], "i int, s string, d double, l array<string>")
    for sep in (",", "\t"):
        back = ST.read_delimited(spark, ST.write_table(df, str(tmp_path / f"t{ord(sep)}"), sep=sep), sep)
        assert [tuple(r) for r in back.orderBy("i").collect()] == [(1, "a,b", 1.5, '["x"]'), (2, 'q"t', None, "[]")]
    again = spark.read.json(ST.write_json(df, str(tmp_path / "j")))
    assert again.where("i = 1").first()["l"] == ["x"]
    for run_id, n in (("a", 3), ("b", 1), ("a", 2)):
        ST.write_run(spark.range(n), str(tmp_path / "runs"), run_id)
    counts = spark.read.parquet(str(tmp_path / "runs")).groupBy("run_id").count()
    assert {r["run_id"]: r["count"] for r in counts.collect()} == {"a": 2, "b": 1}
    (tmp_path / "html").mkdir()
    (tmp_path / "html" / "p.html").write_text("<title>x</title>\n<p>y</p>")
    assert ST.read_pages(spark, str(tmp_path / "html")).first()["html"].count("\n") == 1
    with pytest.raises(ValueError):
        ST.write_table(df, "x", "xml")


def test_batches_cover_all_rows_and_respect_the_size(spark):
    df = spark.range(1005).repartition(3)
    out = apply_in_batches(df, lambda p: p.assign(n=len(p)), "id long, n long", 100)
    assert out.count() == 1005 and out.agg(F.max("n")).first()[0] <= 100


def test_a_forest_keeps_the_nodes_of_rows_and_grows_the_same_trees(spark):
    rows = [(i, float(i * 7 % 31), float(i * 5 % 17), int(i * i % 7 < 3)) for i in range(120)]
    df = spark.createDataFrame(rows, "row_id long, a double, b double, label int")
    fitted = M.fit_forest(df, ["a", "b"], "label", "row_id", n_estimators=4, max_depth=12)
    plain = M.RandomForestClassifier(labelCol="label", numTrees=4, maxDepth=12, seed=M.SEED).fit(M.with_vectors(df, ["a", "b"]))
    nodes = lambda m: m.toDebugString.split("\n", 1)[1]  # noqa: E731  (the first line has a name of its own)
    assert fitted.model.getCacheNodeIds() and nodes(fitted.model) == nodes(plain)


def test_a_forest_grown_in_lots_scores_as_all_its_trees(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(M, "ROWS_PER_LOT", 200)
    rows = [(i % 70, float(i % 17), float(i * i % 23), int(i % 17 > 8)) for i in range(80)]  # row ids repeat
    df = spark.createDataFrame(rows, "row_id long, a double, b double, label int")
    fitted = M.fit_forest(df, ["a", "b"], "label", "row_id", n_estimators=5, max_depth=4)
    assert fitted.extra["lots"] == [2, 2, 1]  # never more than two trees of 80 rows at once
    scored = [tuple(r) for r in M.add_scores(fitted, df).orderBy("row_id", "a", "b").collect()]
    want = {}
    for path, n in zip(fitted.model.paths, fitted.model.trees, strict=True):
        lot = M.RandomForestClassificationModel.load(path)
        assert lot.getNumTrees == n
        for row in lot.transform(M.with_vectors(df, ["a", "b"])).select("a", "b", "probability").collect():
            want.setdefault((row["a"], row["b"]), {})[path] = n * row["probability"][1] / 5
    assert len(scored) == 80 and all(abs(r[4] - sum(want[r[1], r[2]].values())) < 1e-9 and r[5] == (r[4] > 0.5) for r in scored)
    again = M.load_fitted(spark, M.save_fitted(fitted, str(tmp_path / "forest"), spark))
    assert [tuple(r) for r in M.add_scores(again, df).orderBy("row_id", "a", "b").collect()] == scored
    weights = {r["feature"]: r["importance"] for r in M.feature_importances(again).collect()}
    assert abs(sum(weights.values()) - 1) < 1e-9 and weights["a"] > weights["b"]
