"""Classifiers and k-means as ML stages: chained, tuned, written and read."""

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import functions as F

from veinworks.functions.numeric import numeric_columns
from veinworks.operators.sampling import fold_column
from veinworks.operators.silhouette import mean_silhouette
from veinworks.plans.models import Classifier, ClassifierModel, KMeansClusters, KMeansClustersModel, ScoreEvaluator, SilhouetteEvaluator
from veinworks.plans.preprocess import Preprocess
from veinworks.plans.steps import SelectFeatures

SMALL = {
    "Logistic Regression": "{}", "KNN": "{}", "SVM": "{}", "Random Forest": '{"n_estimators": 5, "max_depth": 4}',
    "Gradient Boosting": '{"n_estimators": 3, "max_depth": 3}',
}


@pytest.fixture(scope="module")
def data(spark):
    draw = np.random.default_rng(3)
    rows = [(i, int(i % 4 == 0), *(float(draw.normal(m * (i % 4 == 0), 1)) for m in (3.0, -2.0, 0.0))) for i in range(200)]
    return spark.createDataFrame(rows, "row_id long, label int, a double, b double, n double").cache()


@pytest.mark.parametrize("name", list(SMALL))
def test_classifiers_keep_columns_and_survive_writing(data, tmp_path, name):
    rows = data.withColumn("score", F.lit("old")).withColumn("kept a", F.lit("x"))
    model = Classifier(method=name, features=["a", "b", "n"], settings=SMALL[name]).fit(data)
    scored = model.transform(rows)
    assert sorted(scored.columns) == sorted([*rows.columns, "prediction"]) and scored.count() == 200
    assert ScoreEvaluator().evaluate(scored) > 0.9 and ScoreEvaluator(metric="accuracy").evaluate(scored) > 0.85
    model.write().overwrite().save(str(tmp_path / "m"))
    again = ClassifierModel.load(str(tmp_path / "m"))
    assert again.uid == model.uid
    want = {r["row_id"]: (r["score"], r["prediction"]) for r in scored.collect()}
    assert {r["row_id"]: (r["score"], r["prediction"]) for r in again.transform(rows).collect()} == want
    assert again.transform(rows.limit(0)).count() == 0


def test_vector_models_score_without_a_shuffle(data, capsys):
    for name in ("Logistic Regression", "SVM"):
        Classifier(method=name, features=["a", "b"]).fit(data).transform(data).explain()
        assert "Exchange" not in capsys.readouterr().out


def test_preparation_selection_and_model_in_one_pipeline(data, tmp_path):
    stages = [Preprocess(label="label"), SelectFeatures(label="label", problem="classification", nFeatures=2), Classifier()]
    model = Pipeline(stages=stages).fit(data)
    model.write().save(str(tmp_path / "p"))
    again = PipelineModel.load(str(tmp_path / "p"))
    scored = again.transform(data)
    assert sorted(again.stages[-1].fitted.features) == ["a", "b"]
    assert ScoreEvaluator().evaluate(scored) == ScoreEvaluator().evaluate(model.transform(data)) > 0.95


def test_cross_validator_with_given_folds(data):
    rows = data.withColumn("fold", fold_column("row_id", 3))
    estimator = Classifier(features=["a", "b", "n"])
    grid = ParamGridBuilder().addGrid(estimator.settings, ['{"C": 0.000001}', '{"C": 1.0}']).build()
    found = CrossValidator(estimator=estimator, estimatorParamMaps=grid, evaluator=ScoreEvaluator(metric="accuracy"), numFolds=3, foldCol="fold").fit(rows)
    assert found.avgMetrics[1] > found.avgMetrics[0] and found.bestModel.fitted.params["C"] == 1.0
    means = []
    for i in range(3):
        model = estimator.fit(rows.where(F.col("fold") != i))
        means.append(ScoreEvaluator(metric="accuracy").evaluate(model.transform(rows.where(F.col("fold") == i))))
    assert found.avgMetrics[1] == pytest.approx(sum(means) / 3)


def test_kmeans_stage(data, tmp_path):
    model = KMeansClusters(k=2, features=["a", "b"]).fit(data)
    model.write().save(str(tmp_path / "k"))
    rows = data.unionByName(spark_row(data))
    found = KMeansClustersModel.load(str(tmp_path / "k")).transform(rows)
    assert found.columns == [*data.columns, "prediction"] and found.where("row_id = -1").first()["prediction"] is None
    scored = found.where("row_id >= 0")
    assert SilhouetteEvaluator(features=["a", "b"]).evaluate(scored) == mean_silhouette(scored, ["a", "b"])
    assert SilhouetteEvaluator(features=["a"]).evaluate(scored.withColumn("prediction", F.lit(0))) == -1.0


def spark_row(data):
    return data.limit(1).withColumn("row_id", F.lit(-1).cast("long")).withColumn("a", F.lit(None).cast("double"))


def test_unknown_names_are_refused(data):
    with pytest.raises(ValueError, match="KNN"):
        Classifier(method="perceptron")
    with pytest.raises(ValueError, match="ROC AUC"):
        ScoreEvaluator(metric="kappa").evaluate(data.withColumn("score", F.lit(0.5)).withColumn("prediction", F.lit(0)))
    assert numeric_columns(data, ["row_id", "label"]) == ["a", "b", "n"]
