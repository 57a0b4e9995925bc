import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from millrace import models
from millrace.sources import scratch_path


def test_stages_can_be_saved(spark):
    df = spark.createDataFrame(
        [(0.0, "a", 1.0, 2.0), (1.0, None, None, 3.0), (1.0, "b", 3.0, 4.0), (0.0, "a", 2.0, 9.0)],
        "label double, s string, x double, y double",
    )
    fitted = models.build_pipeline(*models.typed_stages(df, "label")).fit(df)
    out = fitted.transform(df).orderBy("y").collect()
    assert out[1].ImputedsIndex == 0.0
    assert out[1].Imputedx == 2.0 and out[1].Imputedx_Imputedy == 6.0 and out[1].Imputedx_2 == 4.0
    path = scratch_path(spark, "model")
    fitted.save(path)
    again = PipelineModel.load(path).transform(df).select("features")
    assert again.exceptAll(fitted.transform(df).select("features")).count() == 0
    unseen = spark.createDataFrame([(0.0, "zzz", 1.0, 1.0)], df.schema)
    assert fitted.transform(unseen).first().ImputedsIndex == 0.0


@pytest.fixture(scope="module")
def scored(spark):
    rows = [(1, 1)] * 6 + [(1, 0)] * 2 + [(0, 1)] * 1 + [(0, 0)] * 3
    return spark.createDataFrame(rows, "label int, prediction int")


def test_reports(scored):
    r = models.binary_report(scored).first()
    assert r[:] == pytest.approx((9 / 12, 6 / 7, 6 / 8, 2 * (6 / 7) * (6 / 8) / (6 / 7 + 6 / 8)))
    rows = {r["class"]: r for r in models.classification_report(scored).collect()}
    assert rows["0"][1:3] == pytest.approx((3 / 5, 3 / 4)) and rows["0"].support == 4
    assert rows["weighted avg"].recall == pytest.approx(9 / 12)
    assert rows["macro avg"].precision == pytest.approx((6 / 7 + 3 / 5) / 2)
    matrix = {r.label: (r["0"], r["1"]) for r in models.confusion_pivot(scored, [0, 1]).collect()}
    assert matrix == {0: (3, 1), 1: (2, 6)}


def test_report_of_predictions_of_another_type(scored):
    mixed = scored.withColumn("prediction", F.col("prediction").cast("double"))
    assert models.classification_report(mixed).exceptAll(models.classification_report(scored)).count() == 0


def test_undefined_scores_are_zero(scored):
    none = scored.withColumn("prediction", F.lit(0))
    assert models.binary_report(none).first()[1:] == (0.0, 0.0, 0.0)


@pytest.mark.parametrize(
    "champion, first, second, expected",
    [(0.9, 0.8, 0.7, "do_nothing"), (0.8, 0.9, 0.7, "max"), (0.8, 0.85, 0.85, "product"), (0.8, 0.7, 0.795, "product")],
)
def test_decision(spark, champion, first, second, expected):
    metrics = spark.createDataFrame(
        [("production", champion), ("max", first), ("product", second)], "model string, value double"
    )
    assert models.decide(metrics, "production", ["max", "product"], 0.01).first().decision == expected


def test_best_takes_the_lower_name_on_ties(spark):
    metrics = spark.createDataFrame([("b", 0.5), ("a", 0.5), ("c", None)], "model string, value double")
    assert models.select_best(metrics).first().model == "a"


def test_noise_lowers_accuracy(spark):
    df = spark.range(300).selectExpr(
        "id", "CAST(id % 2 AS DOUBLE) AS label", "id % 2 + (id % 7) / 100 AS x", "0.5D AS y"
    )
    model = models.build_pipeline(models.assemble(["x", "y"]), models.estimator("lr")).fit(df)
    calm = models.perturbation_test(model, df, ["x", "y"], 0.0, 5, "id", 1).first()
    assert (calm.trials, calm["mean"], calm.std_error) == (2, 1.0, 0.0)
    noisy = models.perturbation_test(model, df, ["x", "y"], 1.0, 9, "id", 1).first()
    assert noisy.trials == 9 and 0.5 < noisy["mean"] < 0.95 and noisy.ci_lo < noisy["mean"] < noisy.ci_hi
    again = models.perturbation_test(model, df.repartition(5), ["x", "y"], 1.0, 9, "id", 1).first()
    assert again["mean"] == pytest.approx(noisy["mean"])


def test_three_classes_with_a_linear_svm(spark):
    df = spark.range(90).selectExpr("CAST(id % 3 AS DOUBLE) AS label", "id % 3 * 5 + id / 90 AS x", "(id % 3 - 1) * (id % 3 - 1) * 5 AS y")
    data = models.assemble(["x", "y"]).transform(df)
    model = models.fit(models.estimator("svm", classes=3, maxIter=20), data)
    assert models.accuracy(model.transform(data)).first().accuracy > 0.9


def test_scaling_uses_the_sample_deviation(spark):
    df = models.assemble(["x"]).transform(spark.createDataFrame([(1.0,), (3.0,)], "x double"))
    out = models.standard_scale().fit(df).transform(df).orderBy("x").first()
    assert out.scaled_features[0] == pytest.approx(-1 / 2**0.5)
