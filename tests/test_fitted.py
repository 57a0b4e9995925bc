"""Kernel features, optimality of fits, and trees as tables."""

import math

import pytest
from compare import physical_plan
from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace import models
from millrace import operators as op
from millrace.catalog import training
from millrace.models import train
from millrace.sources import scratch_path


@pytest.fixture(scope="module")
def rings(spark):
    """Two rings around one centre: no line tells them apart."""
    angle = F.col("id") * F.lit(2.399963)
    radius = F.when(F.col("id") % 2 == 0, 1.0).otherwise(2.5) + (F.col("id") % 5) * F.lit(0.05)
    df = spark.range(400).select(
        "id", (F.col("id") % 2).cast("double").alias("label"), (radius * F.cos(angle)).alias("x"), (radius * F.sin(angle)).alias("y")
    )
    return models.assemble(["x", "y"]).transform(df.coalesce(1)).cache()


def test_kernel_machine_beats_the_line_on_rings(spark, rings):
    train, test = op.random_split(rings, [0.7, 0.3], "id", 1)
    found = {}
    for kind, steps in (("svm", 3), ("rbf_svm", 20)):
        model = models.fit(models.estimator(kind, regParam=0.01, maxIter=steps), train)
        found[kind] = models.versus_majority(model.transform(test)).first().accuracy
    assert found["svm"] < 0.75 and found["rbf_svm"] > 0.97


def test_products_of_features_are_kernel_values(rings):
    """With 2,048 pairs the deviation is 1/64 at most; five of them bound all pairs of 60 rows."""
    gamma = 0.5
    model = models.FourierFeatures(pairs=2048, gamma=gamma, seed=3).fit(rings)
    rows = model.transform(rings.limit(60)).select("x", "y", vector_to_array("fourier_features").alias("z")).collect()
    worst = 0.0
    for a in rows:
        for b in rows:
            kernel = math.exp(-gamma * ((a.x - b.x) ** 2 + (a.y - b.y) ** 2))
            worst = max(worst, abs(kernel - sum(u * v for u, v in zip(a.z, b.z))))
    assert worst < 5 / math.sqrt(2 * 2048)
    assert all(sum(u * u for u in r.z) == pytest.approx(1) for r in rows)


def test_gamma_is_that_of_the_data_unless_given(spark, rings):
    both = rings.select(F.explode(F.array("x", "y")).alias("v")).agg(F.var_pop("v")).first()[0]
    model = models.FourierFeatures(pairs=2).fit(rings)
    assert model.getOrDefault("gamma") == pytest.approx(1 / (2 * both)) and model.getOrDefault("size") == 2
    assert models.FourierFeatures(pairs=2, gamma=0.25).fit(rings).getOrDefault("gamma") == 0.25
    none = models.FourierFeatures(pairs=2).fit(rings.limit(0))
    assert none.transform(rings.limit(0)).count() == 0


def test_kernel_machine_can_be_saved(spark, rings):
    model = models.estimator("rbf_svm", pairs=8, seed=5, regParam=0.01, maxIter=5).fit(rings)
    path = scratch_path(spark, "kernel")
    model.save(path)
    again = PipelineModel.load(path).transform(rings).select("id", "fourier_features", "prediction")
    assert again.exceptAll(model.transform(rings).select("id", "fourier_features", "prediction")).count() == 0


@pytest.fixture(scope="module")
def noisy(spark):
    """Three classes that two of three columns decide in part; the third never changes."""
    df = spark.range(600).select(
        "id",
        (F.col("id") % 3).cast("double").alias("label"),
        (F.col("id") % 3 + 100 * (F.col("id") * 7919 % 101) / 40).alias("x"),
        (F.col("id") % 2 + (F.col("id") * 104729 % 103) / 50 - F.col("id") % 3).alias("y"),
        F.lit(4.0).alias("constant"),
    )
    return models.assemble(["x", "y", "constant"]).transform(df.coalesce(1)).cache()


@pytest.mark.parametrize("scaled", [True, False])
@pytest.mark.parametrize("penalty", [0.0, 0.05])
@pytest.mark.parametrize("classes", [2, 3])
def test_gradient_is_zero_at_the_optimum_only(noisy, classes, penalty, scaled):
    df = noisy if classes == 3 else noisy.withColumn("label", (F.col("label") > 0).cast("double"))
    fit = {"regParam": penalty, "standardization": scaled}
    good = models.estimator("lr", tol=1e-12, maxIter=500, **fit).fit(df)
    rows = models.logistic_gradient(good, df).collect()
    assert len(rows) == 4 * (3 if classes == 3 else 1)
    assert max(abs(r.gradient) for r in rows) < 1e-5
    poor = models.estimator("lr", maxIter=1, **fit).fit(df)
    assert max(abs(r.gradient) for r in models.logistic_gradient(poor, df).collect()) > 1e-3


def test_steps_from_a_fitted_margin_gain_nothing(noisy):
    df = noisy.withColumn("label", (F.col("label") > 0).cast("double"))
    good = models.estimator("svm", regParam=0.01, maxIter=40).fit(df)
    rows = models.hinge_gains(good, df).collect()
    assert len(rows) == 4 and all(r.n == 600 and r.gain < 1e-3 for r in rows)
    poor = models.estimator("svm", regParam=0.01, maxIter=1).fit(df)
    assert max(r.gain for r in models.hinge_gains(poor, df).collect()) > 1e-3
    rest = models.estimator("svm", classes=3, regParam=0.01, maxIter=40).fit(noisy)
    gains = models.hinge_gains(rest, noisy)
    assert gains.select("class").distinct().count() == 3 and gains.agg(F.max("gain")).first()[0] < 1e-3


@pytest.mark.parametrize("kind, params", [("tree", {"maxDepth": 4}), ("forest", {"maxDepth": 5, "numTrees": 7, "seed": 1}), ("tree", {"maxDepth": 0})])
def test_node_tables_say_what_the_model_says(noisy, kind, params):
    model = models.estimator(kind, **params).fit(noisy)
    nodes = models.tree_nodes(model)
    wanted = model.transform(noisy).select("id", "prediction", vector_to_array("probability").alias("p"))
    both = models.predict_by_nodes(noisy, nodes, "id").withColumnRenamed("prediction", "found").join(wanted, "id")
    assert both.count() == 600 and both.where("found <> prediction").count() == 0
    far = F.exists(F.zip_with("p", "probability", lambda a, b: F.abs(a - b) > 1e-12), lambda b: b)
    assert both.where(far).count() == 0
    leaves = models.reached_leaves(noisy, nodes, "id").groupBy("tree", "node").count()
    if kind == "tree":  # training rows by leaf are those that the fit counted
        kept = nodes.where("feature IS NULL").select("tree", "node", F.col("n").alias("count"))
        assert leaves.exceptAll(kept).count() == 0 and kept.exceptAll(leaves).count() == 0


def test_nodes_of_categories_and_without_broadcast(spark, monkeypatch):
    from pyspark.ml.feature import StringIndexer, VectorAssembler

    from millrace.models import nodes as module

    df = spark.range(300).selectExpr("id", "CAST(id % 5 IN (1, 3) AS DOUBLE) AS label", "concat('c', id % 5) AS c", "id * 1.5D AS x")
    stages = models.build_pipeline(
        StringIndexer(inputCol="c", outputCol="i"), VectorAssembler(inputCols=["i", "x"], outputCol="features"), models.estimator("tree")
    )
    model = stages.fit(df)
    scored = model.transform(df)
    table = models.tree_nodes(model.stages[-1])
    assert table.where("categories IS NOT NULL").count() > 0
    wanted = {r.id: r.prediction for r in scored.collect()}
    assert {r.id: r.prediction for r in models.predict_by_nodes(scored, table, "id").collect()} == wanted
    monkeypatch.setattr(module, "fits_broadcast", lambda *_: False)
    assert {r.id: r.prediction for r in models.predict_by_nodes(scored, table, "id").collect()} == wanted


def test_index_model_is_a_table_of_codes(spark, sf_dir):
    """More labels than may be broadcast, unseen and missing ones, and one that most rows hold."""
    train = spark.range(40_000).selectExpr(
        "id", "CASE WHEN id % 3 = 0 THEN 'hot' WHEN id % 50 = 1 THEN NULL ELSE concat('label ', id) END AS many",
        "concat('k', id % 3) AS few",
    )
    estimator = models.ImputedStringIndexer(inputCols=["many", "few"], outputCols=["m", "f"])
    model = estimator.fit(train)
    assert model.getOrDefault("sizes")[0] > 20_000 and model.getOrDefault("sizes")[1] == 3
    new = spark.createDataFrame([("hot", "k1"), (None, "k0"), ("never seen", None), ("label 10", "k2"), ("label 1000", "zz")], "many string, few string")
    rows = {tuple(r[:2]): tuple(r[2:]) for r in model.transform(new).collect()}
    assert rows["hot", "k1"] == (0.0, 1.0) and rows[None, "k0"] == (0.0, 0.0) and rows["never seen", None] == (0.0, 0.0)
    assert rows["label 1000", "zz"] == (3.0, 0.0) and rows["label 10", "k2"] == (1.0, 2.0)
    path = scratch_path(spark, "codes")
    model.save(path)
    again = models.CategoryModel.load(path).transform(new)
    assert again.exceptAll(model.transform(new)).count() == 0
    none = estimator.fit(train.limit(0)).transform(new)
    assert {(r.m, r.f) for r in none.collect()} == {(0.0, 0.0)}


def test_codes_scan_the_source_once_for_all_columns(spark, sf_dir, monkeypatch):
    from millrace.operators import codes as module

    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_returnflag", "l_linestatus", "l_linenumber", "l_quantity", "l_discount")
    seen = []
    stored = module._stored
    monkeypatch.setattr(module, "_stored", lambda d, label: (seen.append(physical_plan(d).count("lineitem.parquet")), stored(d, label))[1])
    encoded = op.label_encode(df, df.columns)
    assert seen == [1]
    assert physical_plan(encoded).count("Scan parquet") == 1 + 5
    monkeypatch.setattr(module, "MAX_ROWS", 5)
    assert op.label_encode(df, df.columns).exceptAll(encoded).count() == 0 and seen == [1, 1, 0]
    row = encoded.where("l_linenumber = 1").first()
    assert row["l_linenumber_encoded"] == 0


def test_shares_of_letters_are_written_once(spark, tmp_path):
    """All passes of a fit read ten numbers a document, and not its text."""
    texts = ["Anna sah ÉÀ! 東京 \U0001f600 aAa", "", None, "xyz", "İstanbul ſe K\u212a", "theories\nof a shore"]
    rows = [(i if i != 3 else None, t, ["en", "fr", "de", "es", None, "en"][i]) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string").write.parquet(f"{tmp_path}/documents.parquet")
    for classes, labels in ((2, [1, 0, 0, 0, None, 1]), (4, [0, 1, 2, 3, None, 0])):
        parts = training._letters(spark, str(tmp_path), classes)
        assert not any("documents.parquet" in f for part in parts for f in part.inputFiles())
        got = {r.doc_id: (r.label, list(r.features)) for part in parts for r in part.collect()}
        assert len(got) == len(rows)
        for (key, text, _), label in zip(rows, labels):
            lower = spark.createDataFrame([(text or "",)], "t string").select(F.lower("t")).first()[0]
            assert got[key] == (label, [lower.count(c) / max(1, len(lower)) for c in training._LETTERS])


def test_large_parts_are_spread_before_a_fit(spark, monkeypatch):
    """What one task of a fit holds is bounded by rows, however few parts the source has."""
    monkeypatch.setattr(train, "ROWS_PER_TASK", 100, raising=False)

    def parts(df):
        return [r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]

    df = spark.range(950).select((F.col("id") % 7).alias("x"), F.lit(None).cast("long").alias("label")).coalesce(1)
    with train.kept(df) as rows:
        assert max(parts(rows)) <= 110 and sum(parts(rows)) == 950
        assert rows.exceptAll(df).count() == 0
        with train.kept(rows.where("x > 2")) as fewer:
            assert len(parts(fewer)) == 10  # small parts stay
    for small in (df.limit(90), df.limit(0)):
        with train.kept(small) as rows:
            assert rows is small
