"""The end-to-end jobs on small made-up inputs with the real layouts."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.plans import cars, census, flights, heart, passengers, wine, words
from millrace.sources import scratch_path, write_csv, write_json, write_xml

RNG = random.Random(11)


def test_census(spark):
    source, target = scratch_path(spark, "census"), scratch_path(spark, "out")
    lines = [
        "39, State-gov, 77516, Bachelors, 13, Never-married, Adm, Not-in-family, White, Male, 2174, 0, 40, US, <=50K",
        "50, Self-emp, 83311, Bachelors, 13, Divorced, Exec, Husband, White, Male, 0, 0, 13, US, <=50K",
        "38, Private, 215646, HS-grad, 9, Divorced, Clean, Not-in-family, White, Male, 100, 0, 40, US, >50K",
        "53, Private, , 11th, 7, Separated, Clean, Husband, Black, Male, 0, 0, 40, US, <=50K",
    ]
    spark.createDataFrame([(x,) for x in lines], "value string").write.text(source)
    reports = census.run(spark, source, target)
    missing = reports["missing"].first()
    assert (missing.fnlwgt, missing.age, missing.n_rows) == (1, 0, 4)
    assert {tuple(r) for r in reports["average_gain"].collect()} == {("Never-married", 2174.0), ("Divorced", 50.0)}
    assert reports["divorced"].count() == 2
    out = spark.read.csv(target, header=True, inferSchema=True)
    assert len(out.columns) == 15 + 21 + 3
    assert out.count() == 3 + 2  # two statuses of the reference occur in no row
    row = out.filter("age = 38").first()
    assert row.fnlwgt_x_fnlwgt == 215646**2 and row.age_x_fnlwgt == 38 * 215646
    assert (row.male, row.workclass) == (10.82, "Private")


def test_cars(spark):
    folder, target = scratch_path(spark, "cars"), scratch_path(spark, "out")
    frame = spark.createDataFrame(
        [("alto", 2012, 4253.731, "Petrol"), ("800", 2003, 522.388, "Petrol")], cars.SCHEMA
    )
    write_csv(frame, folder + "/1.csv")
    write_json(frame.withColumn("year_of_manufacture", F.lit(2001)), folder + "/1.json")
    write_xml(frame.withColumn("car_model", F.lit("ritz")), folder + "/1.xml")
    assert cars.extract(spark, folder).count() == 6
    out = {r.car_model: (r.year_of_manufacture, r.price) for r in cars.run(spark, folder, target).collect()}
    assert out == {"alto": (2001, 4253.73), "800": (2001, 522.39), "ritz": (2003, 522.39)}


def test_flights(spark):
    rows = [("MQ", 1.0, 100.0, None, 1), ("MQ", 0.0, 600.0, 100.0, 1), ("HA", 0.0, 400.0, 100.0, 6), ("HA", 0.0, 500.0, None, 6)]
    df = spark.createDataFrame(
        rows, "Reporting_Airline string, Cancelled double, Distance double, ActualElapsedTime double, DayOfWeek int"
    )
    assert {tuple(r) for r in flights.cancellation_rate(df).collect()} == {("MQ", 0.5), ("HA", 0.0)}
    speed = {r.DayOfWeek: r.mean_standard_speed for r in flights.speed_by_weekday(df).collect()}
    assert speed[1] == pytest.approx(2**-0.5) and speed[6] == pytest.approx(-(2**-0.5) / 2)


def test_words(spark):
    source, target = scratch_path(spark, "text"), scratch_path(spark, "out")
    spark.createDataFrame([("a b a",), ("b, a b b",)], "value string").write.text(source)
    words.run_word_count(spark, source, target)
    assert {r.value for r in spark.read.text(target).collect()} == {"a\t3", "b\t3"}
    table, sample = scratch_path(spark, "csv"), scratch_path(spark, "sample")
    write_csv(spark.range(5000).selectExpr("id", "id * 2 AS x"), table)
    words.run_sampling(spark, table, sample, "id", 0.1)
    assert 400 < spark.read.csv(sample, header=True).count() < 600


def _heart_rows(n=400):
    rows = []
    for i in range(n):
        age, sex = RNG.randint(16, 80), RNG.randint(0, 1)
        target = int(RNG.random() < (0.75 if age > 50 else 0.25))
        row = {"patient": i, "age": age, "sex": sex, "cp": RNG.randint(1, 4), "target": target}
        row |= {c: RNG.choice([0, 1, 1, None]) for c in ("painloc", "painexer", "exang")}
        row |= {c: RNG.choice([0, 0, 0, 1, 2, 22, None]) for c in heart.FLAGS}
        row["slope"] = RNG.choice([1, 2, 2, 3, None])
        row["smoke"] = RNG.choice([0.0, 1.0, None])
        row["trestbps"] = RNG.choice([0.0, 95.0, 100.0, 130.0, 150.0, None])
        row["oldpeak"] = RNG.choice([-2.6, 0.0, 1.5, 4.0, 5.0, None])
        row |= {c: RNG.choice([RNG.uniform(60, 190), None]) for c in heart.MEAN_COLUMNS}
        rows.append(row)
    return rows


@pytest.fixture(scope="module")
def patients(spark):
    schema = "patient int, age int, sex int, cp int, target int, painloc int, painexer int, exang int, " + (
        "".join(f"{c} int, " for c in heart.FLAGS)
    ) + "slope int, smoke double, trestbps double, oldpeak double, thaldur double, thalach double"
    names = [f.strip().split()[0] for f in schema.split(",")]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in _heart_rows()], schema)


PAGE = (
    '<ul class="block-list"><li class="main">13.1% of men (13.1%)</li><li>women (10.1%)</li></ul>'
    '<ul class="block-list"><li>adults aged 18–24 years (5.3%)</li>'
    "<li>adults aged 25&ndash;64 years (12.6%)</li><li>aged 65 years and older (8.3%)</li></ul>"
)


def test_heart_modelling(spark, patients):
    clean = heart.clean_for_modelling(patients).persist()
    left = op.missing_profile(clean).first().asDict()
    assert [c for c, n in left.items() if n and c not in ("n_rows", "smoke")] == []
    assert clean.filter("trestbps < 100 OR oldpeak < 0 OR oldpeak > 4 OR prop > 1").count() == 0
    assert clean.filter("trestbps = 100").count() == patients.filter("trestbps = 100").count()
    mean = patients.filter("trestbps > 100").agg(F.avg("trestbps")).first()[0]
    assert clean.filter(F.abs(F.col("trestbps") - mean) < 1e-9).count() == patients.filter(
        "trestbps IS NULL OR trestbps < 100"
    ).count()
    over_all = heart.clean_for_modelling(patients, "all")
    assert over_all.filter("oldpeak < 0 OR oldpeak > 4").count() == 0

    numbers = ", ".join(str([v]) for v in range(10, 90, 10))
    chart = (
        f'<div class="chart-data-wrapper"><pre class="chart-caption">{heart.CHART_CAPTION} to 2022</pre>'
        f'<pre class="chart-data">[{"[], " * 7}[{numbers}]]</pre></div>'
    )
    pages = spark.createDataFrame([(chart, PAGE)], "chart string, html string")
    by_age = heart.bands_by_age(pages.select(F.col("chart").alias("html")))
    assert sorted(tuple(r) for r in by_age.collect())[:2] == [(15, 17, 0.1), (18, 24, 0.2)]
    by_sex = heart.bands_by_sex(pages)
    rates = {(r.sex, r.lo, r.hi): r.rate for r in by_sex.collect()}
    assert rates[0, 25, 64] == 12.6 and rates[0, 65, None] == 8.3
    assert rates[1, 18, 24] == pytest.approx(5.3 * 13.1 / 10.1)

    shares = op.scale_rates(by_sex, 0.01)
    filled = heart.impute_smoking(clean, by_age, shares, "patient").persist()
    assert filled.filter("smoke IS NULL").count() == 0
    known = clean.filter("smoke IS NOT NULL").select("patient", "smoke")
    assert known.exceptAll(filled.select("patient", "smoke")).count() == 0
    young = filled.filter("age < 18")
    assert young.count() == 0 or young.filter("source_2 IS NOT NULL AND smoke IS NULL").count() == 0
    rated = heart.smoking_rate(clean, op.scale_rates(by_age, 100.0), by_sex)
    expected = {(r.patient): r for r in rated.filter("age BETWEEN 25 AND 34 AND sex = 0").collect()}
    assert expected and all(r.smoke == pytest.approx((30 + 12.6) / 2) for r in expected.values())

    scores, report = heart.choose_and_report(filled, ["age", "sex", "cp"], "patient", {"lr": {"maxIter": 10}, "tree": {}})
    assert {r.model for r in scores.collect()} == {"lr", "tree"}
    rows = {r["class"]: r for r in report.collect()}
    assert rows["macro avg"].support == 40 and rows["weighted avg"].f1 > 0.5

    narrow = filled.select("patient", "age", "cp", "target")
    metrics, final = heart.six_models(narrow, filled, rated.na.fill(0.0), "patient", {"lr": {"maxIter": 10}, "svm": {"maxIter": 4}})
    assert metrics.count() == 6 and 0.5 < final.first().accuracy <= 1


def test_heart_reporting_and_all_columns(spark):
    rows = [
        (i, float(RNG.randint(30, 70)) if i != 7 else 400.0, RNG.choice([0, 1, None]), RNG.choice([1, 3, 5, 14, None]),
         RNG.choice([0, 0, 0, 1, 22]), 1.0, float(i % 5), None, RNG.choice([1, 0]), RNG.choice([0, 1, None]), 9)
        for i in range(950)
    ]
    df = spark.createDataFrame(
        rows,
        "row int, chol double, painloc int, proto int, prop int, smoke double, `ekgday(day` double, restckm double, "
        "painexer int, relrest int, pncaden int",
    )
    clean = heart.clean_for_reporting(df)
    types = dict(clean.dtypes)
    assert types["painloc"] == "boolean" and types["proto"] == "int" and types["prop"] == "boolean"
    assert "smoke" not in types and "ekgday" in types
    assert clean.agg(F.max("chol"), F.max("proto")).first()[:] == pytest.approx((70.0, 5))
    whole = heart.clean_all_columns(df, ["row"])
    assert whole.count() == 898  # the first rows without the extreme one
    assert whole.filter("restckm <> 0 OR pncaden <> painloc + painexer + relrest").count() == 0
    assert heart.log_and_round(whole).count() == 898


def test_table_of_rates(spark):
    def row(head, value):
        cells = "".join(f'<td class="data-value">{i}</td>' for i in range(9))
        return f'<tr><th scope="row" class="row-header">{head}</th>{cells}<td class="data-value">{value}</td></tr>'

    html = (
        '<table class="responsive-enabled"><tr></tr></table><table class="responsive-enabled" id="2"><tr><th>Age</th></tr>'
        + row("15–17", 2.5) + row("75 years and over", 5.1) + "</table>"
    )
    bands = heart.bands_by_age_table(spark.createDataFrame([(html,)], "html string"))
    assert {tuple(r) for r in bands.collect()} == {(15, 17, 2.5), (75, None, 5.1)}


def test_passengers(spark):
    rows = []
    for i in range(300):
        sex, fare = RNG.choice(["male", "female", None]), RNG.choice([RNG.uniform(5, 90), None])
        lived = int(RNG.random() < (0.95 if sex == "female" else 0.05))
        rows.append((i, lived, f"Name {i}", sex, RNG.randint(1, 3), fare, RNG.choice("SCQ")))
    df = spark.createDataFrame(
        rows, "PassengerId int, Survived int, Name string, Sex string, Pclass int, Fare double, Embarked string"
    )
    outcome = passengers.train_and_score(df, depths=(2, 3), trees=(5,))
    assert outcome.params["numTrees"] == 5 and outcome.params["maxDepth"] in (2, 3)
    assert 0.6 < outcome.auc.first().auc <= 1
    inputs = outcome.model.stages[-2].getInputCols()
    assert "ImputedFare_2" in inputs and "ImputedPclass_ImputedFare" in inputs and "ImputedSexIndex" in inputs


def test_wine(spark):
    rows = []
    for i in range(150):
        kind = i % 3 + 1
        rows.append((kind, RNG.gauss(kind * 2, 0.4), RNG.gauss(-kind, 0.5), RNG.choice("ab")))
    rows += [(1, 500.0, 0.0, "a"), (2, None, 0.0, "b")]
    path = scratch_path(spark, "wine")
    write_csv(spark.createDataFrame(rows, "Wine int, Alcohol double, `Malic.acid` double, cask string"), path)
    result = wine.run(spark, path, "wine_test").first()
    assert result.decision in ("max", "product") and result.champion_value > 0.8
    assert result.accuracy > 0.8 and result.ci_lo <= result["mean"] <= result.ci_hi
    assert spark.table("wine_test.clean").count() == 150
    params = {r["name"]: r for r in spark.table("wine_test.normalization").collect()}
    assert set(params) == {"Alcohol", "Malic.acid", "cask_encoded"}
    train = spark.table("wine_test.train").agg(F.min("Alcohol"), F.max("Alcohol")).first()
    assert train[:] == pytest.approx((0.0, 1.0))
