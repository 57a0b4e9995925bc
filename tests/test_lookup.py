import random

import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.functions import hash_uniform

BANDS = [(15, 17, 0.1), (18, 24, 0.2), (25, 34, 0.3), (65, None, 0.9)]


@pytest.fixture(scope="module")
def bands(spark):
    return spark.createDataFrame(BANDS, "lo int, hi int, rate double")


def found(x):
    hits = [r for lo, hi, r in BANDS if x is not None and x >= lo and (hi is None or x <= hi)]
    return hits[0] if hits else None


@pytest.mark.parametrize("max_scanned", [64, 0])
def test_bands(spark, bands, max_scanned):
    ages = [None, 3, 15, 17, 18, 24, 25, 34, 35, 64, 65, 10**6, -5] + random.Random(3).choices(range(100), k=200)
    df = spark.createDataFrame(list(enumerate(ages)), "id int, age int")
    out = op.range_lookup(df, bands, "age", max_scanned=max_scanned)
    assert {r.id: r.rate for r in out.collect()} == {i: found(a) for i, a in enumerate(ages)}


@pytest.mark.parametrize("max_scanned", [64, 0])
def test_bands_by_group(spark, bands, max_scanned):
    grouped = op.rates_by_group(bands, "sex", {0: 1.0, 1: 2.0})
    df = spark.createDataFrame([(1, 0, 20), (2, 1, 20), (3, 2, 20), (4, 1, 99)], "id int, sex int, age int")
    out = op.range_lookup(df, grouped, "age", by=["sex"], max_scanned=max_scanned)
    assert {r.id: r.rate for r in out.collect()} == {1: 0.2, 2: 0.4, 3: None, 4: 1.8}


def test_one_band_and_equal_ends(spark):
    df = spark.createDataFrame([(1, 5.0), (2, 6.0)], "id int, x double")
    one = spark.createDataFrame([(5.0, 5.0, 1.0)], "lo double, hi double, rate double")
    for scanned in (64, 0):
        out = op.range_lookup(df, one, "x", max_scanned=scanned)
        assert {r.id: r.rate for r in out.collect()} == {1: 1.0, 2: None}


@pytest.mark.parametrize("max_rows", [10_000, 0])
def test_outer_join(spark, max_rows):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (4, "a")], "id int, k string")
    ref = spark.createDataFrame([("a", 1.0), ("c", 3.0), (None, 4.0)], "name string, share double")
    out = op.join_reference(df, ref, ("k", "name"), max_rows)
    assert sorted(map(str, out.collect())) == sorted(
        map(str, df.join(ref, df.k == ref.name, "full_outer").collect())
    )


def test_nan_lies_in_no_band(spark, bands):
    df = spark.createDataFrame([(1, float("nan")), (2, 70.0)], "id int, x double")
    for scanned in (64, 0):
        out = op.range_lookup(df, bands, "x", max_scanned=scanned)
        assert {r.id: r.rate for r in out.collect()} == {1: None, 2: 0.9}


def test_rows_without_a_key_are_kept_by_splits(spark):
    df = spark.createDataFrame([(None, 1), (2, 2)], "id int, v int")
    assert sum(p.count() for p in op.random_split(df, [0.5, 0.5], "id", 1)) == 2
    assert op.kfold(df, 3, "id", 1).filter("fold IS NULL").count() == 0


def test_bernoulli_rate_and_repeatability(spark, bands):
    df = spark.range(20_000).select("id", F.lit(30).alias("age"), F.lit(None).cast("double").alias("smoke"))
    out = op.impute_bernoulli(df, "smoke", bands, "age", "id", 1)
    assert out.select(F.avg("smoke")).first()[0] == pytest.approx(0.3, abs=0.015)
    assert out.exceptAll(op.impute_bernoulli(df.repartition(7), "smoke", bands, "age", "id", 1)).count() == 0
    known = df.withColumn("smoke", F.lit(1.0))
    assert op.impute_bernoulli(known, "smoke", bands, "age", "id", 1).filter("smoke = 1").count() == 20_000


def test_split_and_sample(spark):
    df = spark.range(10_000)
    parts = op.random_split(df, [0.7, 0.2, 0.1], "id", 9)
    assert sum(p.count() for p in parts) == 10_000
    assert op.union_all(parts).distinct().count() == 10_000
    assert parts[0].count() == pytest.approx(7000, abs=200)
    folds = {r.fold: r.n for r in op.value_counts(op.kfold(df, 5, "id", 1), "fold").collect()}
    assert set(folds) == set(range(5)) and all(abs(n - 2000) < 200 for n in folds.values())
    u = df.select(hash_uniform(F.col("id"), 3).alias("u"))
    assert u.filter("u < 0 OR u >= 1").count() == 0


def test_stratified_split_is_exact(spark):
    rows = [(i, "big" if i % 3 else "small", i) for i in range(3000)] + [(3000, None, 0), (3001, "one", 0)]
    df = spark.createDataFrame(rows, "id int, label string, v int")
    train, test = op.stratified_split(df, "label", 0.1, "id", 4)
    sizes = {r.label: r.n for r in op.value_counts(test, "label").collect()}
    assert sizes == {"big": 200, "small": 100}
    assert train.count() + test.count() == 3002
    assert train.select("id").intersect(test.select("id")).count() == 0


def test_dedup_keeps_the_first_by_order(spark):
    rows = [("a", 2, "late"), ("a", 1, "early"), ("b", 5, None), ("a", 1, "tie"), (None, 1, "x"), (None, 0, "y")]
    df = spark.createDataFrame(rows, "k string, o int, v string")
    out = op.dedup_first(df, ["k"], ["o"])
    assert out.columns == ["k", "o", "v"]
    assert {tuple(r) for r in out.collect()} == {("a", 1, "early"), ("b", 5, None), (None, 0, "y")}


def test_word_count_keeps_empty_words(spark):
    df = spark.createDataFrame([("a  b ",), ("a b",), ("",)], "value string")
    counts = {r.word: r.n for r in op.word_count(df, min_count=1).collect()}
    assert counts == {"a": 2, "b": 2, "": 3}


def test_distinct_counts_compare_values_by_type(spark):
    df = spark.createDataFrame([(["a, b"], 0.0), (["a", "b"], -0.0), (None, None)], "a array<string>, x double")
    assert {r.column: r.n_distinct for r in op.distinct_counts(df, ["a", "x"]).collect()} == {"a": 2, "x": 1}


def test_quantiles_of_infinite_values(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0,), (inf,), (inf,), (inf,)], "v double")
    found = {r.prob: r.quantile for r in op.quantiles(df, ["v"], [0.0, 0.5, 1.0]).collect()}
    assert found == {0.0: 1.0, 0.5: inf, 1.0: inf}


def test_dedup_with_maps(spark):
    df = spark.createDataFrame([("a", 1, {"x": 2}), ("a", 1, {"x": 1}), ("b", 0, None)], "k string, o int, m map<string,int>")
    assert {r.k: r.m for r in op.dedup_first(df, ["k"], ["o"]).collect()} == {"a": {"x": 1}, "b": None}


@pytest.mark.parametrize("max_rows", [10_000, 0])
def test_outer_join_with_a_shared_name(spark, max_rows):
    df = spark.createDataFrame([(1, "a"), (2, None)], "id int, k string")
    ref = spark.createDataFrame([("a", 7), ("c", 8)], "k string, id int")
    out = op.join_reference(df, ref, ("k", "k"), max_rows)
    assert out.columns == ["id", "k", "k", "id"]
    assert sorted(map(str, map(tuple, out.collect()))) == sorted(
        map(str, [(1, "a", "a", 7), (2, None, None, None), (None, None, "c", 8)])
    )


def test_many_groups_of_bands_expand_little(spark):
    bands = spark.range(2000).selectExpr("id % 500 AS g", "id div 500 * 10.0 AS lo", "id div 500 * 10.0 + 9 AS hi", "id AS rate")
    df = spark.range(5000).selectExpr(
        "id", "IF(id % 7 = 0, NULL, id % 600) AS g", "CASE WHEN id % 3 = 0 THEN 5.0 WHEN id % 3 = 1 THEN id % 50 END AS x"
    )
    out = op.range_lookup(df, bands, "x", by=["g"])
    found = {r.id: r.rate for r in out.select("id", "rate").collect()}
    for i in range(5000):
        g, x = None if i % 7 == 0 else i % 600, 5.0 if i % 3 == 0 else float(i % 50) if i % 3 == 1 else None
        n = None if g is None or x is None or g >= 500 or x >= 40 or x % 10 > 9 else int(x // 10) * 500 + g
        assert found[i] == n


def test_codes_of_many_values_with_a_hot_one(spark, monkeypatch):
    from millrace.operators import codes

    monkeypatch.setattr(codes, "MAX_BYTES", 0)
    values = ["hot"] * 50 + [f"v{i}" for i in range(100)] + [None] * 30
    df = spark.createDataFrame([(v,) for v in values], "v string")
    rows = op.label_encode(df, ["v"]).collect()
    order = sorted(set(values) - {None})
    assert len(rows) == len(values) and all(r.v_encoded == (None if r.v is None else order.index(r.v)) for r in rows)


def test_large_reference_is_joined_in_parts_of_bounded_size(spark, monkeypatch):
    """More rows make more parts, also those of one key; same rows as a full outer join."""
    from millrace.operators import lookup

    monkeypatch.setattr(lookup, "ROWS_PER_TASK", 100, raising=False)
    keys = "CASE WHEN id < 900 THEN 7 WHEN id % 11 = 0 THEN NULL ELSE id % 1500 END"
    df = spark.range(3000).selectExpr(f"{keys} AS k", "id AS v", "id % 3 AS __salt_")
    ref = spark.range(1000).selectExpr("IF(id % 50 = 3, NULL, id * 2 + 1) AS r", "id % 4 AS v").union(
        spark.createDataFrame([(7, 9), (8, 9), (9, 10)], "r long, v long")
    )
    twice = ref.union(spark.range(150).selectExpr("IF(id < 130, 4L, 907L)", "id"))
    for rows, side in ((df, ref), (df.where("v >= 900"), ref), (df.limit(0), ref), (df.where("k IS NULL"), ref), (df, twice)):
        out = op.join_reference(rows, side, ("k", "r"), 10)
        wanted = rows.join(side, rows.k == side.r, "full_outer")
        assert out.columns == wanted.columns and out.toDF(*"abcde").exceptAll(wanted.toDF(*"abcde")).count() == 0
        assert out.count() == wanted.count()
    out = op.join_reference(df, ref, ("k", "r"), 10).toDF("k", "v", "s", "r", "w")
    sizes = [r["count"] for r in out.where("k = 7").groupBy(F.spark_partition_id()).count().collect()]
    assert sum(sizes) == 900 and len(sizes) > 3
    sizes = out.where("k IS NOT NULL").groupBy(F.spark_partition_id()).count().count()
    assert sizes > 16  # of some 30 parts; the session shuffles into 8
