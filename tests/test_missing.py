import math

import pytest

from millrace import operators as op

NAN = float("nan")


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [(1, 1.0, 10, "a"), (2, NAN, None, "b"), (3, None, 20, None), (4, 4.0, 10, "b"), (5, 7.0, 20, "a")],
        "id int, x double, n int, s string",
    )


def values(frame, name):
    return [r[name] for r in frame.orderBy("id").collect()]


def test_profile_counts_null_and_nan(df):
    assert op.missing_profile(df).first().asDict() == {"id": 0, "x": 2, "n": 1, "s": 1, "n_rows": 5}


def test_impute_mean_mode_and_constant_in_one_call(df):
    out = op.impute(df, {"x": "mean", "n": "mode", "s": "mode"})
    assert values(out, "x") == [1.0, 4.0, 4.0, 4.0, 7.0]
    assert values(out, "n") == [10, 10, 20, 10, 20]  # a tie: the lowest
    assert values(out, "s") == ["a", "b", "a", "b", "a"]
    assert values(op.impute(df, {"x": 0, "s": "?"}), "x") == [1.0, 0.0, 0.0, 4.0, 7.0]
    assert op.missing_profile(op.impute(df, {"x": "mean", "n": "mean", "s": "mode"})).first()[:4] == (0,) * 4


def test_statistics_of_other_rows(spark, df):
    test = spark.createDataFrame([(9, None, None, None)], df.schema)
    out = op.impute(test, {"x": "mean", "n": "mode", "s": "mode"}, fitted_on=df)
    assert out.first()[:] == (9, 4.0, 10, "a")


def test_impute_of_empty_and_all_missing(spark):
    empty = spark.createDataFrame([], "id int, x double")
    assert op.impute(empty, {"x": "mean"}).count() == 0
    unknown = spark.createDataFrame([(1, None)], "id int, x double")
    assert op.impute(unknown, {"x": "mode"}).first().x is None


def test_drop_missing(df):
    assert values(op.drop_missing(df), "id") == [1, 4, 5]
    assert values(op.drop_missing(df, ["s"]), "id") == [1, 2, 4, 5]


def test_out_of_range(spark):
    frame = spark.createDataFrame([(i, x) for i, x in enumerate([90.0, 100.0, 110.0, 130.0, None, NAN])], "id int, x double")
    assert values(op.replace_out_of_range(frame, "x", 100, over=lambda c: c > 100), "x") == [120.0, 100.0, 110.0, 130.0, 120.0, 120.0]
    assert values(op.replace_out_of_range(frame, "x", 100), "x")[0] == pytest.approx(340 / 3)
    assert values(op.replace_out_of_range(frame, "x", 100, over="all"), "x")[0] == 107.5


def test_invalid_codes(spark):
    frame = spark.createDataFrame([(i, c) for i, c in enumerate([1, 1, 3, 14, 12, None])], "id int, c int")
    out = op.replace_invalid(frame, ["c"], lambda c: c < 12, lambda c: c > 12, fill_missing=False)
    assert values(out, "c") == [1, 1, 3, 1, 12, None]
    flags = spark.createDataFrame([(i, c) for i, c in enumerate([0, 1, 1, 2, 2, 2, None])], "id int, c int")
    assert values(op.clean_binary(flags, ["c"]), "c") == [0, 1, 1, 1, 1, 1, 1]
    assert values(op.clean_binary(op.clean_binary(flags, ["c"]), ["c"]), "c") == [0, 1, 1, 1, 1, 1, 1]


def test_votes_and_row_sum(spark):
    rows = [(1, None, 1.0, 0.0), (2, None, 0.0, 0.0), (3, None, 1.0, None), (4, 1.0, 0.0, 0.0), (5, NAN, 1.0, 1.0)]
    frame = spark.createDataFrame(rows, "id int, smoke double, a double, b double")
    assert values(op.impute_from_votes(frame, "smoke", ["a", "b"]), "smoke") == [1.0, 0.0, 0.0, 1.0, 1.0]
    assert values(op.row_sum(frame, "smoke", ["a", "b"]), "smoke") == [1.0, 0.0, 1.0, 0.0, 2.0]


def test_names_with_signs(spark):
    frame = spark.createDataFrame([(1.0, None), (NAN, 2.0)], ["Malic.acid", "ekgday(day"])
    out = op.impute(frame, {"Malic.acid": "mean", "ekgday(day": "mode"})
    assert sorted(tuple(r) for r in out.collect()) == [(1.0, 2.0), (1.0, 2.0)]
    assert op.rename(frame, {"ekgday(day": "ekgday"}).columns == ["Malic.acid", "ekgday"]


def test_standard_scores(spark):
    rows = [(i, float(x), 1.0) for i, x in enumerate([1, 2, 3, 2, 1, 2, 3, 2, 100])] + [(9, None, 1.0)]
    frame = spark.createDataFrame(rows, "id int, x double, constant double")
    assert values(op.zscore_filter(frame, ["x", "constant"], 2.5), "id") == [0, 1, 2, 3, 4, 5, 6, 7, 9]
    assert values(op.zscore_filter_sequential(frame, ["x", "constant"], 2, 0.01), "id") == [0, 1, 2, 3, 4, 5, 6, 7, 9]


def test_sequential_scores_use_the_survivors(spark):
    rows = [(i, 0.0, float(i % 3)) for i in range(20)] + [(20, 50.0, 40.0), (21, 0.0, 9.0)]
    frame = spark.createDataFrame(rows, "id int, x double, y double")
    assert 21 in values(op.zscore_filter(frame, ["x", "y"], 3, ddof=1), "id")
    assert 21 not in values(op.zscore_filter_sequential(frame, ["x", "y"], 3), "id")


def test_iqr_fences(spark):
    frame = spark.createDataFrame([(i, float(x)) for i, x in enumerate([1, 2, 3, 4, 5, 100])], "id int, x double")
    assert values(op.iqr_to_null(frame, ["x"]), "x") == [1.0, 2.0, 3.0, 4.0, 5.0, None]


def test_booleans(spark):
    frame = spark.createDataFrame([(1, 0, 2), (2, 1, 1), (3, None, 0)], "id int, f int, g int")
    out = op.narrow_booleans(frame, ["f", "g"])
    assert dict(out.dtypes) == {"id": "int", "f": "boolean", "g": "int"}
    assert values(out, "f") == [False, True, None]


def test_derived(spark):
    frame = spark.createDataFrame([(1, 100_000, 0.0), (2, 3, 2.5), (3, 4, NAN)], "id int, n int, x double")
    assert values(op.pairwise(frame, ["n"], squares=True), "n_x_n")[0] == 10**10
    assert values(op.ratio(frame, "n", "x"), "ratio")[0] is None
    assert values(op.sqrt_log(frame, "x", "r"), "r")[0] is None
    assert values(op.round_columns(frame, ["x"], 0, half_even=True), "x")[1] == 2.0
    assert values(op.round_columns(frame, ["x"], 0), "x")[1] == 3.0
    scaled = op.minmax_apply(frame, op.minmax_fit(frame, ["n", "x"]), ["n", "x"])
    assert values(scaled, "n")[:2] == [1.0, 0.0] and values(scaled, "x")[:2] == [0.0, 1.0]
    constant = spark.createDataFrame([(1, 5.0), (2, 5.0)], "id int, c double")
    assert values(op.minmax_apply(constant, op.minmax_fit(constant, ["c"]), ["c"]), "c") == [0.0, 0.0]
    assert values(op.standardize(constant, ["c"]), "c") == [None, None]


def test_noise_is_normal_and_repeatable(spark):
    frame = spark.range(20000).selectExpr("id", "0.0D AS x")
    noisy = op.perturb(frame, ["x"], 2.0, "id", 1)
    mean, std = noisy.selectExpr("avg(x)", "stddev(x)").first()
    assert abs(mean) < 0.06 and abs(std - 2) < 0.06
    again = op.perturb(frame.repartition(3), ["x"], 2.0, "id", 1)
    assert noisy.exceptAll(again).count() == 0
    assert math.isclose(noisy.filter("abs(x) < 2").count() / 20000, 0.6827, abs_tol=0.015)


def test_codes(spark):
    frame = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "b"), (5, "c")], "id int, s string")
    assert values(op.label_encode(frame, ["s"]), "s_encoded") == [1, 0, None, 1, 2]
    assert values(op.string_index(frame, ["s"]), "sIndex") == [0, 1, 3, 0, 2]
