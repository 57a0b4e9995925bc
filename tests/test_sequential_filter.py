"""The sequential filter from moments that are brought up to date, against one pass a column."""

import random

import pytest
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.operators import outliers

COLS = ["a", "b", "c", "d"]


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.fixture
def counted(monkeypatch):
    """How often all rows were looked at for moments or candidates."""
    calls = []
    stored = outliers._stored
    monkeypatch.setattr(outliers, "_stored", lambda df: (calls.append(1), stored(df))[1])
    return calls


def frame(spark, spread):
    rnd = random.Random(2)
    rows = []
    for i in range(600):
        row = [rnd.gauss(0, 1) for _ in COLS]
        if i % 40 == 0:
            row[i // 40 % 4] *= spread
        if i % 50 == 7:
            row[i // 50 % 4] = rnd.choice([None, float("nan")])
        rows.append((i, *row))
    return spark.createDataFrame(rows, "id int, a double, b double, c double, d double")


@pytest.mark.parametrize("spread", [1, 6])
@pytest.mark.parametrize("ddof", [0, 1])
def test_same_rows_from_two_scans(spark, counted, spread, ddof):
    df = frame(spark, spread)
    found = ids(op.zscore_filter_sequential(df, COLS, 3, 0.01, ddof))
    assert found == ids(outliers._sequential_by_passes(df, COLS, 3, 0.01, ddof)) and len(found) < 600
    assert len(counted) == 1


def test_far_outliers_start_again(spark, counted):
    """One value takes nearly the whole sum of squares along: too few digits are left without it."""
    df = frame(spark, 1e9).withColumn("b", F.when(F.abs("a") > 1e6, F.col("a")).when(F.abs("b") < 1e6, F.col("b")))
    assert ids(op.zscore_filter_sequential(df, COLS, 3, 0.01)) == ids(outliers._sequential_by_passes(df, COLS, 3, 0.01, 1))
    assert len(counted) > 1


def test_far_from_zero_constant_and_no_rows(spark):
    df = frame(spark, 6).withColumn("a", F.col("a") + 1e6).withColumn("c", F.lit(2.0))
    for threshold, tolerance in ((2, 0.0), (1, 0.5), (0, 0.0), (3, -1.0)):
        want = ids(outliers._sequential_by_passes(df, COLS, threshold, tolerance, 1))
        assert ids(op.zscore_filter_sequential(df, COLS, threshold, tolerance)) == want
    none = df.limit(0)
    assert op.zscore_filter_sequential(none, COLS, 3).count() == 0
    assert op.zscore_filter_sequential(df, [], 3).count() == 600
    alone = df.select("id", F.when(F.col("id") < 1, 1.0).alias("a"))
    assert op.zscore_filter_sequential(alone, ["a"], 3).count() == 600
