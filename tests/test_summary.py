"""Kept summaries: adding them up, and exact quantiles with their help."""

import math
import random
import statistics

import pytest
from compare import physical_plan
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.operators import summary as kept

PROBS = [0.0, 0.25, 0.5, 0.99, 1.0]


def quantile(values, p):
    values = sorted(values)
    at = p * (len(values) - 1)
    low, high = values[math.floor(at)], values[math.ceil(at)]
    return low if low == high else low + (high - low) * (at - math.floor(at))


def data(spark):
    chance = random.Random(7)
    rows = []
    for i in range(6000):
        even = chance.gauss(1e6, 2.0)
        often = 3.0 if chance.random() < 0.4 else float(chance.randrange(50))
        rows.append((["a", "b", None][i % 3], even, None if i % 5 == 0 else often, None, math.inf if i < 40 else -float(i)))
    return spark.createDataFrame(rows, "g string, even double, often double, none double, wide double").repartition(5), rows


def test_quantiles_and_moments(spark):
    df, rows = data(spark)
    cols = ["even", "often", "none", "wide"]
    summary = op.summarise(df, cols)
    found = {(r["column"], r["prob"]): r["quantile"] for r in op.exact_quantiles(df, summary, cols, PROBS).collect()}
    for i, c in ((1, "even"), (2, "often"), (4, "wide")):
        values = [r[i] for r in rows if r[i] is not None]
        assert [found[c, p] for p in PROBS] == [pytest.approx(quantile(values, p), rel=1e-15) for p in PROBS]
    assert not any(c == "none" for c, _ in found)
    described = {r["column"]: r for r in op.describe(df, cols).collect()}
    assert described["none"]["count"] == 0 and described["none"]["std"] is None and described["none"]["median"] is None
    assert described["even"]["std"] == pytest.approx(statistics.stdev(r[1] for r in rows), rel=1e-9)


def test_merged_parts_equal_the_whole(spark):
    df, rows = data(spark)
    cols = ["even", "often", "none"]
    parts = op.summarise(df.where("g = 'a'"), cols, ["g"]).unionByName(op.summarise(df.where("g = 'b' OR g IS NULL"), cols, ["g"]))
    merged = op.merge(parts)
    want = {r["column"]: r for r in op.summarise(df, cols).drop("sketch").collect()}
    for r in merged.drop("sketch").collect():
        w = want[r["column"]]
        assert (r["n"], r["min"], r["max"]) == (w["n"], w["min"], w["max"])
        if r["n"]:
            assert r["mean"] == pytest.approx(w["mean"], rel=1e-14) and r["m2"] == pytest.approx(w["m2"], rel=1e-8)
    found = {(r["column"], r["prob"]): r["quantile"] for r in op.exact_quantiles(df, merged, cols, PROBS).collect()}
    assert found["even", 0.5] == pytest.approx(quantile([r[1] for r in rows], 0.5), rel=1e-15)
    by_group = {(r["g"], r["column"]): r["n"] for r in op.merge(parts, ["g"]).collect()}
    assert by_group[None, "even"] == 2000 and len(by_group) == 9


def test_by_group_with_nulls(spark):
    df, rows = data(spark)
    summary = op.summarise(df, ["often"], ["g"])
    found = {(r["g"], r["prob"]): r["quantile"] for r in op.exact_quantiles(df, summary, ["often"], PROBS, ["g"]).collect()}
    for g in ("a", "b", None):
        values = [r[2] for r in rows if r[0] == g and r[2] is not None]
        assert [found[g, p] for p in PROBS] == [pytest.approx(quantile(values, p)) for p in PROBS]


def test_a_summary_of_other_rows_does_no_harm(spark):
    """Ranks outside of the brackets are noticed, and the quantiles found without them."""
    df, rows = data(spark)
    wrong = op.summarise(df.where("even < 1000000"), ["even"])
    found = {r["prob"]: r["quantile"] for r in op.exact_quantiles(df, wrong, ["even"], PROBS).collect()}
    assert found[0.5] == pytest.approx(quantile([r[1] for r in rows], 0.5), rel=1e-15)
    assert found[0.99] == pytest.approx(quantile([r[1] for r in rows], 0.99), rel=1e-15)


def test_sketches_alone(spark):
    df, rows = data(spark)
    found = {r["prob"]: r["quantile"] for r in op.sketched_quantiles(op.summarise(df, ["even"]), [0.5]).collect()}
    values = sorted(r[1] for r in rows)
    assert abs(sum(v < found[0.5] for v in values) - 3000) <= 3 * kept.MARGIN * 6000 + 1


def test_one_scan_for_a_summary_and_one_for_quantiles(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    assert physical_plan(op.summarise(df)).count("FileScan") == 1
    summary = op.summarise(df, ["l_tax"])
    path = f"{spark.conf.get('spark.checkpoint.dir')}/summary-of-a-test"
    summary.write.mode("overwrite").parquet(path)
    plan = physical_plan(op.describe(df, ["l_tax"], summary=spark.read.parquet(path)))
    assert "lineitem" not in plan  # what is left reads the written counts


def test_no_rows(spark):
    df = spark.createDataFrame([], "a double, b int")
    got = {r["column"]: (r["count"], r["mean"], r["q1"]) for r in op.describe(df).collect()}
    assert got == {"a": (0, None, None), "b": (0, None, None)}
    assert op.describe(df.select(F.col("a").alias("x y")), ["x y"]).count() == 1
