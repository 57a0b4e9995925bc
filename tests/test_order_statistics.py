"""Order statistics against brute force, on distributions that strain the buckets."""

import numpy as np
import pytest

from millrace import operators as op
from millrace.models import auc

PROBS = [0.0, 0.1, 0.25, 0.5, 0.75, 0.9, 1.0]
RNG = np.random.default_rng(5)
SAMPLES = {
    "uniform": RNG.uniform(size=5000),
    "heavy tail": RNG.standard_cauchy(5000) * 1e6,
    "one value": np.full(3000, 7.25),
    "a third one value": np.concatenate([np.full(1000, 3.0), RNG.normal(size=2000)]),
    "few values": RNG.integers(0, 4, 5000).astype(float),
    "huge and tiny": np.concatenate([RNG.uniform(size=50) * 1e-300, RNG.uniform(size=50) * 1e300]),
    "single": np.array([2.5]),
    "pair": np.array([1.0, 2.0]),
}


@pytest.mark.parametrize("name", SAMPLES)
def test_quantiles(spark, name):
    data = SAMPLES[name]
    df = spark.createDataFrame([(float(v),) for v in data], "v double").repartition(5)
    rows = op.quantiles(df, ["v"], PROBS).collect()
    assert len(rows) == len(PROBS) and {r.n for r in rows} == {len(data)}
    for r in rows:
        assert r.quantile == pytest.approx(np.quantile(data, r.prob), rel=1e-12)


def test_quantiles_by_group_with_null_group(spark):
    rows = [(g, float(v)) for g, n in (("a", 1), ("b", 2000), (None, 77)) for v in RNG.normal(size=n)]
    rows += [("c", None), ("a", float("nan"))]
    df = spark.createDataFrame(rows, "g string, v double")
    found = {(r.g, r.prob): r.quantile for r in op.quantiles(df, ["v"], [0.3, 0.99], ["g"]).collect()}
    for g in ("a", "b", None):
        data = [v for k, v in rows if k == g and v is not None and v == v]
        for p in (0.3, 0.99):
            assert found[g, p] == pytest.approx(np.quantile(data, p), rel=1e-12)
    assert len(found) == 6


def test_approximate_quantiles(spark):
    data = SAMPLES["uniform"]
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    for r in op.quantiles(df, ["v"], [0.25, 0.5], exact=False).collect():
        assert abs(r.quantile - np.quantile(data, r.prob)) < 0.01


def test_large_grid(spark):
    data = SAMPLES["heavy tail"]
    df = spark.createDataFrame([(float(v),) for v in data], "v double")
    points = op.qq_points(df, "v").orderBy("i").collect()
    expected = np.quantile(data, [i / 100 for i in range(1, 100)])
    assert [p.ordered for p in points] == pytest.approx(list(expected), rel=1e-9)
    assert points[49].theoretical == pytest.approx(0.0, abs=1e-12)


def test_running_total_over_more_values_than_bounds(spark):
    df = spark.range(10_000).selectExpr("id * 3 AS k", "id % 7 AS w").repartition(4)
    rows = op.running_total(df, "k", {"before": "w"}).orderBy("k").collect()
    total = 0
    for i, r in enumerate(rows):
        assert (r.k, r.before) == (i * 3, total)
        total += i % 7


def test_dense_codes_of_text(spark):
    words = [f"w{i * 7919 % 10007}" for i in range(6000)]
    df = spark.createDataFrame([(w,) for w in words * 2], "w string")
    codes = {r.w: r.code for r in op.dense_codes(df, "w").collect()}
    assert codes == {w: i for i, w in enumerate(sorted(set(words)))}


def test_auc_against_all_pairs(spark):
    score = np.round(RNG.normal(size=300), 1)
    label = (RNG.uniform(size=300) < 0.3).astype(int)
    pos, neg = score[label == 1], score[label == 0]
    wins = (pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()
    df = spark.createDataFrame([(float(s), int(v)) for s, v in zip(score, label)], "s double, y int")
    assert auc(df, "s", "y").first().auc == pytest.approx(wins / (len(pos) * len(neg)), rel=1e-12)
    assert auc(df.filter("y = 1"), "s", "y").first().auc is None


def test_box_stats(spark):
    data = [1.0, 2.0, 3.0, 4.0, 5.0, 30.0, -20.0]
    df = spark.createDataFrame([(v,) for v in data], "v double")
    box = op.box_stats(df, ["v"]).first()
    assert (box.q1, box.median, box.q3) == (1.5, 3.0, 4.5)
    assert (box.whisker_lo, box.whisker_hi, box.n_outliers) == (1.0, 5.0, 2)


def test_mode_takes_the_lowest_on_ties(spark):
    rows = [("x", 5), ("x", 3), ("x", 5), ("x", 3), ("y", None), ("y", 2)]
    df = spark.createDataFrame(rows, "g string, v int")
    assert {tuple(r) for r in op.mode_by_group(df, ["g"], "v").collect()} == {("x", 3), ("y", 2)}


def test_every_row_of_a_qq_plot(spark):
    from statistics import NormalDist

    data = [1.0] * 40 + [2.0, 3.5, 3.5, -1.0, 10.0]
    df = spark.createDataFrame([(v,) for v in data + [None, float("nan")]], "v double")
    rows = op.qq_rows(df, "v").orderBy("rank").collect()
    n = len(data)
    places = [1 - 0.5 ** (1 / n), *[(i - 0.3175) / (n + 0.365) for i in range(2, n)], 0.5 ** (1 / n)]
    assert [(r["rank"], r.ordered) for r in rows] == list(enumerate(sorted(data), 1))
    assert [r.theoretical for r in rows] == pytest.approx([NormalDist().inv_cdf(p) for p in places], abs=1e-7)
