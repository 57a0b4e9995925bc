"""Cleaning steps by level: the same as one operator after the other, with plans that stay small."""

import random
import time

import pytest
from compare import physical_plan
from pyspark.sql import functions as F

from millrace import operators as op


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("chain") / "rows")
    df = spark.range(400).select(
        "id",
        F.when(F.col("id") % 11 > 0, (F.col("id") * 7919 % 1009).cast("double")).alias("x"),
        F.when(F.col("id") % 13 == 0, float("nan")).otherwise((F.col("id") * 104729 % 503) / 7).alias("y"),
        F.when(F.col("id") % 5 > 0, F.col("id") % 4).alias("k"),
    )
    df.write.parquet(path)
    return spark.read.parquet(path)


def one_by_one(df, steps):
    """Each step by its own operator, on collected rows."""
    for step in steps:
        if isinstance(step, op.Fill):
            df = op.repair(df, step.rules)
        elif isinstance(step, op.Fence):
            df = op.iqr_to_null(df, step.cols, step.factor)
        elif isinstance(step, op.Scale):
            df = op.standardize(df, step.cols, ddof=step.ddof)
        else:
            df = op.zscore_filter(df, step.cols, step.threshold, step.ddof)
        df = df.sparkSession.createDataFrame(df.collect(), df.schema)
    return df


def drawn_step(rnd):
    cols = rnd.sample(["x", "y"], rnd.randint(1, 2))
    return rnd.choice([
        op.Fill({c: op.in_range(rnd.randint(0, 20), rnd.randint(40, 900), over=rnd.choice(["in_range", "all"])) for c in cols}),
        op.Fill({"k": rnd.choice([op.binary_flag(), op.Repair("mode"), op.Repair(3)]), cols[0]: op.Repair("mean")}),
        op.Fence(cols, rnd.choice([0.3, 1.5])),
        op.Scale(cols),
        op.DropUnusual(cols, rnd.choice([1.0, 1.6]), rnd.randint(0, 1)),
    ])


@pytest.mark.parametrize("seed", range(3))
def test_same_as_one_operator_after_the_other(table, seed):
    rnd = random.Random(seed)
    steps = [drawn_step(rnd) for _ in range(6)]

    def rows(df):
        return [tuple(v if v is None or isinstance(v, int) else round(v, 7) for v in r) for r in sorted(df.collect())]

    assert rows(op.chain(table, steps)) == rows(one_by_one(table, steps))


def test_eight_steps_on_one_column_scan_the_table_nine_times(spark, table):
    steps = [op.Fill({"x": op.in_range(i, 900 - 40 * i)}) for i in range(8)]
    assert [list(level.changes) for level in op.plan_levels(steps)] == [["x"]] * 8
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("chain", "eight levels")
    start = time.perf_counter()
    cleaned = op.chain(table, steps)
    called = time.perf_counter() - start
    jobs = len(tracker.getJobIdsForGroup("chain"))
    spark.sparkContext.setJobGroup("", "")
    assert physical_plan(cleaned).count("Scan parquet") == 1 and "Subquery" not in physical_plan(cleaned)
    assert 8 <= jobs <= 24 and called < 30  # an aggregate is a job of its scan, and one or two behind it
    start = time.perf_counter()
    cleaned._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 1


def test_levels_by_dependency():
    def columns(steps):
        return [(sorted(level.changes), level.drop is not None) for level in op.plan_levels(steps)]

    fill = {"x": op.Repair("mean")}
    assert columns([op.Fill(fill), op.Fill({"y": op.Repair("mode")}), op.Fence(["z"])]) == [(["x", "y", "z"], False)]
    assert columns([op.Fill(fill), op.Fence(["x", "y"])]) == [(["x", "y"], False), (["x"], False)]
    assert columns([op.Fill(fill), op.DropUnusual(["y"], 2.0), op.Fence(["y"])]) == [(["x"], True), (["y"], False)]
    assert columns([op.Fill(fill), op.DropUnusual(["x"], 2.0)]) == [(["x"], False), ([], True)]
    assert columns([]) == []


def test_no_rows_and_constants(table):
    none = table.limit(0)
    steps = [op.Fill({"x": op.Repair("mean"), "k": op.Repair("mode")}), op.Fence(["x"]), op.Scale(["x"]), op.DropUnusual(["x"], 1.0)]
    assert op.chain(none, steps).count() == 0
    same = table.withColumn("x", F.lit(5.0))
    assert op.chain(same, steps).where("x IS NULL").count() == 400
    assert op.chain(table, []).exceptAll(table).count() == 0
