"""Physical plans: what must not be in them at scale, and what must."""

import re

from compare import physical_plan

from millrace import operators as op


def test_statistics_are_subqueries_not_joins(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    rules = {"value": op.in_range(0, 150), "event_type": op.Repair("mode")}
    text = physical_plan(op.repair(df, rules))
    assert "Join" not in text
    assert text.count("Subquery subquery") >= 2


def test_columns_and_filters_reach_the_scan(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    text = physical_plan(op.group_avg(op.filter_equal(df, "l_returnflag", "R"), ["l_linestatus"], "l_tax"))
    assert "EqualTo(l_returnflag,R)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert sorted(c.split(":")[0] for c in schema.split(",")) == ["l_linestatus", "l_returnflag", "l_tax"]


def test_outer_join_with_a_small_reference_does_not_shuffle_the_rows(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/customer.parquet")
    ref = spark.createDataFrame([("BUILDING", 1.0)], "segment string, share double")
    text = physical_plan(op.join_reference(df, ref, ("c_mktsegment", "segment")))
    assert "SortMergeJoin" not in text and "FullOuter" not in text
    big = physical_plan(op.join_reference(df, ref, ("c_mktsegment", "segment"), max_rows=0))
    assert "LeftOuter" in big and "FullOuter" not in big


def test_only_small_tables_are_broadcast(spark, sf_dir):
    """Above its limit a per-group table is left to the planner, and the result is the same."""
    from millrace.operators import sizes

    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    assert sizes.few_groups(df, ["event_type"]) and sizes.few_groups(df, [])
    assert not sizes.fits_broadcast(df.select("event_id"), rows=10)
    assert not sizes.fits_broadcast(df.select("event_id"), size=100)


def test_quantiles_without_broadcast(spark, sf_dir, monkeypatch):
    from millrace.operators import order_statistics

    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    wanted = {tuple(r) for r in op.quantiles(df, ["value"], [0.2, 0.7], ["event_type"]).collect()}
    monkeypatch.setattr(order_statistics, "few_groups", lambda *_: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = op.quantiles(df, ["value"], [0.2, 0.7], ["event_type"])
        assert "SortMergeJoin" in physical_plan(found)
        assert {tuple(r) for r in found.collect()} == wanted
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_box_stats_without_broadcast(spark, sf_dir, monkeypatch):
    from millrace.operators import profile

    df = spark.read.parquet(f"{sf_dir}/events.parquet")
    wanted = {tuple(r) for r in op.box_stats(df, ["value"], ["event_type"]).collect()}
    monkeypatch.setattr(profile, "few_groups", lambda *_: False)
    assert {tuple(r) for r in op.box_stats(df, ["value"], ["event_type"]).collect()} == wanted


def test_deduplication_reduces_before_the_shuffle(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    text = physical_plan(op.dedup_first(df, ["o_custkey"], ["o_orderdate", "o_orderkey"]))
    assert "Window" not in text and "partial_min" in text


def test_stratified_split_does_not_shuffle_the_rows(spark):
    df = spark.range(1000).selectExpr("id", "id % 3 AS label", "repeat('x', 50) AS payload")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = physical_plan(op.stratified_column(df, "label", 0.1, "id", 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" not in text and text.count("BroadcastHashJoin") == 2
