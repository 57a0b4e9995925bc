"""Projections, filters and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.catalog.registry import query, table
from millrace.functions import INTEGERS


@query("""
SELECT s_suppkey::DOUBLE AS s_suppkey, trim(s_name) AS s_name, s_nationkey::DOUBLE AS s_nationkey,
       s_acctbal
FROM supplier
""")
def type_driven_cast_trim(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-number columns to double and strings trimmed, the columns picked by type."""
    return op.trim_strings(op.cast_where(table(spark, sf, "supplier"), INTEGERS, "double"))


@query("""
SELECT o_orderkey AS order_id, round(o_totalprice, 1) AS price,
       o_totalprice AS original_price, CAST(NULL AS DOUBLE) AS rate,
       CASE WHEN o_orderstatus = 'F' THEN 'done' WHEN o_orderstatus = 'O' THEN 'open'
            ELSE 'other' END AS state
FROM orders
WHERE o_totalprice BETWEEN 1000 AND 200000 AND regexp_matches(o_orderpriority, 'HIGH|URGENT')
""")
def project_rename_case(spark: SparkSession, sf: str) -> DataFrame:
    """Select, drop, rename, copy, typed null, conditional value, range and regex filters."""
    df = table(spark, sf, "orders")
    df = op.filter_contains(df, "o_orderpriority", "HIGH|URGENT", regex=True)
    df = op.filter_between(df, "o_totalprice", 1000, 200000)
    df = op.select_columns(df, ["o_orderkey", "o_totalprice", "o_orderstatus", "o_custkey"])
    df = op.copy_column(df, "o_totalprice", "original_price")
    df = op.null_column(df, "rate")
    df = op.conditional(
        df,
        "state",
        [(F.col("o_orderstatus") == "F", "done"), (F.col("o_orderstatus") == "O", "open")],
        "other",
    )
    df = op.rename(df, {"o_orderkey": "order_id", "o_totalprice": "price"})
    df = op.apply_columns(df, ["price"], lambda c: F.round(c, 1))
    return op.drop_columns(df, ["o_orderstatus", "o_custkey"])


@query("""
SELECT l_orderkey, l_linenumber, l_extendedprice / l_quantity AS ratio
FROM lineitem
WHERE l_returnflag = 'R' AND l_quantity <> 0 AND NOT l_discount > 0.08
""")
def ratio_filtered(spark: SparkSession, sf: str) -> DataFrame:
    """Quotient of two columns after an equality filter; flagged and undefined rows removed."""
    df = op.filter_equal(table(spark, sf, "lineitem"), "l_returnflag", "R")
    df = op.drop_flagged(df, F.col("l_discount") > 0.08)
    df = op.ratio(df, "l_extendedprice", "l_quantity")
    return op.filter_not_null(df, "ratio").select("l_orderkey", "l_linenumber", "ratio")


@query("""
SELECT p.p_partkey, p.p_name, p.p_size, (p_size::BIGINT * p_size) AS size_squared,
       p_retailprice * p_size AS value
FROM part p
""")
def combine_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """A table and its engineered columns, kept as two frames, side by side again."""
    part = table(spark, sf, "part")
    size = F.col("p_size").cast("bigint")
    engineered = part.select(
        "p_partkey",
        (size * size).alias("size_squared"),
        (F.col("p_retailprice") * F.col("p_size")).alias("value"),
    )
    return op.combine_columns(part.select("p_partkey", "p_name", "p_size"), engineered, ["p_partkey"])


@query("SELECT o_orderkey, o_custkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 899")
def first_n_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """The first 899 rows in key order."""
    df = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return op.first_n(df, ["o_orderkey"], 899)


@query("""
SELECT o_orderkey, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderstatus FROM orders
WHERE o_orderpriority = '1-URGENT'
UNION ALL
SELECT o_orderkey, CAST(NULL AS DOUBLE), o_orderstatus FROM orders WHERE o_orderpriority = '2-HIGH'
""")
def union_sources(spark: SparkSession, sf: str) -> DataFrame:
    """Two frames with different columns under one another, matched by column name."""
    orders = table(spark, sf, "orders")
    urgent = op.filter_equal(orders, "o_orderpriority", "1-URGENT")
    high = op.filter_equal(orders, "o_orderpriority", "2-HIGH")
    return op.union_all(
        [urgent.select("o_orderkey", "o_totalprice"), high.select("o_orderkey", "o_orderstatus")]
    )


@query("""
SELECT o_custkey, o_orderkey, o_orderdate, o_totalprice FROM orders
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) = 1
""")
def dedup_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    """The first order of each customer."""
    df = table(spark, sf, "orders").select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")
    return op.dedup_first(df, ["o_custkey"], ["o_orderdate", "o_orderkey"])


@query("SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem")
def distinct_values(spark: SparkSession, sf: str) -> DataFrame:
    return op.distinct_values(table(spark, sf, "lineitem"), "l_returnflag", "l_linestatus")
