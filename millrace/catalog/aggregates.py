"""Grouped and global aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.catalog.registry import LABELLED, labelled, query, table


@query("""
SELECT word, count(*) AS n FROM (SELECT unnest(string_split(text, ' ')) AS word FROM documents)
GROUP BY word HAVING count(*) >= 3
""")
def word_count_min3(spark: SparkSession, sf: str) -> DataFrame:
    """Words that occur at least three times."""
    return op.word_count(table(spark, sf, "documents"), "text", min_count=3)


@query("""
SELECT c_mktsegment, round(avg(c_acctbal), 6) AS average_c_acctbal FROM customer GROUP BY 1
""")
def group_avg(spark: SparkSession, sf: str) -> DataFrame:
    df = op.group_avg(table(spark, sf, "customer"), ["c_mktsegment"], "c_acctbal")
    return op.round_columns(df, ["average_c_acctbal"], 6)


@query("""
SELECT l_returnflag, (count(*) FILTER (l_linestatus = 'F'))::DOUBLE / count(*) AS rate
FROM lineitem GROUP BY 1
""")
def group_rate(spark: SparkSession, sf: str) -> DataFrame:
    return op.group_rate(table(spark, sf, "lineitem"), ["l_returnflag"], F.col("l_linestatus") == "F")


@query(f"""
SELECT lang, sum(quality)::DOUBLE / count(*) AS mean_all_rows FROM {LABELLED} GROUP BY 1
""")
def group_mean_all_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Sum over all rows, those without a value counted in the denominator."""
    return op.group_mean_all_rows(labelled(spark, sf), ["lang"], "quality")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def value_counts(spark: SparkSession, sf: str) -> DataFrame:
    return op.value_counts(table(spark, sf, "events"), "event_type")


@query("""
SELECT event_type, count(*) AS n FROM events GROUP BY 1 ORDER BY n DESC, event_type LIMIT 1
""")
def value_counts_top(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent event type."""
    return op.top_group(table(spark, sf, "events"), "event_type")


@query("""
SELECT user_id, event_type AS mode FROM (SELECT user_id, event_type, count(*) AS n FROM events
GROUP BY ALL) QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, event_type) = 1
""")
def mode_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """The most frequent event type of each user."""
    return op.mode_by_group(table(spark, sf, "events"), ["user_id"], "event_type")


@query("""
SELECT 'o_orderstatus' AS "column", count(DISTINCT o_orderstatus) AS n_distinct FROM orders
UNION ALL SELECT 'o_orderpriority', count(DISTINCT o_orderpriority) FROM orders
UNION ALL SELECT 'o_custkey', count(DISTINCT o_custkey) FROM orders
""")
def distinct_counts(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["o_orderstatus", "o_orderpriority", "o_custkey"]
    return op.distinct_counts(table(spark, sf, "orders"), cols)


@query("""
SELECT round(avg(value), 6) AS overall, round(avg(value) FILTER (value > 100), 6) AS above_100,
       round(avg(value) FILTER (value BETWEEN 0 AND 150), 6) AS in_range
FROM events
""")
def conditional_means(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    df = op.conditional_means(
        table(spark, sf, "events"),
        "value",
        {"overall": F.lit(True), "above_100": value > 100, "in_range": value.between(0, 150)},
    )
    return op.round_columns(df, df.columns, 6)


@query("SELECT count(*) AS n FROM lineitem")
def row_count(spark: SparkSession, sf: str) -> DataFrame:
    return op.row_count(table(spark, sf, "lineitem"))
