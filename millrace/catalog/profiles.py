"""Summaries and the numbers behind exploratory plots."""

from __future__ import annotations

from statistics import NormalDist

from pyspark.sql import DataFrame, SparkSession

from millrace import operators as op
from millrace.catalog.registry import query, table
from millrace.operators.profile import (
    SCORE_A,
    SCORE_B,
    SCORE_C,
    SCORE_D,
    SCORE_TAIL,
    normal_grid,
)
from millrace.sources.scratch import written

_NUMERIC = ["l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _described(c: str) -> str:
    return f"""SELECT '{c}' AS "column", count({c}) AS "count", round(avg({c}), 4) AS mean,
       round(stddev_samp({c}), 4) AS std, min({c})::DOUBLE AS "min",
       round(quantile_cont({c}, 0.25), 4) AS q1, round(quantile_cont({c}, 0.5), 4) AS median,
       round(quantile_cont({c}, 0.75), 4) AS q3, max({c})::DOUBLE AS "max" FROM lineitem"""


@query(" UNION ALL ".join(_described(c) for c in _NUMERIC))
def describe_numeric(spark: SparkSession, sf: str) -> DataFrame:
    df = op.describe(table(spark, sf, "lineitem"), _NUMERIC)
    return op.round_columns(df, ["mean", "std", "q1", "median", "q3"], 4)


@query(" UNION ALL ".join(_described(c) for c in _NUMERIC))
def describe_merged(spark: SparkSession, sf: str) -> DataFrame:
    """The same numbers from kept summaries of the parts by return flag, added up."""
    df = table(spark, sf, "lineitem")
    parts = written(op.summarise(df, _NUMERIC, ["l_returnflag"]), "summary")
    whole = written(op.merge(parts), "summary")
    return op.round_columns(op.describe(df, _NUMERIC, summary=whole), ["mean", "std", "q1", "median", "q3"], 4)


@query("""
SELECT l_returnflag, 0.1::DOUBLE AS prob, round(quantile_cont(l_extendedprice, 0.1), 6) AS quantile
FROM lineitem GROUP BY 1
UNION ALL
SELECT l_returnflag, 0.99::DOUBLE, round(quantile_cont(l_extendedprice, 0.99), 6)
FROM lineitem GROUP BY 1
""")
def quantiles_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """Exact quantiles of a column with many distinct values, per group."""
    df = op.quantiles(table(spark, sf, "lineitem"), ["l_extendedprice"], [0.1, 0.99], ["l_returnflag"])
    return op.round_columns(df.drop("column", "n"), ["quantile"], 6)


@query("""
WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
                  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
v AS (SELECT event_type, q1, median, q3, value,
             value BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE AS inside
      FROM events JOIN q USING (event_type))
SELECT event_type, 'value' AS "column", round(q1, 6) AS q1, round(median, 6) AS median,
       round(q3, 6) AS q3, round(least(min(value) FILTER (inside), q1), 6) AS whisker_lo,
       round(greatest(max(value) FILTER (inside), q3), 6) AS whisker_hi,
       count(*) FILTER (NOT inside) AS n_outliers
FROM v GROUP BY v.event_type, v.q1, v.median, v.q3
""")
def box_stats(spark: SparkSession, sf: str) -> DataFrame:
    df = op.box_stats(table(spark, sf, "events"), ["value"], ["event_type"])
    return op.round_columns(df, ["q1", "median", "q3", "whisker_lo", "whisker_hi"], 6)


_GRID = ", ".join(f"({i}::INTEGER, {z!r}::DOUBLE)" for i, z in enumerate(normal_grid(99), 1))
_PROBS = "[" + ", ".join(repr(i / 100) for i in range(1, 100)) + "]"
_QQ = f"""
SELECT g.i, g.z AS theoretical, q.v[g.i] AS ordered
FROM (VALUES {_GRID}) AS g(i, z), (SELECT quantile_cont(value, {_PROBS}) AS v FROM events) q
"""


@query(f"SELECT i, round(theoretical, 9) AS theoretical, round(ordered, 6) AS ordered FROM ({_QQ})")
def qq_points(spark: SparkSession, sf: str) -> DataFrame:
    df = op.round_columns(op.qq_points(table(spark, sf, "events"), "value"), ["theoretical"], 9)
    return op.round_columns(df, ["ordered"], 6)


def _poly_sql(x: str, numbers: list[float]) -> str:
    total = repr(numbers[0]) + "::DOUBLE"
    for c in numbers[1:]:
        total = f"({total} * {x} + {c!r}::DOUBLE)"
    return total


_QQ_ROWS = f"""
SELECT rank, ordered, CASE
    WHEN p < {SCORE_TAIL}::DOUBLE THEN {_poly_sql("s", [*SCORE_C])} / {_poly_sql("s", [*SCORE_D, 1.0])}
    WHEN p > 1 - {SCORE_TAIL}::DOUBLE THEN -{_poly_sql("s", [*SCORE_C])} / {_poly_sql("s", [*SCORE_D, 1.0])}
    ELSE {_poly_sql("r", [*SCORE_A])} * q / {_poly_sql("r", [*SCORE_B, 1.0])} END AS theoretical
FROM (SELECT *, p - 0.5::DOUBLE AS q, (p - 0.5::DOUBLE) * (p - 0.5::DOUBLE) AS r,
             sqrt(-2 * ln(least(p, 1 - p))) AS s
      FROM (SELECT rank, ordered, CASE WHEN rank = n THEN pow(0.5::DOUBLE, 1.0::DOUBLE / n)
                   WHEN rank = 1 THEN 1 - pow(0.5::DOUBLE, 1.0::DOUBLE / n)
                   ELSE (rank - 0.3175::DOUBLE) / (n + 0.365::DOUBLE) END AS p
            FROM (SELECT value AS ordered, row_number() OVER (ORDER BY value) AS rank, count(*) OVER () AS n
                  FROM events WHERE value IS NOT NULL)))
"""


@query(f"SELECT rank, round(theoretical, 6) AS theoretical, ordered FROM ({_QQ_ROWS})")
def qq_all_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every value with its rank and the normal quantile of its plotting position."""
    return op.round_columns(op.qq_rows(table(spark, sf, "events"), "value"), ["theoretical"], 6)


@query(f"""
SELECT round(regr_slope(ordered, theoretical), 6) AS slope,
       round(regr_intercept(ordered, theoretical), 6) AS intercept,
       round(corr(ordered, theoretical), 6) AS r FROM ({_QQ_ROWS})
""")
def qq_line(spark: SparkSession, sf: str) -> DataFrame:
    """The line through all points of the Q-Q plot."""
    df = op.qq_line(op.qq_rows(table(spark, sf, "events"), "value"))
    return op.round_columns(df, df.columns, 6)


@query("""
SELECT count(*) AS n, round(corr(l_quantity, l_extendedprice), 6) AS corr,
       round(avg(l_quantity), 6) AS mean_x, round(avg(l_extendedprice), 4) AS mean_y,
       round(regr_slope(l_extendedprice, l_quantity), 4) AS slope,
       round(regr_intercept(l_extendedprice, l_quantity), 4) AS intercept
FROM lineitem
""")
def pair_correlation(spark: SparkSession, sf: str) -> DataFrame:
    df = op.pair_stats(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice")
    df = op.round_columns(df, ["corr", "mean_x"], 6)
    return op.round_columns(df, ["mean_y", "slope", "intercept"], 4)


@query("""
SELECT floor(l_quantity / 10) * 10 AS x_bin, floor(l_extendedprice / 10000) * 10000 AS y_bin,
       count(*) AS n
FROM lineitem GROUP BY 1, 2
""")
def pair_binned_counts(spark: SparkSession, sf: str) -> DataFrame:
    return op.binned_counts(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 10, 10000)


_Z = NormalDist().inv_cdf(0.975)


@query(f"""
SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean,
       round(stddev_pop(value), 6) AS std,
       round(stddev_pop(value) / sqrt(count(value)), 6) AS std_error,
       round(avg(value) - stddev_pop(value) / sqrt(count(value)) * {_Z!r}::DOUBLE, 6) AS ci_lo,
       round(avg(value) + stddev_pop(value) / sqrt(count(value)) * {_Z!r}::DOUBLE, 6) AS ci_hi
FROM events GROUP BY 1
""")
def mean_confidence_interval(spark: SparkSession, sf: str) -> DataFrame:
    df = op.mean_ci(table(spark, sf, "events"), "value", ["event_type"])
    return op.round_columns(df, ["mean", "std", "std_error", "ci_lo", "ci_hi"], 6)
