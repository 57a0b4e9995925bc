"""Numbers behind the usual exploratory plots and summaries."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import NUMERICS, col, columns_of, present, quoted
from millrace.operators.order_statistics import SALTS, quantiles, running_total, unpivot_doubles
from millrace.operators.sizes import few_groups
from millrace.operators.statistics import stat, with_stats
from millrace.operators.summary import exact_quantiles, sketched_quantiles, summarise
from millrace.sources.scratch import written

QUARTILES = {"q1": 0.25, "median": 0.5, "q3": 0.75}

# Coefficients of Acklam's approximation of the normal quantile.
SCORE_A = (-3.969683028665376e01, 2.209460984245205e02, -2.759285104469687e02,
           1.383577518672690e02, -3.066479806614716e01, 2.506628277459239e00)
SCORE_B = (-5.447609879822406e01, 1.615858368580409e02, -1.556989798598866e02,
           6.680131188771972e01, -1.328068155288572e01)
SCORE_C = (-7.784894002430293e-03, -3.223964580411365e-01, -2.400758277161838e00,
           -2.549732539343734e00, 4.374664141464968e00, 2.938163982698783e00)
SCORE_D = (7.784695709041462e-03, 3.224671290700398e-01, 2.445134137142996e00,
           3.754408661907416e00)
SCORE_TAIL = 0.02425


def _quartiles(
    df: DataFrame, cols: Sequence[str], by: Sequence[str], exact: bool, small: bool
) -> DataFrame:
    """Rows (by..., column, q1, median, q3)."""
    table = quantiles(df, cols, list(QUARTILES.values()), by, exact, small)
    return table.groupBy(*[col(b) for b in by], "column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in QUARTILES.items()]
    )


def describe(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    exact: bool = True,
    summary: DataFrame | None = None,
) -> DataFrame:
    """Rows (column, count, mean, std, min, q1, median, q3, max); sample deviation.

    Two scans: one for the summary, one for the exact quartiles. A kept `summary` of all rows
    (`summarise`, `merge`) saves the first; with `exact=False` its sketches save the second.
    """
    cols = list(cols) if cols is not None else columns_of(df, NUMERICS)
    if summary is None:
        summary = written(summarise(df, cols), "summary")
    probs = list(QUARTILES.values())
    table = exact_quantiles(df, summary, cols, probs) if exact else sketched_quantiles(summary, probs)
    quartiles = table.groupBy("column").agg(
        *[F.max(F.when(F.col("prob") == p, F.col("quantile"))).alias(n) for n, p in QUARTILES.items()]
    )
    return (
        summary.where(F.col("column").isin(cols))
        .withColumn("std", F.when(F.col("n") > 1, F.sqrt(F.col("m2") / (F.col("n") - 1))))
        .withColumnRenamed("n", "count")
        .join(quartiles, "column", "left")
        .select("column", "count", "mean", "std", "min", "q1", "median", "q3", "max")
    )


def box_stats(
    df: DataFrame,
    cols: Sequence[str],
    by: Sequence[str] = (),
    factor: float = 1.5,
    exact: bool = True,
) -> DataFrame:
    """Rows (by..., column, q1, median, q3, whisker_lo, whisker_hi, n_outliers).

    A whisker ends at the most extreme value within `factor` inter-quartile ranges of the
    box; the values beyond the whiskers are the outliers.
    """
    long = unpivot_doubles(df, cols, by).filter(F.col("value").isNotNull())
    small = few_groups(df, by)
    box = _quartiles(df, cols, by, exact, small)
    keys = [*by, "column"]
    same = [F.col(f"v.{quoted(k)}").eqNullSafe(F.col(f"b.{quoted(k)}")) for k in keys]
    if small:
        long, box = long.withColumn("w", F.lit(1)), F.broadcast(box)
    else:  # count equal values first, and spread each group by value
        salt = F.pmod(F.xxhash64("value"), F.lit(SALTS))
        long = long.groupBy(*[col(k) for k in keys], "value").agg(F.count("*").alias("w"))
        long = long.withColumn("salt", salt)
        box = box.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        same.append(F.col("v.salt") == F.col("b.salt"))
    margin = (F.col("q3") - F.col("q1")) * factor
    over, under = F.col("value") > F.col("q3") + margin, F.col("value") < F.col("q1") - margin
    inside = F.when(~over & ~under, F.col("value"))
    reduced = (
        long.alias("v")
        .join(box.alias("b"), same)
        .groupBy(*[F.col(f"b.{quoted(k)}").alias(k) for k in keys], *QUARTILES)
        .agg(
            F.min(inside).alias("lo"),
            F.max(inside).alias("hi"),
            F.sum(F.when(over | under, F.col("w")).otherwise(0)).alias("n_outliers"),
        )
    )
    return reduced.select(
        *[col(k) for k in keys],
        *QUARTILES,
        F.least("lo", "q1").alias("whisker_lo"),
        F.greatest("hi", "q3").alias("whisker_hi"),
        "n_outliers",
    )


def normal_grid(grid: int) -> list[float]:
    """Standard normal quantiles at i / (grid + 1), i from 1 to grid."""
    return [NormalDist().inv_cdf(i / (grid + 1)) for i in range(1, grid + 1)]


def qq_points(df: DataFrame, name: str, grid: int = 99, exact: bool = True) -> DataFrame:
    """Rows (i, theoretical, ordered): normal quantiles against the column's own, on a grid.

    A summary of fixed size for a plot; `qq_rows` has every row.
    """
    table = quantiles(df, [name], [i / (grid + 1) for i in range(1, grid + 1)], exact=exact)
    i = F.round(F.col("prob") * (grid + 1)).cast("int")
    normal = F.array(*[F.lit(z) for z in normal_grid(grid)])
    return table.select(
        i.alias("i"), F.element_at(normal, i).alias("theoretical"), F.col("quantile").alias("ordered")
    )


def normal_score(p: Column) -> Column:
    """The standard normal quantile of a probability, to a relative error of 1.2e-9.

    Acklam's rational approximation: one for the middle, one for both tails.
    """

    def poly(x: Column, numbers: Sequence[float]) -> Column:
        return reduce(lambda total, c: total * x + c, numbers[1:], F.lit(numbers[0]))

    q = p - 0.5
    r = q * q
    middle = poly(r, SCORE_A) * q / poly(r, [*SCORE_B, 1.0])
    s = F.sqrt(-2 * F.log(F.least(p, 1 - p)))
    tail = poly(s, SCORE_C) / poly(s, [*SCORE_D, 1.0])
    return F.when(p < SCORE_TAIL, tail).when(p > 1 - SCORE_TAIL, -tail).otherwise(middle)


def qq_rows(df: DataFrame, name: str) -> DataFrame:
    """Rows (rank, theoretical, ordered), one for every present value of a column.

    The plotting positions are the medians of order statistics: 1 - 0.5^(1/n) and 0.5^(1/n) at
    the ends, (rank - 0.3175) / (n + 0.365) between. Equal values are counted in parts before
    they are ranked, and rows are made of the counts, so no value gathers in one task.
    """
    value = present(df, name).cast("double")
    part = F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)).cast("int")
    parts = df.select(value.alias("value"), part.alias("part")).filter(F.col("value").isNotNull())
    counted = parts.groupBy("value", "part").agg(F.count("*").alias("size"))
    counted = counted.select(F.struct("value", "part").alias("order"), "size")
    ranked = with_stats(running_total(counted, "order", {"below": "size"}), df.agg(F.count(value).alias("n")))
    rows = ranked.select(
        F.col("order.value").alias("ordered"),
        stat("n").alias("n"),
        F.explode(F.sequence(F.col("below") + 1, F.col("below") + F.col("size"))).alias("rank"),
    )
    end = F.pow(F.lit(0.5), F.lit(1.0) / F.col("n"))
    between = (F.col("rank") - 0.3175) / (F.col("n") + 0.365)
    p = F.when(F.col("rank") == F.col("n"), end).when(F.col("rank") == 1, 1 - end).otherwise(between)
    return rows.select("rank", normal_score(p).alias("theoretical"), "ordered")


def qq_line(points: DataFrame) -> DataFrame:
    """One row: least-squares slope, intercept and correlation of Q-Q points."""
    return points.agg(
        F.regr_slope("ordered", "theoretical").alias("slope"),
        F.regr_intercept("ordered", "theoretical").alias("intercept"),
        F.corr("theoretical", "ordered").alias("r"),
    )


def pair_stats(df: DataFrame, x: str, y: str) -> DataFrame:
    """One row on how two columns go together, over the rows where both are present."""
    both = df.select(present(df, x).cast("double").alias("x"), present(df, y).cast("double").alias("y"))
    return both.filter(F.col("x").isNotNull() & F.col("y").isNotNull()).agg(
        F.count("*").alias("n"),
        F.corr("x", "y").alias("corr"),
        F.avg("x").alias("mean_x"),
        F.avg("y").alias("mean_y"),
        F.regr_slope("y", "x").alias("slope"),
        F.regr_intercept("y", "x").alias("intercept"),
    )


def binned_counts(df: DataFrame, x: str, y: str, x_width: float, y_width: float) -> DataFrame:
    """Rows per cell of a grid over two columns: (x_bin, y_bin, n), bins by lower edge."""
    x_bin = F.floor(present(df, x) / x_width) * x_width
    y_bin = F.floor(present(df, y) / y_width) * y_width
    both = present(df, x).isNotNull() & present(df, y).isNotNull()
    return (
        df.filter(both)
        .groupBy(x_bin.cast("double").alias("x_bin"), y_bin.cast("double").alias("y_bin"))
        .agg(F.count("*").alias("n"))
    )


def mean_ci(df: DataFrame, name: str, by: Sequence[str] = (), level: float = 0.95) -> DataFrame:
    """Mean, population deviation, standard error and normal confidence interval."""
    z = NormalDist().inv_cdf(0.5 + level / 2)
    value = present(df, name).cast("double")
    moments = df.groupBy(*[col(b) for b in by]).agg(
        F.count(value).alias("n"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std")
    )
    error = F.try_divide(F.col("std"), F.sqrt("n"))
    return moments.select(
        *[col(b) for b in by],
        "n",
        "mean",
        "std",
        error.alias("std_error"),
        (F.col("mean") - error * z).alias("ci_lo"),
        (F.col("mean") + error * z).alias("ci_hi"),
    )
