"""Derived features, scaling and category codes."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations, combinations_with_replacement

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions.columns import FLOATS, col, field, present
from millrace.functions.hashing import hash_normals
from millrace.operators.codes import attach_codes, category_codes
from millrace.operators.project import replace_columns
from millrace.operators.statistics import stat, with_stats


def log1p(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return replace_columns(df, {c: F.log1p(col(c)) for c in cols})


def sqrt_log(df: DataFrame, name: str, out: str | None = None) -> DataFrame:
    """Square root of the natural logarithm; null below 1, where there is no real root."""
    return replace_columns(df, {out or name: F.when(col(name) >= 1, F.sqrt(F.log(col(name))))})


def round_columns(
    df: DataFrame, cols: Sequence[str], digits: int = 2, half_even: bool = False
) -> DataFrame:
    """Round columns, ties away from zero or, on request, to the even neighbour."""
    rounded = F.bround if half_even else F.round
    return replace_columns(df, {c: rounded(col(c), digits) for c in cols})


def _wide(df: DataFrame, name: str) -> Column:
    """A number wide enough to be multiplied: whole numbers as bigint, others as double."""
    if isinstance(field(df, name).dataType, FLOATS + (T.DecimalType,)):
        return col(name).cast("double")
    return col(name).cast("bigint")


def pairwise(
    df: DataFrame,
    cols: Sequence[str],
    op: str = "mul",
    squares: bool = False,
    name: str = "{a}_x_{b}",
) -> DataFrame:
    """Add the product ("mul") or the larger value ("max") of every two columns.

    `squares` pairs each column with itself, too. One projection adds all of them.
    """
    pairs = (combinations_with_replacement if squares else combinations)(cols, 2)
    combine = {"mul": lambda a, b: a * b, "max": F.greatest}[op]
    return df.select(
        "*", *[combine(_wide(df, a), _wide(df, b)).alias(name.format(a=a, b=b)) for a, b in pairs]
    )


def squares(df: DataFrame, cols: Sequence[str], name: str = "{a}_2") -> DataFrame:
    return df.select(
        "*", *[(_wide(df, c) * _wide(df, c)).cast("double").alias(name.format(a=c)) for c in cols]
    )


def ratio(df: DataFrame, numerator: str, denominator: str, out: str = "ratio") -> DataFrame:
    """Quotient of two columns; null where the denominator is 0."""
    return replace_columns(df, {out: F.try_divide(col(numerator), col(denominator))})


def standardize(df: DataFrame, cols: Sequence[str], name: str = "{a}", ddof: int = 1) -> DataFrame:
    """(value - mean) / deviation of each column; null in a constant column."""
    deviation = F.stddev_samp if ddof else F.stddev_pop
    moments = [F.avg(present(df, c)).alias(f"mean__{c}") for c in cols]
    moments += [deviation(present(df, c)).alias(f"std__{c}") for c in cols]
    scored = with_stats(df, df.agg(*moments))
    new = {
        name.format(a=c): F.try_divide(present(df, c) - stat(f"mean__{c}"), stat(f"std__{c}"))
        for c in cols
    }
    kept = [new.pop(c).alias(c) if c in new else col(c) for c in df.columns]
    return scored.select(*kept, *[e.alias(n) for n, e in new.items()])


def minmax_fit(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scaling parameters, rows (name, min, max, scale); scale is 1 in a constant column."""
    ends = df.agg(
        *[
            F.struct(
                F.lit(c).alias("name"),
                F.min(present(df, c)).cast("double").alias("min"),
                F.max(present(df, c)).cast("double").alias("max"),
            ).alias(f"s{i}")
            for i, c in enumerate(cols)
        ]
    )
    long = ends.select(F.explode(F.array(*[F.col(f"s{i}") for i in range(len(cols))])).alias("s"))
    span = F.col("max") - F.col("min")
    return long.select("s.*").withColumn("scale", F.when(span == 0, 1.0).otherwise(1 / span))


def minmax_apply(df: DataFrame, params: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Scale columns with fitted parameters; values outside the fitted range leave [0, 1]."""
    row = params.agg(
        *[
            F.max(F.when(F.col("name") == c, F.struct("min", "scale"))).alias(c)
            for c in cols
        ]
    )
    scaled = with_stats(df, row)

    def value(c: str) -> Column:
        return (present(df, c) - stat(c).getField("min")) * stat(c).getField("scale")

    return scaled.select(*[value(c).alias(c) if c in cols else col(c) for c in df.columns])


def label_encode(df: DataFrame, cols: Sequence[str], suffix: str = "_encoded") -> DataFrame:
    """Add for each column its value's position among the distinct values, sorted, from 0."""
    return attach_codes(df, category_codes(df, cols), cols, suffix) if cols else df


def string_index(df: DataFrame, cols: Sequence[str], suffix: str = "Index") -> DataFrame:
    """Add for each column its value's position by falling frequency, lower value on ties.

    Missing values get the number of distinct values, so that they can be told apart.
    """
    if not cols:
        return df
    codes = category_codes(df, cols, by_frequency=True)
    indexed = attach_codes(df, codes, cols, suffix)
    filled = {c + suffix: F.coalesce(col(c + suffix), F.lit(codes.sizes[i]).cast("bigint")) for i, c in enumerate(cols)}
    return replace_columns(indexed, filled)


def perturb(
    df: DataFrame, cols: Sequence[str], std: float, key: str, *seed: Column | int | str
) -> DataFrame:
    """Add independent normal noise to columns; it depends on row key, column and seed only.

    The columns pass through one array, so that the generated code does not grow with their
    number beyond what a method may hold.
    """
    cols = list(cols)
    values = F.array(*[present(df, c).cast("double") for c in cols])
    noise = hash_normals(col(key), len(cols), *seed)
    noisy = df.withColumn("__noisy", F.zip_with(values, noise, lambda v, e: v + e * std))
    return noisy.select(
        *[F.col("__noisy")[cols.index(c)].alias(c) if c in cols else col(c) for c in df.columns]
    )
