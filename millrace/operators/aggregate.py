"""Grouped and global aggregates. All reduce map-side before their one shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, present


def group_avg(df: DataFrame, keys: Sequence[str], name: str, out: str | None = None) -> DataFrame:
    """Mean of the present values per group."""
    return df.groupBy(*[col(k) for k in keys]).agg(
        F.avg(present(df, name)).alias(out or f"average_{name}")
    )


def group_rate(
    df: DataFrame, keys: Sequence[str], flag: str | Column, out: str = "rate"
) -> DataFrame:
    """Share of a group's rows that are flagged (a boolean, or a number summed as it is)."""
    hit = col(flag) if isinstance(flag, str) else flag
    return df.groupBy(*[col(k) for k in keys]).agg(
        (F.sum(hit.cast("double")) / F.count("*")).alias(out)
    )


def group_mean_all_rows(
    df: DataFrame, keys: Sequence[str], name: str, out: str = "mean_all_rows"
) -> DataFrame:
    """Sum of the present values over the number of all rows of the group."""
    return df.groupBy(*[col(k) for k in keys]).agg(
        (F.sum(present(df, name)).cast("double") / F.count("*")).alias(out)
    )


def value_counts(df: DataFrame, *keys: str, out: str = "n", min_count: int = 0) -> DataFrame:
    """Rows per group; groups of fewer than `min_count` rows are left out."""
    counted = df.groupBy(*[col(k) for k in keys]).agg(F.count("*").alias(out))
    return counted.filter(F.col(out) >= min_count) if min_count > 1 else counted


def word_count(df: DataFrame, text: str = "value", min_count: int = 3) -> DataFrame:
    """Words of a text column with their number; a word is what stands between two blanks.

    Case and punctuation are kept, and so are empty words between adjacent blanks.
    """
    words = df.select(F.explode(F.split(col(text), " ", -1)).alias("word"))
    return value_counts(words, "word", min_count=min_count)


def mode_by_group(df: DataFrame, keys: Sequence[str], name: str, out: str = "mode") -> DataFrame:
    """Most frequent present value per group, the lowest on ties."""
    counted = (
        df.select(*[col(k) for k in keys], present(df, name).alias("__v"))
        .filter(F.col("__v").isNotNull())
        .groupBy(*[col(k) for k in keys], "__v")
        .agg(F.count("*").alias("__n"))
    )
    best = F.min(F.struct((-F.col("__n")).alias("rank"), F.col("__v").alias("value")))
    return counted.groupBy(*[col(k) for k in keys]).agg(best.getField("value").alias(out))


def conditional_means(df: DataFrame, name: str, conditions: Mapping[str, Column]) -> DataFrame:
    """One row: the mean of a column over the rows meeting each condition, from one scan."""
    return df.agg(*[F.avg(F.when(c, present(df, name))).alias(n) for n, c in conditions.items()])


def distinct_counts(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Number of distinct non-null values per column: rows (column, n_distinct).

    Values are compared as what they are: 0.0 equals -0.0, and arrays are equal by elements.
    The exact form spreads the distinct values of all columns over the cluster.
    """
    if not exact:
        return _long(df.agg(*[F.approx_count_distinct(col(c)).alias(c) for c in cols]), cols)
    return _long(df.agg(*[F.count_distinct(col(c)).alias(c) for c in cols]), cols)


def _long(counts: DataFrame, cols: Sequence[str]) -> DataFrame:
    pairs = [F.struct(F.lit(c).alias("column"), col(c).alias("n_distinct")) for c in cols]
    return counts.select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def row_count(df: DataFrame, out: str = "n") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def top_group(df: DataFrame, key: str, out: str = "n", n: int = 1) -> DataFrame:
    """The n largest groups by row count, lower key first on ties."""
    return value_counts(df, key, out=out).orderBy(F.desc(out), col(key)).limit(n)


def best_of(metrics: DataFrame, name: str = "model", score: str = "value") -> DataFrame:
    """The row of the highest score, lower name first on ties."""
    return metrics.orderBy(col(score).desc_nulls_last(), col(name)).limit(1)
