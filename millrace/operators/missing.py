"""Missing and invalid values: profile, repair by statistic or constant, votes.

A `Repair` says, for one column, which values are replaced and by what. `repair` applies any
number of them at once: all means come from one aggregate and all modes from another, so the
table is scanned three times however many columns there are, and nothing is collected.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, field, is_missing, present
from millrace.operators.project import replace_columns
from millrace.operators.statistics import mode_stats, stat, with_stats

MEAN, MODE = "mean", "mode"
Test = Callable[[Column], Column]


@dataclass(frozen=True)
class Repair:
    """How a column's values are replaced.

    `fill` is MEAN, MODE or a constant (the texts "mean" and "mode" as a `Column`). `over`
    tells the values a statistic is taken over, all present ones by default; `wrong` tells
    the values to replace; missing values are replaced unless `missing` is false.
    """

    fill: object
    over: Test | None = None
    wrong: Test | None = None
    missing: bool = True

    @property
    def statistic(self) -> str | None:
        return self.fill if isinstance(self.fill, str) and self.fill in (MEAN, MODE) else None


def in_range(
    lo: float | None = None, hi: float | None = None, over: str | Test = "in_range"
) -> Repair:
    """Values outside [lo, hi] or missing become a mean.

    The mean is that of the values in range, of "all" values, or of those passing a test.
    """

    def inside(c: Column) -> Column:
        test = F.lit(True)
        if lo is not None:
            test = test & (c >= lo)
        if hi is not None:
            test = test & (c <= hi)
        return test

    if isinstance(over, str):
        over = {"in_range": inside, "all": None}[over]
    return Repair(MEAN, over, lambda c: ~inside(c))


def valid_code(valid: Test, bad: Test | None = None, fill_missing: bool = True) -> Repair:
    """Bad codes become the most frequent valid code; also missing ones, if asked.

    Codes that are neither valid nor bad stay. By default every invalid code is bad.
    """
    return Repair(MODE, valid, bad or (lambda c: ~valid(c)), fill_missing)


def binary_flag() -> Repair:
    """Values above 1 and missing ones become the most frequent of the others."""
    return valid_code(lambda c: c <= 1)


def basis_of(df: DataFrame, c: str, rule: Repair) -> Column:
    """The values that the rule's statistic is taken over."""
    value = present(df, c)
    return value if rule.over is None else F.when(rule.over(value), value)


def repair(
    df: DataFrame, rules: Mapping[str, Repair], fitted_on: DataFrame | None = None
) -> DataFrame:
    """Apply a rule to each of several columns. The mean of whole numbers is a double.

    The statistics come from `df` itself or from the columns of another frame: the training
    rows, or a table that `df` was joined with, which saves computing the join once more.
    """
    source = df if fitted_on is None else fitted_on

    def basis(c: str) -> Column:
        return basis_of(source, c, rules[c])

    means = [c for c in rules if rules[c].statistic == MEAN]
    modes = [c for c in rules if rules[c].statistic == MODE]
    holder = df
    if means:
        holder = with_stats(holder, source.agg(*[F.avg(basis(c)).alias(c) for c in means]), "__mean")
    if modes:
        typed = {c: (basis(c), field(df, c).dataType) for c in modes}
        holder = with_stats(holder, mode_stats(source, typed), "__mode")

    def fill(c: str) -> Column | None:
        return stat(c, f"__{rules[c].statistic}") if rules[c].statistic else None

    return holder.select(*[repaired(df, c, rules[c], fill(c)).alias(c) if c in rules else col(c) for c in df.columns])


def repaired(df: DataFrame, c: str, rule: Repair, statistic: Column | None) -> Column:
    """A column after its rule, whose statistic is given if it has one."""
    value, fill = present(df, c), statistic
    if fill is None:
        constant = rule.fill if isinstance(rule.fill, Column) else F.lit(rule.fill)
        fill = constant.cast(field(df, c).dataType)
    if rule.wrong is None:
        return F.coalesce(value, fill) if rule.missing else value
    wrong = F.coalesce(rule.wrong(value), F.lit(False))
    if rule.missing:
        wrong = wrong | value.isNull()
    return F.when(wrong, fill).otherwise(value)


def missing_profile(df: DataFrame, total: str = "n_rows") -> DataFrame:
    """One row: the number of missing values per column, and the number of rows."""
    return df.agg(
        *[F.count_if(is_missing(df, c)).alias(c) for c in df.columns], F.count("*").alias(total)
    )


def impute(
    df: DataFrame, fills: Mapping[str, object], fitted_on: DataFrame | None = None
) -> DataFrame:
    """Fill missing values: each column by "mean", by "mode", or by the constant given."""
    return repair(df, {c: Repair(fill) for c, fill in fills.items()}, fitted_on)


def replace_out_of_range(
    df: DataFrame,
    name: str,
    lo: float | None = None,
    hi: float | None = None,
    over: str | Test = "in_range",
) -> DataFrame:
    """Set values outside [lo, hi] or missing to a mean; see `in_range`."""
    return repair(df, {name: in_range(lo, hi, over)})


def replace_invalid(
    df: DataFrame,
    cols: Sequence[str],
    valid: Test,
    bad: Test | None = None,
    fill_missing: bool = True,
) -> DataFrame:
    """Set bad codes to the column's most frequent valid code; see `valid_code`."""
    return repair(df, {c: valid_code(valid, bad, fill_missing) for c in cols})


def clean_binary(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return repair(df, {c: binary_flag() for c in cols})


def impute_from_votes(df: DataFrame, name: str, sources: Sequence[str], k: float = 1) -> DataFrame:
    """A missing flag becomes 1 if its sources add up to at least `k`, and 0 otherwise.

    A missing source makes the sum unknown, which counts as 0.
    """
    total = sum((present(df, s) for s in sources[1:]), present(df, sources[0]))
    vote = F.when(total >= k, 1).otherwise(0).cast(field(df, name).dataType)
    return replace_columns(df, {name: F.coalesce(present(df, name), vote)})


def row_sum(df: DataFrame, out: str, cols: Sequence[str]) -> DataFrame:
    """Set `out` to the sum of the present values of other columns in the row."""
    parts = [F.coalesce(present(df, c), F.lit(0)) for c in cols]
    return replace_columns(df, {out: sum(parts[1:], parts[0])})
