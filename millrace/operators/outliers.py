"""Outlier rules: inter-quartile fences, standard scores, and columns of flags."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import INTEGERS, col, columns_of, present
from millrace.operators.order_statistics import quantile_row
from millrace.operators.project import replace_columns
from millrace.operators.statistics import stat, with_stats
from millrace.sources.scratch import scratch_path


def iqr_to_null(
    df: DataFrame, cols: Sequence[str], factor: float = 1.5, exact: bool = True
) -> DataFrame:
    """Null the values beyond `factor` inter-quartile ranges outside the quartiles."""
    fenced = with_stats(df, quantile_row(df, cols, {"q1": 0.25, "q3": 0.75}, exact))

    def inside(c: str) -> Column:
        q1, q3 = stat(f"q1__{c}"), stat(f"q3__{c}")
        margin = (q3 - q1) * factor
        return F.when(present(df, c).between(q1 - margin, q3 + margin), present(df, c))

    return fenced.select(*[inside(c).alias(c) if c in cols else col(c) for c in df.columns])


def _deviation(df: DataFrame, c: str, ddof: int) -> Column:
    return (F.stddev_pop if ddof == 0 else F.stddev_samp)(present(df, c))


def zscore_filter(
    df: DataFrame, cols: Sequence[str], threshold: float, ddof: int = 0
) -> DataFrame:
    """Drop a row if any of its columns is more than `threshold` deviations off the mean.

    All means and deviations come from one aggregate over all rows. Missing values and
    constant columns flag no row. `ddof` 0 is the population deviation, 1 the sample's.
    """
    moments = [F.avg(present(df, c)).alias(f"mean__{c}") for c in cols]
    moments += [_deviation(df, c, ddof).alias(f"std__{c}") for c in cols]
    if not cols:
        return df
    scored = with_stats(df, df.agg(*moments))

    def usual(c: str) -> Column:
        score = F.abs(F.try_divide(present(df, c) - stat(f"mean__{c}"), stat(f"std__{c}")))
        return F.coalesce(score <= threshold, F.lit(True))

    kept = scored.filter(reduce(and_, [usual(c) for c in cols]))
    return kept.select(*[col(c) for c in df.columns])


@dataclass(frozen=True)
class _Moments:
    """Number, mean and sum of squared differences from it, of the present values of a column."""

    n: int
    mean: float
    squares: float

    def without(self, gone: _Moments) -> _Moments | None:
        """What is left when some of the values are taken away; None where too few digits are left."""
        n = self.n - gone.n
        if not gone.n or not n:
            return self if n else _Moments(0, 0.0, 0.0)
        mean = self.mean + (self.mean - gone.mean) * gone.n / n
        squares = self.squares - gone.squares - (gone.mean - mean) ** 2 * n * gone.n / self.n
        return _Moments(n, mean, squares) if squares > 1e-4 * self.squares else None

    def usual(self, ddof: int) -> tuple[float, float] | None:
        """Mean and deviation; None where there is no deviation to speak of."""
        if self.n <= ddof or self.squares <= 0:
            return None
        return self.mean, math.sqrt(self.squares / (self.n - ddof))


def _moments(df: DataFrame, cols: Sequence[str]) -> dict[str, _Moments]:
    """Of all columns, from one aggregate."""
    values = {c: present(df, c).cast("double") for c in cols}
    parts = [f(v) for v in values.values() for f in (F.count, F.avg, F.var_pop)]
    row = df.agg(*parts).first()
    triples = zip(row[::3], row[1::3], row[2::3])
    return {c: _Moments(n, mean or 0.0, (variance or 0.0) * n) for c, (n, mean, variance) in zip(cols, triples)}


def zscore_filter_sequential(
    df: DataFrame, cols: Sequence[str], threshold: float, tolerance: float = 0.0, ddof: int = 1
) -> DataFrame:
    """Filter by one column after the other, each time with the survivors' mean and deviation.

    A row stays while |z| - threshold < tolerance; missing values and constant columns flag no
    row. `zscore_filter` judges all columns by all rows instead.

    The table is scanned twice, and once more for the result, however many columns there are.
    The first scan gives the moments of all columns. The second writes the rows, these columns
    only, that are further than 0.6 of the bound off the mean of some column: the only rows that
    may go, as long as the bounds do not move by more than that. Each column's pass then reads
    these few rows, and the moments of the rows that go are taken away from those of the whole.
    If a bound does move that far, or if what is left of a sum of squares is too small a part of
    it to be exact, the pass is made over all rows that are left, and new rows are written.
    """
    cols = list(cols)
    bound = threshold + tolerance
    if bound <= 0:
        return _sequential_by_passes(df, cols, threshold, tolerance, ddof)
    left, moments, few, inner = df, {}, None, {}
    for c in cols:
        now = moments.get(c)
        found = now.usual(ddof) if now else None
        if found:
            mean, std = found
            low, high = inner.get(c, (math.inf, -math.inf))
            trusted = mean - bound * std <= low and mean + bound * std >= high
        else:
            trusted = now is not None and c not in inner  # a constant column flags nothing
        if not trusted:
            moments = _moments(left, cols)
            inner = {}
            for other in cols:
                usual = moments[other].usual(ddof)
                if usual:
                    inner[other] = (usual[0] - 0.6 * bound * usual[1], usual[0] + 0.6 * bound * usual[1])
            outside = [~F.coalesce(present(left, k).between(*ends), F.lit(True)) for k, ends in inner.items()]
            few = _stored(left.filter(reduce(or_, outside, F.lit(False))).select(*[col(k) for k in cols]))
            found = moments[c].usual(ddof)
            if not found:
                continue
            mean, std = found
        elif not found:
            continue

        def stays(rows: DataFrame, c: str = c, mean: float = mean, std: float = std) -> Column:
            score = F.abs(present(rows, c) - F.lit(mean)) / F.lit(std) - F.lit(float(threshold))
            return F.coalesce(score < F.lit(float(tolerance)), F.lit(True))

        gone = _moments(few.filter(~stays(few)), cols)
        rest = {k: m.without(gone[k]) for k, m in moments.items()}
        moments = {k: m for k, m in rest.items() if m is not None}
        left, few = left.filter(stays(left)), few.filter(stays(few))
    return left


def _sequential_by_passes(df: DataFrame, cols: Sequence[str], threshold: float, tolerance: float, ddof: int) -> DataFrame:
    """The same by one pass over all rows for each column."""
    for c in cols:
        found = _moments(df, [c])[c].usual(ddof)
        if found:
            score = F.abs(present(df, c) - F.lit(found[0])) / F.lit(found[1]) - F.lit(float(threshold))
            df = df.filter(F.coalesce(score < F.lit(float(tolerance)), F.lit(True)))
    return df


def _stored(df: DataFrame) -> DataFrame:
    path = scratch_path(df.sparkSession, "candidates")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def narrow_booleans(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Cast whole-number columns that hold only 0 and 1 to boolean.

    The result's schema depends on the data, so this runs one aggregate when called.
    """
    cols = list(cols) if cols is not None else columns_of(df, INTEGERS)
    if not cols:
        return df
    tests = df.agg(*[F.bool_and(col(c).isin(0, 1)).alias(f"t{i}") for i, c in enumerate(cols)])
    flags = [c for c, only_flags in zip(cols, tests.first()) if only_flags]
    return replace_columns(df, {c: col(c).cast("boolean") for c in flags})
