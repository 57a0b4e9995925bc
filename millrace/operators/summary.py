"""Summaries that can be kept: moments and a quantile sketch a column, added up when data grow.

A summary is a table with one row a column (and group): n, mean, m2 (the sum of squared
deviations from the mean), min, max and sketch. New data get a summary of their own; `merge`
makes one of both, without another look at the old rows. Exact quantiles then need a single
scan: the sketch places a bracket around every wanted rank, values inside of brackets are
counted one by one, all others only by the interval between brackets in which they lie.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import NUMERICS, col, columns_of, present, quoted
from millrace.operators.order_statistics import quantiles, search_items, unpivot_doubles
from millrace.operators.sizes import fits_broadcast
from millrace.sources.scratch import written

#: Size of the sketches: about 200 KB, with rank errors below `_ERROR` in 99 of 100 cases.
SKETCH_SIZE = 8192
_ERROR = 2.296 / SKETCH_SIZE**0.9021
#: Half width of a bracket, in probability. A rank outside of it is noticed, see `exact_quantiles`.
MARGIN = 3 * _ERROR
_SLICES = 1000

_FIELDS = ("n", "mean", "m2", "min", "max", "sketch")


def summarise(df: DataFrame, cols: Sequence[str] | None = None, by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, n, mean, m2, min, max, sketch) of numeric columns, in one scan.

    Missing values do not count; a column without values has n = 0 and nulls but for its empty
    sketch. Sketches differ from run to run in what chance leaves to them; the results that
    `exact_quantiles` gets with them do not.
    """
    cols = list(cols) if cols is not None else columns_of(df, NUMERICS)

    def row(name: str) -> Column:
        value = present(df, name).cast("double")
        n = F.count(value)
        fields = (n, F.avg(value), F.var_pop(value) * n, F.min(value), F.max(value))
        named = [f.alias(a) for f, a in zip(fields, _FIELDS)]
        return F.struct(F.lit(name).alias("column"), *named, F.kll_sketch_agg_double(value, SKETCH_SIZE).alias("sketch"))

    groups = [col(b) for b in by]
    wide = df.groupBy(*groups).agg(*[row(c).alias(f"__s{i}") for i, c in enumerate(cols)])
    each = F.explode(F.array(*[F.col(f"__s{i}") for i in range(len(cols))])).alias("__s")
    return wide.select(*groups, each).select(*groups, "__s.*")


def merge(summaries: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row for each column and group of `by` from the rows of several summaries.

    Groups that the summaries have and `by` leaves out are added up too. Squared deviations are
    taken from the common mean, so a large mean costs no digits.
    """
    keys = [*by, "column"]
    weighted = F.sum(F.col("n") * F.col("mean")) / F.when(F.sum("n") > 0, F.sum("n"))
    center = summaries.groupBy(*[col(k) for k in keys]).agg(weighted.alias("__center"))
    center = center.select(*[col(k).alias(f"__k{i}") for i, k in enumerate(keys)], "__center")
    same = F.lit(True)
    for i, k in enumerate(keys):
        same = same & col(k).eqNullSafe(F.col(f"__k{i}"))
    off = F.col("mean") - F.col("__center")
    return (
        summaries.join(center, same)
        .groupBy(*[col(k) for k in keys])
        .agg(
            F.sum("n").alias("n"),
            F.first("__center").alias("mean"),
            F.sum(F.col("m2") + F.col("n") * off * off).alias("m2"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
            F.kll_merge_agg_double("sketch", SKETCH_SIZE).alias("sketch"),
        )
    )


def sketched_quantiles(summary: DataFrame, probs: Sequence[float], by: Sequence[str] = ()) -> DataFrame:
    """Rows (by..., column, prob, quantile, n) from the sketches alone, with no scan.

    A quantile is a value of the column whose rank is off by less than `_ERROR` of n in 99 of
    100 cases.
    """
    ranks = F.array(*[F.lit(float(p)) for p in probs])
    found = F.kll_sketch_get_quantile_double("sketch", ranks)
    pairs = F.arrays_zip(ranks.alias("prob"), found.alias("quantile"))
    each = summary.where("n > 0").select(*[col(b) for b in by], "column", F.explode(pairs).alias("__p"), "n")
    return each.select(*[col(b) for b in by], "column", "__p.prob", "__p.quantile", "n")


def _brackets(summary: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str]) -> DataFrame:
    """Rows (by..., column as number from 1, bounds, inside): the ends of all brackets, sorted,
    and for each interval that ends at a bound whether it lies in a bracket."""
    ends = [min(max(p + d, 0.0), 1.0) for p in probs for d in (-MARGIN, MARGIN)]
    found = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(e) for e in ends]))
    rows = summary.where("n > 0").select(
        *[col(b) for b in by],
        F.array_position(F.array(*[F.lit(c) for c in cols]), F.col("column")).cast("int").alias("column"),
        found.alias("ends"),
    )
    inside = F.expr(f"""
        transform(sequence(0, size(bounds)), b -> coalesce(exists(sequence(0, {len(probs) - 1}),
            i -> get(bounds, b - 1) >= get(ends, 2 * i) AND get(bounds, b) <= get(ends, 2 * i + 1)), false))""")
    rows = rows.where("column > 0").withColumn("bounds", F.array_sort(F.array_distinct("ends")))
    return rows.select(*[col(b) for b in by], "column", "bounds", inside.alias("inside"))


def exact_quantiles(
    df: DataFrame, summary: DataFrame, cols: Sequence[str], probs: Sequence[float], by: Sequence[str] = ()
) -> DataFrame:
    """Quantiles with linear interpolation, rows (by..., column, prob, quantile, n), in one scan.

    `summary` is that of all rows of `df`, by `by`. Values in brackets are counted map-side and
    those counts are written; ranks follow from them. Should a rank lie outside its bracket, by
    chance or as the summary is that of other rows, or should there be too many groups for a
    broadcast, `quantiles` finds them without the summary.
    """
    brackets = written(_brackets(summary, cols, probs, by), "brackets")
    if not fits_broadcast(brackets):
        return quantiles(df, cols, probs, by, small=False)
    groups = ["column", *by]
    g = "".join(f"{_name(c)}, " for c in groups)
    spark, long = df.sparkSession, unpivot_doubles(df, cols, by, numbered=True)
    bits = (2 * len(probs)).bit_length()
    counted = f"""
    WITH searched AS (
      SELECT /*+ BROADCAST(s) */ {_listed("r", groups)} r.value AS v, bounds, inside,
             {search_items("bounds", "r.value", bits)}
      FROM {{long}} AS r JOIN {{brackets}} AS s ON {_matched("r", "s", groups)} WHERE r.value IS NOT NULL
    ), placed AS (
      SELECT {g} bucket, v, get(bounds, bucket - 1) AS below, get(bounds, bucket) - below AS width,
             coalesce(get(inside, bucket) OR v = get(bounds, bucket), false) AS near
      FROM searched
    )
    SELECT {g} bucket,
           IF(near AND width > 0, least(floor((v - below) / width * {_SLICES}), {_SLICES}), 0) AS slice,
           IF(near, v, NULL) AS v, count(*) AS size
    FROM placed GROUP BY ALL
    """
    counts = written(spark.sql(counted, long=long, brackets=brackets), "brackets")
    listed = "array(" + ", ".join(f"{float(p)!r}D" for p in probs) + ")"
    by_group = f"PARTITION BY {g[:-2]}"
    ranked = f"""
    WITH spans AS (
      SELECT {g} bucket, slice, sum(size) AS size,
             sum(sum(size)) OVER ({by_group} ORDER BY bucket, slice) - sum(size) AS start,
             sum(sum(size)) OVER ({by_group}) AS n
      FROM {{counts}} GROUP BY {g} bucket, slice
    ), wanted AS (
      SELECT {g} bucket, slice, start, n, r.prob, r.weight, r.rank
      FROM spans LATERAL VIEW explode(filter(
             flatten(transform({listed}, p -> transform(
               sequence(floor(p * (n - 1)), ceil(p * (n - 1))),
               k -> struct(p AS prob, p * (n - 1) - floor(p * (n - 1)) AS weight, k AS rank)))),
             r -> r.rank >= start AND r.rank < start + size)) e AS r
    ), found AS (
      SELECT /*+ BROADCAST(w) */ {_listed("w", groups)} w.n, w.prob, w.weight, w.rank, c.v, c.size,
             w.start + sum(c.size) OVER (
               PARTITION BY {_listed("w", groups)} w.prob, w.rank ORDER BY c.v NULLS FIRST) AS until
      FROM {{counts}} AS c JOIN wanted AS w ON {_matched("c", "w", [*groups, "bucket", "slice"])}
    )
    SELECT {g} prob, n, count(v) = count(*) AS hit,
           IF(min(v) = max(v), min(v), min(v) + (max(v) - min(v)) * weight) AS quantile
    FROM found WHERE rank < until AND rank >= until - size GROUP BY {g} prob, weight, n
    """
    table = written(spark.sql(ranked, counts=counts), "quantiles")
    if not table.where("NOT hit").isEmpty():
        return quantiles(df, cols, probs, by)
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("column"))
    return table.select(*[col(b) for b in by], name.alias("column"), "prob", "quantile", "n")


def _name(name: str) -> str:
    """A quoted column name inside a statement that goes through `str.format`."""
    return quoted(name).replace("{", "{{").replace("}", "}}")


def _listed(alias: str, names: Sequence[str]) -> str:
    return "".join(f"{alias}.{_name(c)}, " for c in names)


def _matched(a: str, b: str, names: Sequence[str]) -> str:
    solid = ("column", "bucket", "slice")
    return " AND ".join(f"{a}.{_name(c)} {'=' if c in solid else '<=>'} {b}.{_name(c)}" for c in names)
