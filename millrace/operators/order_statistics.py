"""Exact order statistics without a global sort and without a group in one task.

Built-in `percentile` keeps every distinct value of a group in the state of one task, and a
window without partitioning moves the whole table to one. Here an ordered domain is cut into
buckets; the small table of bucket counts says where each rank lies, and only rows of the
buckets in question are looked at. How evenly the buckets fill affects the running time
alone: the ranks are counted, never estimated.

The two building blocks are single SQL statements, so that a plan of many steps is analysed
once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, present, quoted
from millrace.operators.sizes import few_groups

ACCURACY = 1000  # of the sketch that places the bounds: its rank error is n / ACCURACY
MARGIN = 1.5 / ACCURACY  # half width, in probability, of the bracket around a quantile
SALTS = 32  # parts of a group in a join by group
BUCKET_BITS = 12  # 2**12 buckets for a running total


def _name(name: str) -> str:
    """A quoted column name inside a statement that goes through `str.format`."""
    return quoted(name).replace("{", "{{").replace("}", "}}")


def search_items(bounds: str, value: str, bits: int) -> str:
    """Select items that count, as `bucket`, the elements of sorted `bounds` below `value`.

    A branch-free binary search over at most 2**bits - 1 bounds: every item reads the item
    before it, so generated code evaluates each step once per row.
    """
    names = [f"step{i}" for i in range(bits)] + ["bucket"]
    items = [f"0 AS {names[0]}"]
    for i in range(bits):
        half = 1 << (bits - 1 - i)
        probe = f"get({bounds}, {names[i]} + {half - 1})"
        items.append(f"{names[i]} + IF({probe} < {value}, {half}, 0) AS {names[i + 1]}")
    return ",\n           ".join(items)


def quantile_table(
    df: DataFrame,
    groups: Sequence[str],
    value: str,
    probs: Sequence[float],
    small: bool = False,
    solid: Sequence[str] = (),
) -> DataFrame:
    """Quantiles with linear interpolation of a numeric column, per group (one at least).

    Returns one row per group and probability: the groups, `prob`, `quantile`, `n` (non-null
    values of the group). The columns involved are scanned three times: for a sketch of fixed
    size per group, for the counts of buckets and their slices, and for the few rows that
    share a slice with a wanted rank. `small` says that the number of groups is known to be
    small: the per-group tables are then broadcast, and only those few rows are shuffled.
    Otherwise equal values of a group are counted first, and the join by group is salted by
    value, so that a group with most of the rows is spread over many tasks. `solid` groups
    hold no nulls, so that plain equality will do.
    """
    cuts = sorted({min(max(p + d, 0.0), 1.0) for p in probs for d in (-MARGIN, MARGIN)})
    slices = 1000 if len(probs) <= 10 else 100

    def listed(alias: str = "") -> str:
        return "".join(f"{alias}{_name(g)}, " for g in groups)

    def matched(a: str, b: str, keys: Sequence[str] = ()) -> str:
        pairs = [
            f"{a}.{_name(g)} {'=' if g in solid else '<=>'} {b}.{_name(g)}" for g in groups
        ]
        return " AND ".join(pairs + [f"{a}.{k} = {b}.{k}" for k in keys])

    def array(numbers: Sequence[float]) -> str:
        return "array(" + ", ".join(f"{float(x)!r}D" for x in numbers) + ")"

    def hint(table: str) -> str:
        return f"/*+ BROADCAST({table}) */" if small else ""

    g = listed()
    by = f"PARTITION BY {g[:-2]}"
    if small:
        counted = f"SELECT {g} v, 1 AS w FROM rows"
        sketch = "sketched"
        meet = matched("counted", "sketch")
    else:
        counted = f"""
      SELECT {g} v, count(*) AS w, pmod(xxhash64(v), {SALTS}) AS salt FROM rows GROUP BY {g} v"""
        sketch = f"""(
      SELECT {g} bounds, explode(sequence(0L, {SALTS - 1}L)) AS salt FROM sketched)"""
        meet = matched("counted", "sketch", ["salt"])
    statement = f"""
    WITH rows AS (
      SELECT {g} CAST({_name(value)} AS DOUBLE) AS v FROM {{df}} WHERE {_name(value)} IS NOT NULL
    ), sketched AS (
      SELECT {g} array_sort(array_distinct(
               percentile_approx(v, {array(cuts)}, {ACCURACY}))) AS bounds
      FROM rows GROUP BY {g[:-2]}
    ), counted AS ({counted}
    ), searched AS (
      SELECT {hint("sketch")} {listed("counted.")} v, w, bounds,
           {search_items("bounds", "v", len(cuts).bit_length())}
      FROM counted JOIN {sketch} AS sketch ON {meet}
    ), placed AS (
      SELECT {g} v, w, bucket,
             get(bounds, bucket - 1) AS below,
             get(bounds, bucket) - below AS width,
             IF(width > 0, least(floor((v - below) / width * {slices}), {slices}), 0) AS slice
      FROM searched
    ), spans AS (
      SELECT {g} bucket, slice, sum(w) AS size,
             sum(sum(w)) OVER ({by} ORDER BY bucket, slice) - sum(w) AS start,
             sum(sum(w)) OVER ({by}) AS n
      FROM placed GROUP BY {g} bucket, slice
    ), wanted AS (
      SELECT {g} bucket, slice, start, n, r.prob, r.weight, r.rank
      FROM spans LATERAL VIEW explode(filter(
             flatten(transform({array(probs)}, p -> transform(
               sequence(floor(p * (n - 1)), ceil(p * (n - 1))),
               k -> struct(p AS prob, p * (n - 1) - floor(p * (n - 1)) AS weight, k AS rank)))),
             r -> r.rank >= start AND r.rank < start + size)) e AS r
    ), near AS (
      SELECT {hint("wanted")} {listed("wanted.")} n, prob, weight, rank, start, v,
             sum(w) AS size
      FROM placed JOIN wanted ON {matched("placed", "wanted", ("bucket", "slice"))}
      GROUP BY {listed("wanted.")} n, prob, weight, rank, start, v
    ), found AS (
      SELECT *, start + sum(size) OVER (PARTITION BY {g} prob, rank ORDER BY v) AS until
      FROM near
    )
    SELECT {g} prob, n,
           IF(min(v) = max(v), min(v), min(v) + (max(v) - min(v)) * weight) AS quantile
    FROM found WHERE rank < until AND rank >= until - size
    GROUP BY {g} prob, weight, n
    """
    names = [*groups, "prob", "quantile", "n"]
    return df.sparkSession.sql(statement, df=df).select(*[col(c) for c in names])


def unpivot_doubles(
    df: DataFrame, cols: Sequence[str], keep: Sequence[str] = (), numbered: bool = False
) -> DataFrame:
    """Long form (keep..., column, value) of numeric columns; NaN becomes null.

    `column` is the name, or the number from 1, which is the cheaper key.
    """
    pairs = [
        F.struct(
            F.lit(i if numbered else c).alias("column"),
            present(df, c).cast("double").alias("value"),
        )
        for i, c in enumerate(cols, 1)
    ]
    return df.select(*[col(k) for k in keep], F.explode(F.array(*pairs)).alias("p")).select(
        *[col(k) for k in keep], "p.column", "p.value"
    )


def quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    exact: bool = True,
    small: bool | None = None,
) -> DataFrame:
    """Quantiles of several columns: rows (by..., column, prob, quantile, n).

    `small` tells whether the groups are few enough for a broadcast, if that is known. Exact ones interpolate linearly. `exact=False` takes the sketch's element instead, in one
    scan and with a rank error of at most n / 10000.
    """
    if exact:
        long = unpivot_doubles(df, cols, by, numbered=True)
        small = few_groups(df, by) if small is None else small
        table = quantile_table(long, ["column", *by], "value", probs, small, ["column"])
        name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("column"))
        return table.select(
            *[col(b) for b in by], name.alias("column"), "prob", "quantile", "n"
        )
    long = unpivot_doubles(df, cols, by)
    keys = [*by, "column"]
    grid = [float(p) for p in probs]
    sketch = (
        long.filter(F.col("value").isNotNull())
        .groupBy(*[col(k) for k in keys])
        .agg(F.percentile_approx("value", grid, 10000).alias("q"), F.count("*").alias("n"))
    )
    pairs = F.arrays_zip(F.array(*[F.lit(p) for p in grid]).alias("prob"), F.col("q"))
    return sketch.select(*[col(k) for k in keys], F.explode(pairs).alias("z"), "n").select(
        *[col(k) for k in keys], F.col("z.prob"), F.col("z.q").alias("quantile"), "n"
    )


def quantile_row(
    df: DataFrame, cols: Sequence[str], probs: Mapping[str, float], exact: bool = True
) -> DataFrame:
    """The quantiles of ungrouped columns in one row, columns named `<label>__<column>`."""
    table = quantiles(df, cols, list(dict.fromkeys(probs.values())), exact=exact)
    return table.agg(
        *[
            F.max(
                F.when((F.col("column") == c) & (F.col("prob") == float(p)), F.col("quantile"))
            ).alias(f"{label}__{c}")
            for c in cols
            for label, p in probs.items()
        ]
    )


def bucketed(df: DataFrame, value: str, ends: DataFrame, end: str, out: str) -> DataFrame:
    """Add the number of bounds below `value`; bounds are values of `end`, at most 2**12 - 1.

    The bounds are those with the smallest hashes, so buckets hold equally many of the `ends`.
    """
    items = search_items("bounds", "v", BUCKET_BITS).replace(" AS bucket", f" AS {quoted(out)}")
    kept = ", ".join(_name(c) for c in df.columns)
    statement = f"""
    SELECT {kept}, {quoted(out)} FROM (
      SELECT *, (
        SELECT array_sort(collect_set(o)) FROM (
          SELECT {_name(end)} AS o FROM {{ends}} ORDER BY xxhash64({_name(end)}), {_name(end)}
          LIMIT {(1 << BUCKET_BITS) - 1})
        ) AS bounds, {_name(value)} AS v,
        {items}
      FROM {{df}})
    """
    return df.sparkSession.sql(statement, df=df, ends=ends)


def running_total(distinct: DataFrame, order: str, sums: Mapping[str, str]) -> DataFrame:
    """Add, for each row, sums of columns over all rows with a lower `order` value.

    `distinct` has one row per value of `order`, no nulls in it; `sums` maps a result name to
    the column it sums. The bucket bounds are the values with the smallest hashes, at most
    2**12 - 1 of them, which makes the buckets even whatever the distribution. The table of
    bucket totals is therefore small, too, and the rest runs bucket by bucket.
    """
    o = _name(order)
    kept = ", ".join(_name(c) for c in distinct.columns)
    named = list(sums.items())
    inner = ", ".join(
        f"coalesce(sum({_name(c)}) OVER (PARTITION BY bucket ORDER BY {o}"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS inner{i}"
        for i, (_, c) in enumerate(named)
    )
    total = ", ".join(f"sum({_name(c)}) AS total{i}" for i, (_, c) in enumerate(named))
    outer = ", ".join(
        f"coalesce(sum(total{i}) OVER (ORDER BY bucket"
        f" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS outer{i}"
        for i in range(len(named))
    )
    result = ", ".join(f"inner{i} + outer{i} AS {_name(n)}" for i, (n, _) in enumerate(named))
    statement = f"""
    WITH placed AS (
      SELECT {kept}, bucket FROM (
        SELECT *, (
          SELECT array_sort(collect_list(o)) FROM (
            SELECT {o} AS o FROM {{df}} ORDER BY xxhash64({o}), {o}
            LIMIT {(1 << BUCKET_BITS) - 1})
          ) AS bounds,
          {search_items("bounds", o, BUCKET_BITS)}
        FROM {{df}})
    ), offsets AS (
      SELECT bucket, {outer} FROM (SELECT bucket, {total} FROM placed GROUP BY bucket)
    ), local AS (
      SELECT {kept}, bucket, {inner} FROM placed
    )
    SELECT /*+ BROADCAST(offsets) */ {kept}, {result}
    FROM local JOIN offsets ON local.bucket = offsets.bucket
    """
    return distinct.sparkSession.sql(statement, df=distinct)


def dense_codes(df: DataFrame, value: str, code: str = "code") -> DataFrame:
    """Distinct non-null values with their rank from 0 in ascending order."""
    distinct = df.select(col(value)).filter(col(value).isNotNull()).distinct()
    ranked = running_total(distinct.withColumn("__one", F.lit(1).cast("bigint")), value,
                           {code: "__one"})
    return ranked.select(col(value), col(code))
