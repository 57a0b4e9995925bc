"""Many cleaning steps one after the other, each with statistics of what the steps before left.

A statistic as a scalar subquery holds the plan of its input, so that steps on top of each other
double the plan with every step. Here the steps are put in levels: a step belongs to the level
after the last one that changes its columns or drops rows before it. The statistics of one level
have the same input and are one aggregate for all columns (one more for modes, one for
quartiles). They are fetched, a single row, and stand as literals in the next level's plan,
which therefore grows by one projection a level and reads the source once.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field as dataclass_field
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col, field, present
from millrace.operators.missing import MEAN, MODE, Repair, basis_of, repaired
from millrace.operators.order_statistics import quantile_row
from millrace.operators.project import replace_columns
from millrace.operators.statistics import mode_stats


@dataclass(frozen=True)
class Fill:
    """`repair` with these rules."""

    rules: Mapping[str, Repair]

    @property
    def columns(self) -> list[str]:
        return list(self.rules)


@dataclass(frozen=True)
class Fence:
    """`iqr_to_null`: values beyond `factor` inter-quartile ranges outside the quartiles go."""

    cols: Sequence[str]
    factor: float = 1.5

    @property
    def columns(self) -> list[str]:
        return list(self.cols)


@dataclass(frozen=True)
class Scale:
    """`standardize`: value less mean, over the deviation."""

    cols: Sequence[str]
    ddof: int = 1

    @property
    def columns(self) -> list[str]:
        return list(self.cols)


@dataclass(frozen=True)
class DropUnusual:
    """`zscore_filter`: rows go that are more than `threshold` deviations off a mean."""

    cols: Sequence[str]
    threshold: float
    ddof: int = 0

    @property
    def columns(self) -> list[str]:
        return list(self.cols)


Step = Fill | Fence | Scale | DropUnusual


@dataclass
class _Level:
    """Parts of steps with the same input: at most one for each column, then one that drops rows."""

    changes: dict[str, Step] = dataclass_field(default_factory=dict)
    drop: DropUnusual | None = None


def plan_levels(steps: Sequence[Step]) -> list[_Level]:
    """The steps by level; the parts of one step for different columns may be in different levels."""
    levels: list[_Level] = []
    after: dict[str, int] = {}  # the first level that may hold the next change of a column
    start = 0  # of what comes after the last step that drops rows

    def at(i: int) -> _Level:
        while len(levels) <= i:
            levels.append(_Level())
        return levels[i]

    for step in steps:
        if isinstance(step, DropUnusual):
            # all earlier changes go first or, in the same level, together: other rows are left later
            latest = max([start, *(after.get(c, start) for c in step.columns), len(levels) - 1])
            at(latest).drop = step
            start = latest + 1
            after = {}
            continue
        for c in step.columns:
            i = max(after.get(c, start), start)
            at(i).changes[c] = step
            after[c] = i + 1
    return levels


def _fetched(df: DataFrame, level: _Level) -> dict[str, Column]:
    """The statistics of a level as literals of their types, from one job."""
    plain, modes, fences = [], {}, []
    for c, step in level.changes.items():
        if isinstance(step, Fill):
            rule = step.rules[c]
            if rule.statistic == MEAN:
                plain.append(F.avg(basis_of(df, c, rule)).alias(f"mean {c}"))
            elif rule.statistic == MODE:
                modes[f"mode {c}"] = (basis_of(df, c, rule), field(df, c).dataType)
        elif isinstance(step, Fence):
            fences.append(c)
        else:
            plain += _moments(df, c, step.ddof, "")
    for c in level.drop.columns if level.drop else ():
        plain += _moments(df, c, level.drop.ddof, "all ")
    parts = []
    if plain:
        parts.append(df.agg(*plain))
    if modes:
        parts.append(mode_stats(df, modes))
    if fences:
        parts.append(quantile_row(df, fences, {"q1": 0.25, "q3": 0.75}))
    if not parts:
        return {}
    one = df.sparkSession.range(1)
    whole = one.select(*[p.select(F.struct(*[col(c) for c in p.columns])).scalar().alias(str(i)) for i, p in enumerate(parts)]).first()
    found = {}
    for part, row in zip(parts, whole):
        found |= {f.name: F.lit(v).cast(f.dataType) for f, v in zip(part.schema, row or [None] * len(part.columns))}
    return found


def _moments(df: DataFrame, c: str, ddof: int, prefix: str) -> list[Column]:
    deviation = F.stddev_samp if ddof else F.stddev_pop
    value = present(df, c)
    return [F.avg(value).alias(f"{prefix}mean {c}"), deviation(value).alias(f"{prefix}deviation {c}")]


def _changed(df: DataFrame, c: str, step: Step, found: Mapping[str, Column]) -> Column:
    if isinstance(step, Fill):
        rule = step.rules[c]
        return repaired(df, c, rule, found[f"{rule.statistic} {c}"] if rule.statistic else None)
    if isinstance(step, Fence):
        q1, q3 = found[f"q1__{c}"], found[f"q3__{c}"]
        margin = (q3 - q1) * step.factor
        return F.when(present(df, c).between(q1 - margin, q3 + margin), present(df, c))
    return F.try_divide(present(df, c) - found[f"mean {c}"], found[f"deviation {c}"])


def chain(df: DataFrame, steps: Sequence[Step]) -> DataFrame:
    """All steps in order, as if each operator were applied to the result of the one before.

    Every level runs one job when this is called; the result is a frame over literals. The input
    is scanned once for each kind of statistic of a level and once for the result, and should
    therefore be a table rather than an expensive query. Steps on different columns share a
    level; one that drops rows is the last of its level.
    """
    for level in plan_levels(steps):
        found = _fetched(df, level)
        if level.drop:
            scores = [
                F.abs(F.try_divide(present(df, c) - found[f"all mean {c}"], found[f"all deviation {c}"])) <= level.drop.threshold
                for c in level.drop.columns
            ]
            df = df.filter(reduce(and_, [F.coalesce(s, F.lit(True)) for s in scores], F.lit(True)))
        if level.changes:
            df = replace_columns(df, {c: _changed(df, c, step, found) for c, step in level.changes.items()})
    return df
