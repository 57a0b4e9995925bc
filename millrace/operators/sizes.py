"""Size checks that stand before every broadcast of a frame whose size is not fixed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col

MAX_ROWS = 10_000
MAX_BYTES = 32 << 20


def fits_broadcast(df: DataFrame, rows: int = MAX_ROWS, size: int = MAX_BYTES) -> bool:
    """Whether a frame has at most `rows` rows of together at most `size` bytes (as text).

    Runs one job, a global count and sum that every task reduces to one row.
    """
    text = F.to_json(F.struct(*[col(c) for c in df.columns]))
    n, used = df.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    return n <= rows and (used or 0) <= size


def few_groups(df: DataFrame, keys: Sequence[str]) -> bool:
    """Whether a table with one short row per distinct key can be broadcast."""
    return not keys or fits_broadcast(df.select(*[col(k) for k in keys]).distinct())


def broadcast_if(small: bool, df: DataFrame) -> DataFrame:
    """Mark a checked frame for broadcast; leave any other to the planner."""
    return F.broadcast(df) if small else df
