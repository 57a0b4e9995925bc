"""Column references, type-driven column selection and the missing-value rule."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

INTEGERS = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATS = (T.FloatType, T.DoubleType)
NUMERICS = INTEGERS + FLOATS + (T.DecimalType,)
STRINGS = (T.StringType,)


def quoted(name: str) -> str:
    """Back-quote a column name, so that dots, blanks and signs in it are literal."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    """The top-level column called exactly `name`."""
    return F.col(quoted(name))


def field(df: DataFrame, name: str) -> T.StructField:
    return df.schema[name]


def columns_of(
    df: DataFrame, types: type | Sequence[type], exclude: Iterable[str] = ()
) -> list[str]:
    """Names of the columns whose type is one of `types`, in schema order."""
    wanted = tuple(types) if isinstance(types, (list, tuple)) else (types,)
    skipped = set(exclude)
    return [f.name for f in df.schema if isinstance(f.dataType, wanted) and f.name not in skipped]


def missing_test(c: Column, data_type: T.DataType) -> Column:
    """True for null and, in floating-point columns only, for NaN; never null itself."""
    if isinstance(data_type, FLOATS):
        return c.isNull() | F.isnan(c)
    return c.isNull()


def is_missing(df: DataFrame, name: str) -> Column:
    return missing_test(col(name), field(df, name).dataType)


def present(df: DataFrame, name: str) -> Column:
    """The column with NaN turned into null, so that aggregates skip both."""
    if isinstance(field(df, name).dataType, FLOATS):
        return F.nanvl(col(name), F.lit(None).cast(field(df, name).dataType))
    return col(name)
