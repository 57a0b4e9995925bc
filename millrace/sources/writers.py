"""Sinks. All write from the tasks; nothing passes through the driver."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col


def _partitioned(df: DataFrame, partitions: int | None) -> DataFrame:
    """Fewer output files by merging partitions, more by a shuffle; as they are by default."""
    if partitions is None:
        return df
    return df.coalesce(1) if partitions == 1 else df.repartition(partitions)


def partition_count(df: DataFrame) -> int:
    """How many partitions the frame's plan ends in; nothing is computed."""
    return df.rdd.getNumPartitions()


def write_csv(
    df: DataFrame, path: str, header: bool = True, partitions: int | None = None, **options: object
) -> None:
    """CSV that `read_csv` reads back unchanged; values with line breaks need its `multi_line`.

    An empty text and a null are both read as null, unless both sides set `nullValue`.
    """
    kept = {"escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer = _partitioned(df, partitions).write.mode("overwrite")
    writer.options(header=header, **{**kept, **options}).csv(path)


def write_json(df: DataFrame, path: str, partitions: int | None = None) -> None:
    _partitioned(df, partitions).write.mode("overwrite").json(path)


def write_xml(
    df: DataFrame,
    path: str,
    row_tag: str = "row",
    root_tag: str = "root",
    partitions: int | None = None,
) -> None:
    writer = _partitioned(df, partitions).write.mode("overwrite").format("xml")
    writer.options(rowTag=row_tag, rootTag=root_tag).save(path)


def write_parquet(df: DataFrame, path: str, partitions: int | None = None) -> None:
    _partitioned(df, partitions).write.mode("overwrite").parquet(path)


def write_text(
    df: DataFrame, path: str, sep: str = "\t", partitions: int | None = None
) -> None:
    """One line per row, columns joined by `sep`. One file only for results known to be small.

    Inside a value a backslash, the separator and line breaks are written as a backslash and a
    sign (`\\\\`, `\\s`, `\\n`, `\\r`), and null is `\\N`; `split_lines` turns them back.
    """
    line = F.concat_ws(sep, *[_escaped(col(c).cast("string"), sep) for c in df.columns])
    _partitioned(df.select(line.alias("value")), partitions).write.mode("overwrite").text(path)


def _escaped(value: Column, sep: str) -> Column:
    for sign, code in (("\\", "\\\\"), (sep, "\\s"), ("\n", "\\n"), ("\r", "\\r")):
        value = F.replace(value, F.lit(sign), F.lit(code))
    return F.coalesce(value, F.lit("\\N"))


def write_jdbc(df: DataFrame, url: str, table: str, **options: str) -> None:
    """Replace a database table. Connection options are arguments; nothing is stored."""
    writer = df.write.format("jdbc").mode("overwrite")
    writer.options(url=url, dbtable=table, **options).save()
