"""Intermediate tables in the shared folder."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources.scratch import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


@contextmanager
def _settings(spark: SparkSession, **values: str):
    before = {k: spark.conf.get(k) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def written(df: DataFrame, label: str, rows_per_batch: int | None = None, rows_per_group: int | None = None) -> DataFrame:
    """`df` as a table in the folder of `spark.checkpoint.dir`, read again.

    This cuts the lineage: executors lost later cost no more than reading the table anew. The
    shuffle files of the job are deleted with its end, as all of its rows are in the table then.
    `rows_per_batch` says how many rows go to Python at a time, where rows are large, and
    `rows_per_group` how many are written and read at a time: a task holds a whole group of rows of a Parquet
    file when it writes one, and up to 4,096 rows of a group when it reads.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    settings = {_CLEANUP: "true"}
    if rows_per_batch:
        settings[_BATCH] = str(rows_per_batch)
    with _settings(spark, **settings):
        writer = df.write.option("compression", "zstd")
        if rows_per_group:
            writer = writer.option("parquet.block.row.count.limit", str(rows_per_group))
        writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows, and bytes of all values as text; one job whose tasks return one row each."""
    text = F.to_json(F.struct("*"))
    n, size = df.agg(F.count("*"), F.sum(F.octet_length(text))).first()
    return n, size or 0
