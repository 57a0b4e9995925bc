"""Words that occur often in text files, and a sample of a CSV file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace import operators as op
from millrace.sources import read_csv, read_text, write_csv, write_text


def frequent_words(spark: SparkSession, source: str, min_count: int = 3) -> DataFrame:
    return op.word_count(read_text(spark, source), min_count=min_count)


def run_word_count(spark: SparkSession, source: str, target: str, files: int | None = None) -> None:
    """Write word and count, one per line; into one file only if `files` says so."""
    write_text(frequent_words(spark, source), target, partitions=files)


def run_sampling(
    spark: SparkSession,
    source: str,
    target: str,
    key: str | None = None,
    fraction: float = 0.01,
    seed: int = 42,
) -> None:
    """Write a sample of a CSV file, with header, chosen by a key column if it has one."""
    df = read_csv(spark, source)
    write_csv(op.sample(df, fraction, key, seed), target)
