"""Used cars: CSV, JSON and XML files under one schema, rounded, one row per model."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace import operators as op
from millrace.sources import ingest_union, read_parquet, write_parquet

SCHEMA = "car_model string, year_of_manufacture int, price double, fuel string"
FORMATS = ("csv", "json", "xml")


def extract(spark: SparkSession, folder: str) -> DataFrame:
    return ingest_union(spark, {kind: f"{folder}/*.{kind}" for kind in FORMATS}, SCHEMA)


def transform(df: DataFrame, order_by: tuple[str, ...] = ("year_of_manufacture", "price")) -> DataFrame:
    """Prices with two digits; of each model the first car in the given order.

    Files have no order among each other, so the columns that decide are named.
    """
    return op.dedup_first(op.round_columns(df, ["price"], 2), ["car_model"], list(order_by))


def run(spark: SparkSession, folder: str, target: str) -> DataFrame:
    write_parquet(transform(extract(spark, folder)), target)
    return read_parquet(spark, target)
