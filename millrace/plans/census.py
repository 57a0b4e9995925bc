"""Census records: fixed-schema CSV, profile, features, group average, reference join."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace import operators as op
from millrace.functions import columns_of
from millrace.sources import literal_table, read_csv, write_csv

# The file layout (numbers read as float are whole), and the share of men and
# women by marital status.
SCHEMA = """
    age int, workclass string, fnlwgt float, education string, education_num float,
    marital_status string, occupation string, relationship string, race string, sex string,
    capital_gain float, capital_loss float, hours_per_week float, native_country string,
    income string
"""
MARITAL_STATUS = [
    ("Never-married", 47.35, 41.81),
    ("Married-AF-spouse", 67.54, 68.33),
    ("Widowed", 3.58, 11.61),
    ("Divorced", 10.82, 15.09),
]
MARITAL_STATUS_SCHEMA = "marital_status_statistics string, male double, female double"


def read_census(spark: SparkSession, path: str) -> DataFrame:
    """Whole numbers as integers, strings without blanks around them."""
    df = read_csv(spark, path, SCHEMA, strip=True)
    return op.trim_strings(op.cast_where(df, T.FloatType, "int"))


def with_products(df: DataFrame) -> DataFrame:
    """Add the products of all pairs of integer columns, squares included, as `a_x_b`."""
    return op.pairwise(df, columns_of(df, T.IntegerType), squares=True)


def average_gain(df: DataFrame) -> DataFrame:
    """Average capital gain by marital status."""
    return op.group_avg(df, ["marital_status"], "capital_gain")


def with_reference(df: DataFrame) -> DataFrame:
    ref = literal_table(df.sparkSession, MARITAL_STATUS, MARITAL_STATUS_SCHEMA)
    return op.join_reference(df, ref, ("marital_status", "marital_status_statistics"))


def run(spark: SparkSession, source: str, target: str) -> dict[str, DataFrame]:
    """Write the transformed records to `target`; the reports are returned unevaluated."""
    raw = read_census(spark, source)
    clean = with_products(op.drop_missing(raw))
    write_csv(with_reference(clean), target)
    return {
        "missing": op.missing_profile(raw),
        "average_gain": average_gain(clean),
        "divorced": clean.filter(F.col("marital_status") == "Divorced"),
    }
