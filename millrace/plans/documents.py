"""The flagship query: clean, impute, look up, aggregate."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.sources import literal_table, read_parquet

# Expected share of flagged documents by length, where no label says it.
LENGTH_BANDS = [
    (0.0, 500.0, 0.2),
    (501.0, 2000.0, 0.4),
    (2001.0, 6000.0, 0.6),
    (6001.0, None, 0.8),
]


def flagged_share_by_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows (lang, rate, mean_length): documents flagged, after repair and imputation."""
    columns = ["doc_id", "lang", "n_chars"]
    documents = read_parquet(spark, f"{sf_dir}/documents.parquet").select(*columns)
    labels = read_parquet(spark, f"{sf_dir}/labels.parquet")
    documents = op.repair(documents, {"n_chars": op.in_range(1, 20_000)})
    df = documents.join(labels, "doc_id", "left")
    df = op.impute(df, {"toxic": "mode"}, fitted_on=labels)
    bands = literal_table(spark, LENGTH_BANDS, "lo double, hi double, rate double")
    df = op.impute_bernoulli(df, "quality", bands, "n_chars", "doc_id", seed=42)
    flagged = (F.col("quality") == 1) | (F.col("toxic") == 1)
    return df.groupBy("lang").agg(
        F.avg(flagged.cast("double")).alias("rate"), F.avg("n_chars").alias("mean_length")
    )
