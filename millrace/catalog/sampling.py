"""Samples, splits and folds."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.catalog.registry import query, table, uniform_sql


@query(f"SELECT doc_id, lang FROM documents WHERE {uniform_sql('doc_id', 42)} < 0.01::DOUBLE")
def hash_sample(spark: SparkSession, sf: str) -> DataFrame:
    """One per cent of the rows."""
    return op.sample(table(spark, sf, "documents").select("doc_id", "lang"), 0.01, "doc_id", 42)


@query(f"""
SELECT doc_id, CASE WHEN {uniform_sql('doc_id', 7576)} < 0.8::DOUBLE THEN 'train' ELSE 'test' END AS part
FROM documents
""")
def hash_split(spark: SparkSession, sf: str) -> DataFrame:
    """Two disjoint parts that together are the table."""
    docs = table(spark, sf, "documents").select("doc_id")
    train, test = op.random_split(docs, [0.8, 0.2], "doc_id", 7576)
    return op.union_all(
        [train.withColumn("part", F.lit("train")), test.withColumn("part", F.lit("test"))]
    )


@query(f"""
SELECT floor({uniform_sql('doc_id', 11)} * 5)::INTEGER AS fold, count(*) AS n FROM documents GROUP BY 1
""")
def kfold_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows per fold of five."""
    return op.value_counts(op.kfold(table(spark, sf, "documents"), 5, "doc_id", 11), "fold")


@query(f"""
SELECT doc_id, quality, row_number() OVER (PARTITION BY quality ORDER BY {uniform_sql('doc_id', 42)},
       doc_id) <= round(count(*) OVER (PARTITION BY quality) * 0.1::DOUBLE) AS is_test
FROM labels
""")
def stratified_split(spark: SparkSession, sf: str) -> DataFrame:
    """A tenth of the rows of each label, to the row."""
    df = table(spark, sf, "labels").select("doc_id", "quality")
    return op.stratified_column(df, "quality", 0.1, "doc_id", 42)


@query(f"""
SELECT event_type, count(*) FILTER (is_test) AS n_test, count(*) AS n FROM (
  SELECT event_type, row_number() OVER (PARTITION BY event_type ORDER BY {uniform_sql('event_id', 1)},
         event_id) <= round(count(*) OVER (PARTITION BY event_type) * 0.25::DOUBLE) AS is_test
  FROM events) GROUP BY 1
""")
def stratified_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Sizes of the two parts of a stratified split of a larger table."""
    df = table(spark, sf, "events").select("event_id", "event_type")
    train, test = op.stratified_split(df, "event_type", 0.25, "event_id", 1)
    both = op.union_all(
        [train.withColumn("test", F.lit(False)), test.withColumn("test", F.lit(True))]
    )
    return both.groupBy("event_type").agg(
        F.count_if("test").alias("n_test"), F.count("*").alias("n")
    )
