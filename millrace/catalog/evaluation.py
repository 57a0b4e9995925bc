"""Scores of a simple rule (long documents are good ones) against the labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import models
from millrace.catalog.registry import query, table
from millrace.operators.order_statistics import quantile_row
from millrace.operators.statistics import stat, with_stats

_P = """
WITH d AS (SELECT doc_id, n_chars, quality AS label FROM documents JOIN labels USING (doc_id)),
p AS (SELECT *, (n_chars > (SELECT quantile_cont(n_chars, 0.5) FROM d))::INTEGER AS prediction FROM d)
"""


def _labelled_only(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", F.col("quality").alias("label"))
    return table(spark, sf, "documents").select("doc_id", "n_chars").join(labels, "doc_id")


def _predicted(spark: SparkSession, sf: str) -> DataFrame:
    df = _labelled_only(spark, sf)
    df = with_stats(df, quantile_row(df, ["n_chars"], {"median": 0.5}))
    long = (F.col("n_chars") > stat("median__n_chars")).cast("int")
    return df.select("doc_id", "n_chars", "label", long.alias("prediction"))


@query(f"{_P} SELECT label, prediction, count(*) AS n FROM p GROUP BY 1, 2")
def confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return models.confusion_matrix(_predicted(spark, sf))


@query(f"""{_P} SELECT label, count(*) FILTER (prediction = 0) AS "0",
count(*) FILTER (prediction = 1) AS "1" FROM p GROUP BY 1""")
def confusion_pivot(spark: SparkSession, sf: str) -> DataFrame:
    return models.confusion_pivot(_predicted(spark, sf), [0, 1])


@query(f"{_P} SELECT (count(*) FILTER (label = prediction))::DOUBLE / count(*) AS accuracy FROM p")
def accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return models.accuracy(_predicted(spark, sf))


_SCORES = """
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall)
               ELSE 0 END AS f1 FROM (
  SELECT *, CASE WHEN predicted > 0 THEN tp::DOUBLE / predicted ELSE 0 END AS precision,
            CASE WHEN support > 0 THEN tp::DOUBLE / support ELSE 0 END AS recall
"""


@query(f"""{_P}, c AS (SELECT count(*) FILTER (label = 1 AND prediction = 1) AS tp,
  count(*) FILTER (prediction = 1) AS predicted, count(*) FILTER (label = 1) AS support,
  (count(*) FILTER (label = prediction))::DOUBLE / count(*) AS accuracy FROM p)
SELECT round(accuracy, 9) AS accuracy, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1 FROM ({_SCORES} FROM c))
""")
def binary_report(spark: SparkSession, sf: str) -> DataFrame:
    df = models.binary_report(_predicted(spark, sf))
    return df.select(*[F.round(c, 9).alias(c) for c in df.columns])


@query(f"""{_P}, c AS (
  SELECT k.class, count(*) FILTER (label = k.class AND prediction = k.class) AS tp,
         count(*) FILTER (prediction = k.class) AS predicted,
         count(*) FILTER (label = k.class) AS support
  FROM p, (SELECT label AS class FROM p UNION SELECT prediction FROM p) k GROUP BY 1),
s AS ({_SCORES} FROM c))
SELECT class::VARCHAR AS class, round(precision, 9) AS precision, round(recall, 9) AS recall,
       round(f1, 9) AS f1, support FROM s
UNION ALL
SELECT 'macro avg', round(avg(precision), 9), round(avg(recall), 9), round(avg(f1), 9),
       sum(support)::BIGINT FROM s
UNION ALL
SELECT 'weighted avg', round(sum(precision * support) / sum(support), 9),
       round(sum(recall * support) / sum(support), 9),
       round(sum(f1 * support) / sum(support), 9), sum(support)::BIGINT FROM s
""")
def classification_report(spark: SparkSession, sf: str) -> DataFrame:
    df = models.classification_report(_predicted(spark, sf))
    scores = [F.round(c, 9).alias(c) for c in ("precision", "recall", "f1")]
    return df.select("class", *scores, "support")


@query(f"""{_P}, r AS (SELECT label, rank() OVER (ORDER BY n_chars)
                       + (count(*) OVER (PARTITION BY n_chars) - 1) / 2.0::DOUBLE AS r FROM p),
n AS (SELECT count(*) FILTER (label = 1) AS pos, count(*) FILTER (label <> 1) AS neg FROM p)
SELECT round(((SELECT sum(r) FROM r WHERE label = 1) - pos * (pos + 1) / 2::DOUBLE)
             / (pos::DOUBLE * neg), 10) AS auc FROM n
""")
def auc_rank(spark: SparkSession, sf: str) -> DataFrame:
    """Area under the ROC curve of the length as a score."""
    return models.auc(_labelled_only(spark, sf), "n_chars").select(F.round("auc", 10).alias("auc"))


@query("""
WITH d AS (SELECT value, event_type = 'purchase' AS hit FROM events),
c AS (SELECT d.value, count(*) FILTER (hit) AS pos, count(*) FILTER (NOT hit) AS neg FROM d GROUP BY 1),
b AS (SELECT *, coalesce(sum(neg) OVER (ORDER BY value ROWS BETWEEN UNBOUNDED PRECEDING
                                        AND 1 PRECEDING), 0) AS below FROM c)
SELECT round(sum(pos * (below + neg / 2.0::DOUBLE)) / (sum(pos)::DOUBLE * sum(neg)), 10) AS auc FROM b
""")
def auc_events(spark: SparkSession, sf: str) -> DataFrame:
    """The same over a score with many distinct values."""
    df = table(spark, sf, "events").select("value", "event_type")
    return models.auc(df, "value", "event_type", "purchase").select(F.round("auc", 10).alias("auc"))


_RULES = {"production": 500, "max": 1000, "product": 2000}


def _rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Accuracy of three threshold rules, from one scan: rows (model, value)."""
    df = _labelled_only(spark, sf)
    hits = [
        F.avg(((F.col("n_chars") > limit).cast("int") == F.col("label")).cast("double")).alias(name)
        for name, limit in _RULES.items()
    ]
    pairs = [F.struct(F.lit(n).alias("model"), F.col(n).alias("value")) for n in _RULES]
    return df.agg(*hits).select(F.explode(F.array(*pairs)).alias("p")).select("p.*")


def _hits_sql(limit: int) -> str:
    return (
        f"(SELECT (count(*) FILTER ((n_chars > {limit})::INTEGER = quality))::DOUBLE / count(*)"
        " FROM documents JOIN labels USING (doc_id))"
    )


_M = f"""
WITH m AS (SELECT {_hits_sql(500)} AS a, {_hits_sql(1000)} AS b, {_hits_sql(2000)} AS c)
"""


@query(f"""{_M}
SELECT CASE WHEN b > c THEN 'max' ELSE 'product' END AS best_challenger, greatest(b, c) AS best_value,
       a AS champion_value, CASE WHEN greatest(b, c) - a < -0.01 THEN 'do_nothing'
                                 WHEN b > c THEN 'max' ELSE 'product' END AS decision FROM m
""")
def champion_challenger(spark: SparkSession, sf: str) -> DataFrame:
    return models.decide(_rule_scores(spark, sf), "production", ["max", "product"], tolerance=0.01)


@query(f"""{_M}
SELECT model, value FROM (SELECT 'production' AS model, a AS value FROM m UNION ALL
SELECT 'max', b FROM m UNION ALL SELECT 'product', c FROM m) ORDER BY value DESC, model LIMIT 1
""")
def best_of_scores(spark: SparkSession, sf: str) -> DataFrame:
    return models.select_best(_rule_scores(spark, sf))
