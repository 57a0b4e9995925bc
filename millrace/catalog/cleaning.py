"""Missing values and outliers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.catalog.registry import LABELLED, labelled, mode_sql, query, table
from millrace.models import ImputedStringIndexer


@query(f"""
SELECT count(*) FILTER (doc_id IS NULL) AS doc_id, count(*) FILTER (text IS NULL) AS text,
       count(*) FILTER (lang IS NULL) AS lang, count(*) FILTER (source IS NULL) AS source,
       count(*) FILTER (n_chars IS NULL) AS n_chars, count(*) FILTER (quality IS NULL) AS quality,
       count(*) FILTER (toxic IS NULL) AS toxic, count(*) AS n_rows
FROM {LABELLED}
""")
def missing_profile(spark: SparkSession, sf: str) -> DataFrame:
    return op.missing_profile(labelled(spark, sf))


@query(f"""
SELECT doc_id, lang, n_chars, quality, toxic FROM {LABELLED}
WHERE quality IS NOT NULL AND toxic IS NOT NULL
""")
def drop_missing_rows(spark: SparkSession, sf: str) -> DataFrame:
    return op.drop_missing(labelled(spark, sf).select("doc_id", "lang", "n_chars", "quality", "toxic"))


@query(f"""
SELECT doc_id, coalesce(quality, m.q) AS quality, coalesce(toxic, m.t) AS toxic
FROM {LABELLED}, (SELECT avg(quality) AS q, avg(toxic) AS t FROM labels) m
""")
def impute_mean(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf).select("doc_id", "quality", "toxic")
    return op.impute(df, {"quality": "mean", "toxic": "mean"})


@query(f"""
SELECT doc_id, coalesce(quality, {mode_sql("quality", "labels")}) AS quality,
       coalesce(toxic, {mode_sql("toxic", "labels")}) AS toxic
FROM {LABELLED}
""")
def impute_mode(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf).select("doc_id", "quality", "toxic")
    return op.impute(df, {"quality": "mode", "toxic": "mode"})


@query(f"SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, 0) AS toxic FROM {LABELLED}")
def impute_constant(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf).select("doc_id", "quality", "toxic")
    return op.impute(df, {"quality": -1, "toxic": 0})


@query(f"""
WITH m AS (SELECT {mode_sql("l_linenumber", "lineitem", "l_linenumber <= 6")} AS v)
SELECT CASE WHEN l_linenumber > 6 THEN m.v ELSE l_linenumber END AS l_linenumber, count(*) AS n
FROM lineitem, m GROUP BY 1
""")
def impute_group_flag_clean(spark: SparkSession, sf: str) -> DataFrame:
    """Codes above 6 become the most frequent code up to 6; then rows per code."""
    df = op.replace_invalid(table(spark, sf, "lineitem"), ["l_linenumber"], lambda c: c <= 6)
    return op.value_counts(df, "l_linenumber")


@query(f"""
WITH f AS (SELECT doc_id, quality + toxic AS flag FROM {LABELLED})
SELECT doc_id, CASE WHEN flag IS NULL OR flag > 1 THEN {mode_sql("flag", "f", "flag <= 1")}
                    ELSE flag END AS flag
FROM f
""")
def clean_binary_flags(spark: SparkSession, sf: str) -> DataFrame:
    """A flag that may hold 2 or nothing is set to the most frequent of 0 and 1 there."""
    df = labelled(spark, sf).select("doc_id", (F.col("quality") + F.col("toxic")).alias("flag"))
    return op.clean_binary(df, ["flag"])


@query(f"""
SELECT event_id, CASE WHEN event_type = 'error'
                      THEN {mode_sql("event_type", "events", "event_type <> 'error'")}
                      ELSE event_type END AS event_type
FROM events
""")
def replace_one_code(spark: SparkSession, sf: str) -> DataFrame:
    """One code that counts as an outlier becomes the most frequent of the others."""
    df = table(spark, sf, "events").select("event_id", "event_type")
    return op.replace_invalid(df, ["event_type"], lambda c: c != "error")


@query("""
WITH m AS (SELECT avg(value) FILTER (value BETWEEN 0 AND 150) AS inner_mean, avg(value) AS mean,
                  avg(value) FILTER (value > 100) AS high_mean FROM events)
SELECT event_id,
       round(CASE WHEN value BETWEEN 0 AND 150 THEN value ELSE inner_mean END, 6) AS over_range,
       round(CASE WHEN value BETWEEN 0 AND 150 THEN value ELSE mean END, 6) AS over_all,
       round(CASE WHEN value >= 100 THEN value ELSE high_mean END, 6) AS over_condition
FROM events, m
""")
def replace_out_of_range_mean(spark: SparkSession, sf: str) -> DataFrame:
    """Values out of range set to three kinds of mean."""
    value = F.col("value")
    df = table(spark, sf, "events").select(
        "event_id", value.alias("over_range"), value.alias("over_all"), value.alias("over_condition")
    )
    rules = {
        "over_range": op.in_range(0, 150),
        "over_all": op.in_range(0, 150, over="all"),
        "over_condition": op.in_range(100, over=lambda c: c > 100),
    }
    df = op.repair(df, rules)
    return op.round_columns(df, ["over_range", "over_all", "over_condition"], 6)


_FENCED = """
WITH q AS (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM {t})
SELECT {k}, CASE WHEN {c} BETWEEN q1 - (q3 - q1) * 1.5::DOUBLE AND q3 + (q3 - q1) * 1.5::DOUBLE
                 THEN {c} END AS {c}
FROM {t}, q
"""


@query(_FENCED.format(t="events", k="event_id", c="value"))
def iqr_outliers_to_null(spark: SparkSession, sf: str) -> DataFrame:
    return op.iqr_to_null(table(spark, sf, "events").select("event_id", "value"), ["value"])


@query(_FENCED.format(t="documents", k="doc_id", c="n_chars"))
def iqr_outliers_whole_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return op.iqr_to_null(table(spark, sf, "documents").select("doc_id", "n_chars"), ["n_chars"])


@query("""
WITH m AS (SELECT avg(value) AS mean, stddev_pop(value) AS std FROM events)
SELECT event_id, value FROM events, m WHERE abs((value - mean) / std) <= 6
""")
def zscore_filter_any(spark: SparkSession, sf: str) -> DataFrame:
    return op.zscore_filter(table(spark, sf, "events").select("event_id", "value"), ["value"], 6)


@query("""
WITH m1 AS (SELECT avg(p_size) AS mean, stddev_samp(p_size) AS std FROM part),
p1 AS (SELECT p_partkey, p_size, p_retailprice FROM part, m1
       WHERE abs(p_size - mean) / std - 1.5 < 0.01),
m2 AS (SELECT avg(p_retailprice) AS mean, stddev_samp(p_retailprice) AS std FROM p1)
SELECT p_partkey, p_size, p_retailprice FROM p1, m2
WHERE abs(p_retailprice - mean) / std - 1.5 < 0.01
""")
def zscore_filter_sequential(spark: SparkSession, sf: str) -> DataFrame:
    """Column after column, each with the mean and deviation of the rows still there."""
    df = table(spark, sf, "part").select("p_partkey", "p_size", "p_retailprice")
    return op.zscore_filter_sequential(df, ["p_size", "p_retailprice"], 1.5, tolerance=0.01)


@query("SELECT doc_id, quality::BOOLEAN AS quality, toxic::BOOLEAN AS toxic FROM labels")
def narrow_booleans(spark: SparkSession, sf: str) -> DataFrame:
    return op.narrow_booleans(table(spark, sf, "labels"))


@query(f"""
SELECT doc_id, coalesce(quality, 0) + coalesce(toxic, 0) AS flags FROM {LABELLED}
""")
def row_sum_flags(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf)
    return op.row_sum(df, "flags", ["quality", "toxic"]).select("doc_id", "flags")


@query(f"""
WITH d AS (SELECT doc_id, CASE WHEN quality IS NOT NULL THEN lang END AS lang FROM {LABELLED}),
c AS (SELECT lang, row_number() OVER (ORDER BY count(*) DESC, lang) - 1 AS code
      FROM d WHERE lang IS NOT NULL GROUP BY lang)
SELECT doc_id, coalesce(c.code, 0)::DOUBLE AS lang_index FROM d LEFT JOIN c USING (lang)
""")
def impute_indexed_category(spark: SparkSession, sf: str) -> DataFrame:
    """A category indexed by frequency; the rows without one get the most frequent."""
    df = labelled(spark, sf).select("doc_id", F.when(F.col("quality").isNotNull(), F.col("lang")).alias("lang"))
    indexer = ImputedStringIndexer(inputCols=["lang"], outputCols=["lang_index"])
    return indexer.fit(df).transform(df).select("doc_id", "lang_index")


def _range_sql(source: str, lo: float, hi: float) -> str:
    mean = f"(SELECT avg(v) FROM {source} WHERE v BETWEEN {lo} AND {hi})"
    return f"SELECT event_id, kind, CASE WHEN v BETWEEN {lo} AND {hi} THEN v ELSE {mean} END AS v FROM {source}"


def _fence_sql(source: str, factor: float) -> str:
    q = f"SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM {source}"
    return f"""SELECT event_id, kind, CASE WHEN v BETWEEN a - {factor} * (b - a) AND b + {factor} * (b - a) THEN v END AS v
      FROM {source}, ({q})"""


@query(f"""
WITH s0 AS (
  SELECT event_id, value AS v,
    CASE WHEN event_type IN ('view', 'click') THEN event_type ELSE (
      SELECT event_type FROM events WHERE event_type IN ('view', 'click') GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) END AS kind
  FROM events),
s1 AS ({_range_sql("s0", 2, 150)}),
s2 AS ({_fence_sql("s1", 0.75)}),
s3 AS (SELECT event_id, kind, coalesce(v, (SELECT avg(v) FROM s2)) AS v FROM s2),
s4 AS (SELECT * FROM s3 WHERE coalesce(
  abs(v - (SELECT avg(v) FROM s3)) / nullif((SELECT stddev_pop(v) FROM s3), 0) <= 1.5, true)),
s5 AS ({_range_sql("s4", 1, 50)}),
s6 AS ({_fence_sql("s5", 0.5)}),
s7 AS (SELECT event_id, kind, coalesce(v, (SELECT avg(v) FROM s6)) AS v FROM s6)
SELECT event_id, kind AS event_type,
  round((v - (SELECT avg(v) FROM s7)) / nullif((SELECT stddev_samp(v) FROM s7), 0), 6) + 0.0 AS value
FROM s7
""")
def stacked_repairs(spark: SparkSession, sf: str) -> DataFrame:
    """Eight steps on one column, each with statistics of what the one before left, and one on another."""
    df = table(spark, sf, "events").select("event_id", "event_type", "value")
    steps = [
        op.Fill({"value": op.in_range(2, 150), "event_type": op.valid_code(lambda c: c.isin("view", "click"))}),
        op.Fence(["value"], 0.75),
        op.Fill({"value": op.Repair("mean")}),
        op.DropUnusual(["value"], 1.5),
        op.Fill({"value": op.in_range(1, 50)}),
        op.Fence(["value"], 0.5),
        op.Fill({"value": op.Repair("mean")}),
        op.Scale(["value"]),
    ]
    cleaned = op.chain(df, steps)
    return cleaned.withColumn("value", F.round("value", 6) + 0.0)
