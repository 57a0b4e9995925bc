"""Band lookups, imputation by rates, and the outer join with a reference table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import operators as op
from millrace.catalog.registry import (
    LABELLED,
    labelled,
    mode_sql,
    query,
    table,
    uniform_sql,
    values_sql,
)
from millrace.plans import documents
from millrace.plans.documents import LENGTH_BANDS
from millrace.sources import literal_table

_BAND = (["DOUBLE"] * 3, ["lo", "hi", "rate"])
_BALANCE = [(-1000.0, 0.0, 0.05), (0.01, 2000.0, 0.2), (2000.01, 5000.0, 0.35), (8000.0, None, 0.6)]
_LENGTH = [(0.0, 500.0, 0.2), (501.0, 2000.0, 0.5), (2001.0, 6000.0, 0.7), (8001.0, None, 0.9)]
_OTHER = [(0.0, 1000.0, 0.4), (1001.0, None, 0.6)]
_LANGUAGES = {"en": 1.0, "fr": 1.25, "de": 0.5}
_SEGMENTS = {"BUILDING": 1.0, "MACHINERY": 1.25}


def _bands(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return literal_table(spark, rows, "lo double, hi double, rate double")


def _groups_sql(ratios: dict[str, float], name: str) -> str:
    return values_sql(list(ratios.items()), ["VARCHAR", "DOUBLE"], [name, "ratio"])


def _inside(x: str, b: str) -> str:
    return f"{x} >= {b}.lo AND ({b}.hi IS NULL OR {x} <= {b}.hi)"


_BALANCE_SQL = values_sql(_BALANCE, *_BAND)
_LENGTH_SQL = values_sql(_LENGTH, *_BAND)
_OTHER_SQL = values_sql(_OTHER, *_BAND)


@query(f"""
SELECT c_custkey, c_acctbal, b.rate FROM customer LEFT JOIN {_BALANCE_SQL} b
ON {_inside("c_acctbal", "b")}
""")
def range_lookup_rate(spark: SparkSession, sf: str) -> DataFrame:
    """The rate of the band a balance lies in; none in the gap between two bands."""
    df = table(spark, sf, "customer").select("c_custkey", "c_acctbal")
    return op.range_lookup(df, _bands(spark, _BALANCE), "c_acctbal")


@query(f"""
SELECT c_custkey, c_mktsegment, b.rate * g.ratio AS rate
FROM customer LEFT JOIN ({_BALANCE_SQL} b CROSS JOIN {_groups_sql(_SEGMENTS, "segment")} g)
ON c_mktsegment = g.segment AND {_inside("c_acctbal", "b")}
""")
def range_lookup_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """As before, with bands per segment made from the first segment's by a ratio."""
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    bands = op.rates_by_group(_bands(spark, _BALANCE), "c_mktsegment", _SEGMENTS)
    return op.range_lookup(df, bands, "c_acctbal", by=["c_mktsegment"]).drop("c_acctbal")


@query("""
SELECT o_orderkey, s.s_acctbal AS rate FROM orders LEFT JOIN supplier s
ON o_totalprice >= (s.s_suppkey - 1) * 5000::DOUBLE AND o_totalprice <= (s.s_suppkey - 1) * 5000::DOUBLE + 4000
""")
def range_lookup_many_bands(spark: SparkSession, sf: str) -> DataFrame:
    """A band table that grows with the data, joined by bins."""
    lo = (F.col("s_suppkey") - 1) * F.lit(5000.0)
    bands = table(spark, sf, "supplier").select(
        lo.alias("lo"), (lo + 4000).alias("hi"), F.col("s_acctbal").alias("rate")
    )
    df = table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return op.range_lookup(df, bands, "o_totalprice").drop("o_totalprice")


@query(f"""
SELECT doc_id, CASE WHEN quality IS NOT NULL THEN quality
                    WHEN {uniform_sql("doc_id", "s1")} <= b.rate THEN 1
                    WHEN b.rate IS NOT NULL THEN 0 END AS quality
FROM {LABELLED} LEFT JOIN {_LENGTH_SQL} b ON {_inside("n_chars", "b")}
""")
def impute_bernoulli_band(spark: SparkSession, sf: str) -> DataFrame:
    """A missing flag drawn with the rate of the document's length band."""
    df = labelled(spark, sf).select("doc_id", "n_chars", "quality")
    df = op.impute_bernoulli(df, "quality", _bands(spark, _LENGTH), "n_chars", "doc_id", "s1")
    return df.drop("n_chars")


_DRAWN = f"""
SELECT doc_id, quality,
       CASE WHEN quality IS NOT NULL THEN quality
            WHEN {uniform_sql("doc_id", "s1")} <= b.rate THEN 1
            WHEN b.rate IS NOT NULL THEN 0 END AS source_1,
       CASE WHEN quality IS NOT NULL THEN quality
            WHEN {uniform_sql("doc_id", "s2")} <= o.rate * g.ratio THEN 1
            WHEN o.rate * g.ratio IS NOT NULL THEN 0 END AS source_2
FROM {LABELLED} d
LEFT JOIN {_LENGTH_SQL} b ON {_inside("n_chars", "b")}
LEFT JOIN ({_OTHER_SQL} o CROSS JOIN {_groups_sql(_LANGUAGES, "l")} g)
ON d.lang = g.l AND {_inside("n_chars", "o")}
"""


def _drawn(spark: SparkSession, sf: str) -> DataFrame:
    df = labelled(spark, sf).select("doc_id", "lang", "n_chars", "quality")
    df = op.copy_column(df, "quality", "source_1", "source_2")
    df = op.impute_bernoulli(df, "source_1", _bands(spark, _LENGTH), "n_chars", "doc_id", "s1")
    by_language = op.rates_by_group(_bands(spark, _OTHER), "lang", _LANGUAGES)
    return op.impute_bernoulli(
        df, "source_2", by_language, "n_chars", "doc_id", "s2", by=["lang"]
    )


@query(f"SELECT doc_id, source_2 FROM ({_DRAWN})")
def impute_bernoulli_by_group(spark: SparkSession, sf: str) -> DataFrame:
    """A missing flag drawn with the rate of the language's length band."""
    return _drawn(spark, sf).select("doc_id", "source_2")


@query(f"""
SELECT doc_id, coalesce(quality, CASE WHEN source_1 + source_2 >= 1 THEN 1 ELSE 0 END) AS quality
FROM ({_DRAWN})
""")
def impute_votes(spark: SparkSession, sf: str) -> DataFrame:
    """A missing flag is set if at least one of two drawn sources sets it."""
    df = op.impute_from_votes(_drawn(spark, sf), "quality", ["source_1", "source_2"])
    return df.select("doc_id", "quality")


@query(f"""
SELECT doc_id, (b.rate + o.rate * g.ratio * 0.5::DOUBLE) / 2 AS rate
FROM {LABELLED} d
LEFT JOIN {_LENGTH_SQL} b ON {_inside("n_chars", "b")}
LEFT JOIN ({_OTHER_SQL} o CROSS JOIN {_groups_sql(_LANGUAGES, "l")} g)
ON d.lang = g.l AND {_inside("n_chars", "o")}
""")
def mean_of_two_rates(spark: SparkSession, sf: str) -> DataFrame:
    """The mean of the rates two band tables give for a document, the second one halved."""
    df = table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    second = op.scale_rates(op.rates_by_group(_bands(spark, _OTHER), "lang", _LANGUAGES), 0.5)
    sources = [(_bands(spark, _LENGTH), "n_chars", []), (second, "n_chars", ["lang"])]
    return op.mean_of_rates(df, "rate", sources).select("doc_id", "rate")


@query(f"""
WITH d AS (
  SELECT doc_id, lang, quality, coalesce(toxic, {mode_sql("toxic", "labels")}) AS toxic,
         CASE WHEN n_chars BETWEEN 1 AND 20000 THEN n_chars ELSE m.mean END AS n_chars
  FROM {LABELLED}, (SELECT avg(n_chars) FILTER (n_chars BETWEEN 1 AND 20000) AS mean FROM documents) m),
f AS (
  SELECT d.*, CASE WHEN quality IS NOT NULL THEN quality
                   WHEN {uniform_sql("doc_id", 42)} <= b.rate THEN 1
                   WHEN b.rate IS NOT NULL THEN 0 END AS filled
  FROM d LEFT JOIN {values_sql(LENGTH_BANDS, *_BAND)} b ON {_inside("n_chars", "b")})
SELECT lang, round(avg((filled = 1 OR toxic = 1)::INTEGER), 9) AS rate,
       round(avg(n_chars), 6) AS mean_length
FROM f GROUP BY lang
""")
def flagged_share_by_language(spark: SparkSession, sf: str) -> DataFrame:
    """The flagship: clean, impute, look up, aggregate."""
    df = documents.flagged_share_by_language(spark, sf)
    return op.round_columns(op.round_columns(df, ["rate"], 9), ["mean_length"], 6)


_SHARES = """
SELECT c_mktsegment AS segment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance
FROM customer WHERE c_mktsegment <> 'AUTOMOBILE' GROUP BY 1 UNION ALL SELECT 'NONE', 0, 0.0
"""


def _shares(spark: SparkSession, sf: str) -> DataFrame:
    """Numbers of the customers of each segment but one, and of a segment without customers."""
    known = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "AUTOMOBILE")
    shares = known.groupBy(F.col("c_mktsegment").alias("segment")).agg(
        F.count("*").alias("customers"), F.round(F.sum("c_acctbal"), 2).alias("balance")
    )
    none = literal_table(spark, [("NONE", 0, 0.0)], "segment string, customers bigint, balance double")
    return op.union_all([shares, none])


@query(f"""
SELECT c_custkey, c_mktsegment, segment, customers, balance
FROM customer FULL OUTER JOIN ({_SHARES}) ON c_mktsegment = segment
""")
def join_reference_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Full outer join with a small table: one of its rows, and some of the others, have no match."""
    df = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return op.join_reference(df, _shares(spark, sf), ("c_mktsegment", "segment"))


@query("""
SELECT l_orderkey, l_linenumber, o_custkey, o_totalprice
FROM lineitem FULL OUTER JOIN orders ON l_orderkey = o_orderkey AND l_orderkey % 3 <> 0
""")
def join_reference_large(spark: SparkSession, sf: str) -> DataFrame:
    """Full outer join with a table that grows with the data; a third of the rows have no key."""
    key = F.when(F.col("l_orderkey") % 3 != 0, F.col("l_orderkey")).alias("key")
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", key)
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    return op.join_reference(df, orders, ("key", "o_orderkey")).drop("key", "o_orderkey")


_EVENT_BANDS = """
SELECT event_type AS kind, user_id * 10.0 AS lo, user_id * 10.0 + 6 AS hi, count(*) AS rate
FROM events GROUP BY 1, user_id
"""


@query(f"""
SELECT event_id, b.rate
FROM (SELECT event_id, CASE WHEN event_id % 5 > 0 THEN event_type END AS kind,
             CASE WHEN event_id % 4 = 0 THEN 12.0 WHEN event_id % 4 = 1 THEN NULL ELSE user_id * 10.0 + value END AS x
      FROM events) e
LEFT JOIN ({_EVENT_BANDS}) b ON e.kind = b.kind AND e.x BETWEEN b.lo AND b.hi
""")
def range_lookup_many_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Many bands in several groups; one value in a quarter of the rows, and missing ones."""
    df = table(spark, sf, "events")
    ten = F.col("user_id") * F.lit(10.0)
    bands = df.groupBy(F.col("event_type").alias("kind"), "user_id").agg(F.count("*").alias("rate"))
    bands = bands.select("kind", ten.alias("lo"), (ten + 6).alias("hi"), "rate")
    x = F.when(F.col("event_id") % 4 == 0, 12.0).when(F.col("event_id") % 4 > 1, ten + F.col("value"))
    kind = F.when(F.col("event_id") % 5 > 0, F.col("event_type"))
    rows = df.select("event_id", kind.alias("kind"), x.alias("x"))
    return op.range_lookup(rows, bands, "x", by=["kind"]).select("event_id", "rate")
