"""Derived features, scaling and category codes."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import models
from millrace import operators as op
from millrace.catalog.registry import query, table, uniform_sql
from millrace.functions import hash_uniform
from millrace.models import assemble, standard_scale


@query("""
SELECT event_id, round((value - (SELECT avg(value) FROM events))
                       / (SELECT stddev_samp(value) FROM events), 8) AS value_score
FROM events
""")
def standardize_value(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "value")
    df = op.standardize(df, ["value"], name="{a}_score").drop("value")
    return op.round_columns(df, ["value_score"], 8)


@query("""
SELECT p_partkey, round((p_size - (SELECT avg(p_size) FROM part))
                        / (SELECT stddev_samp(p_size) FROM part), 8) AS size_scaled,
       round((p_retailprice - (SELECT avg(p_retailprice) FROM part))
             / (SELECT stddev_samp(p_retailprice) FROM part), 8) AS price_scaled
FROM part
""")
def standard_scaled_vector(spark: SparkSession, sf: str) -> DataFrame:
    """Columns assembled into a vector, and the vector scaled element by element."""
    cols = ["p_size", "p_retailprice"]
    df = assemble(cols).transform(table(spark, sf, "part").select("p_partkey", *cols))
    scaled = standard_scale().fit(df).transform(df)
    values = vector_to_array("scaled_features")
    return scaled.select(
        "p_partkey",
        F.round(values[0], 8).alias("size_scaled"),
        F.round(values[1], 8).alias("price_scaled"),
    )


_TRAIN = f"(SELECT * FROM part WHERE {uniform_sql('p_partkey', 7)} < 0.8::DOUBLE)"
_TEST = f"(SELECT * FROM part WHERE {uniform_sql('p_partkey', 7)} >= 0.8::DOUBLE)"


def _parts(spark: SparkSession, sf: str) -> list[DataFrame]:
    return op.random_split(table(spark, sf, "part"), [0.8, 0.2], "p_partkey", 7)


def _params_sql(c: str) -> str:
    return f"""SELECT '{c}' AS name, min({c})::DOUBLE AS "min", max({c})::DOUBLE AS "max",
    CASE WHEN max({c}) = min({c}) THEN 1::DOUBLE
         ELSE 1::DOUBLE / (max({c})::DOUBLE - min({c})::DOUBLE) END AS scale FROM {_TRAIN}"""


@query(_params_sql("p_size") + " UNION ALL " + _params_sql("p_retailprice"))
def minmax_params(spark: SparkSession, sf: str) -> DataFrame:
    """Scaling parameters fitted on the training part."""
    return op.minmax_fit(_parts(spark, sf)[0], ["p_size", "p_retailprice"])


def _scaled_sql(c: str) -> str:
    return (
        f"round(({c} - (SELECT min({c}) FROM {_TRAIN}))"
        f" / (SELECT max({c}) - min({c}) FROM {_TRAIN}), 9) AS {c}"
    )


@query(f"SELECT p_partkey, {_scaled_sql('p_size')}, {_scaled_sql('p_retailprice')} FROM {_TEST}")
def minmax_apply(spark: SparkSession, sf: str) -> DataFrame:
    """The test part scaled with the training part's parameters."""
    cols = ["p_size", "p_retailprice"]
    train, test = _parts(spark, sf)
    scaled = op.minmax_apply(test.select("p_partkey", *cols), op.minmax_fit(train, cols), cols)
    return op.round_columns(scaled, cols, 9)


@query("""
SELECT o_orderkey, c.code AS o_orderpriority_encoded
FROM orders JOIN (SELECT o_orderpriority, row_number() OVER (ORDER BY o_orderpriority) - 1 AS code
                  FROM orders GROUP BY 1) c USING (o_orderpriority)
""")
def label_encode(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return op.label_encode(df, ["o_orderpriority"]).drop("o_orderpriority")


_MANY = """
SELECT l_orderkey, l_linenumber,
       CASE WHEN l_quantity < 10 THEN NULL WHEN l_quantity < 25 THEN 'none' ELSE md5(l_orderkey::VARCHAR) END AS tag
FROM lineitem
"""


@query(f"""
SELECT l_orderkey, l_linenumber, c.code AS tag_encoded
FROM ({_MANY}) LEFT JOIN (SELECT tag, row_number() OVER (ORDER BY tag) - 1 AS code
                FROM ({_MANY}) WHERE tag IS NOT NULL GROUP BY 1) c USING (tag)
""")
def label_encode_many(spark: SparkSession, sf: str) -> DataFrame:
    """Codes of a column whose dictionary grows with the table, with a frequent value and nulls."""
    tag = F.when(F.col("l_quantity") >= 25, F.md5(F.col("l_orderkey").cast("string").cast("binary"))).when(
        F.col("l_quantity") >= 10, "none"
    )
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", tag.alias("tag"))
    return op.label_encode(df, ["tag"]).drop("tag")


@query("""
SELECT event_id, coalesce(c.code, (SELECT count(DISTINCT event_type) FROM events
                                   WHERE event_type <> 'view')) AS event_typeIndex
FROM (SELECT event_id, CASE WHEN event_type <> 'view' THEN event_type END AS event_type FROM events)
LEFT JOIN (SELECT event_type, row_number() OVER (ORDER BY count(*) DESC, event_type) - 1 AS code
           FROM events WHERE event_type <> 'view' GROUP BY 1) c USING (event_type)
""")
def string_index(spark: SparkSession, sf: str) -> DataFrame:
    """Codes by falling frequency; rows without a value get the code after the last."""
    known = F.when(F.col("event_type") != "view", F.col("event_type"))
    df = table(spark, sf, "events").select("event_id", known.alias("event_type"))
    return op.string_index(df, ["event_type"]).drop("event_type")


@query("""
SELECT p_partkey, p_partkey * p_partkey AS p_partkey_x_p_partkey,
       p_partkey * p_size AS p_partkey_x_p_size, p_size::BIGINT * p_size AS p_size_x_p_size
FROM part
""")
def pairwise_products(spark: SparkSession, sf: str) -> DataFrame:
    """Products of all pairs of whole-number columns, squares included."""
    df = op.pairwise(table(spark, sf, "part"), ["p_partkey", "p_size"], squares=True)
    return df.drop("p_name", "p_brand", "p_type", "p_size", "p_retailprice")


@query("""
SELECT l_orderkey, l_linenumber, l_quantity * l_discount AS "l_quantity*l_discount",
       l_quantity * l_tax AS "l_quantity*l_tax", l_discount * l_tax AS "l_discount*l_tax"
FROM lineitem
""")
def pairwise_products_distinct(spark: SparkSession, sf: str) -> DataFrame:
    """Products of all pairs of different columns."""
    cols = ["l_quantity", "l_discount", "l_tax"]
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", *cols)
    return op.pairwise(df, cols, name="{a}*{b}").drop(*cols)


@query("""
SELECT p_partkey, greatest(p_size::DOUBLE, p_retailprice) AS max_p_size_p_retailprice,
       greatest(p_size::DOUBLE, weight) AS max_p_size_weight,
       greatest(p_retailprice, weight) AS max_p_retailprice_weight
FROM (SELECT *, p_size * 40::DOUBLE AS weight FROM part)
""")
def pairwise_max(spark: SparkSession, sf: str) -> DataFrame:
    """The larger value of all pairs of columns."""
    cols = ["p_size", "p_retailprice", "weight"]
    size = F.col("p_size").cast("double")
    df = table(spark, sf, "part").withColumn("weight", size * 40.0).withColumn("p_size", size)
    return op.pairwise(df.select("p_partkey", *cols), cols, "max", name="max_{a}_{b}").drop(*cols)


@query("""
SELECT p_partkey, p_size::DOUBLE * p_size AS p_size_2, p_retailprice * p_retailprice AS p_retailprice_2
FROM part
""")
def squares(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["p_size", "p_retailprice"]
    return op.squares(table(spark, sf, "part").select("p_partkey", *cols), cols).drop(*cols)


@query("""
SELECT event_id, round(ln(1 + value), 2) AS value,
       round(CASE WHEN value >= 1 THEN sqrt(ln(value)) END, 9) AS root
FROM events
""")
def log_transforms(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "events").select("event_id", "value")
    df = op.round_columns(op.sqrt_log(df, "value", out="root"), ["root"], 9)
    return op.round_columns(op.log1p(df, ["value"]), ["value"], 2)


@query(f"SELECT doc_id, {uniform_sql('doc_id', 42)} AS u FROM documents")
def row_uniform(spark: SparkSession, sf: str) -> DataFrame:
    """The reproducible uniform number of each row."""
    return table(spark, sf, "documents").select("doc_id", hash_uniform(F.col("doc_id"), 42).alias("u"))


_RADIUS = f"sqrt(-2 * ln(1 - {uniform_sql('event_id', '3:0')}))"
_ANGLE = f"2 * pi() * {uniform_sql('event_id', '3:0', 14)}"


@query(f"""
SELECT event_id, round(value + 0.1::DOUBLE * {_RADIUS} * cos({_ANGLE}), 9) AS value,
  round(user_id + 0.1::DOUBLE * {_RADIUS} * sin({_ANGLE}), 9) AS user_id
FROM events
""")
def perturb_values(spark: SparkSession, sf: str) -> DataFrame:
    """Normal noise on two columns, the same in every run."""
    df = table(spark, sf, "events").select("event_id", "value", "user_id")
    return op.round_columns(op.perturb(df, ["value", "user_id"], 0.1, "event_id", 3), ["value", "user_id"], 9)


_ORDER = "CASE WHEN l_orderkey % 7 > 0 THEN 'order ' || l_orderkey END"


@query(f"""
WITH keyed AS (SELECT l_orderkey, l_linenumber, l_quantity, {_ORDER} AS k FROM lineitem),
codes AS (
  SELECT k, row_number() OVER (ORDER BY count(*) DESC, k) - 1 AS code
  FROM keyed WHERE l_linenumber <= 5 AND k IS NOT NULL GROUP BY k)
SELECT l_orderkey, l_linenumber, l_quantity, coalesce(code, 0)::DOUBLE AS code FROM keyed LEFT JOIN codes USING (k)
""")
def index_model_many_labels(spark: SparkSession, sf: str) -> DataFrame:
    """An index model fitted on part of the rows, with missing and unseen labels in the others."""
    key = F.when(F.col("l_orderkey") % 7 > 0, F.concat(F.lit("order "), "l_orderkey"))
    df = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity", key.alias("k"))
    indexer = models.ImputedStringIndexer(inputCols=["k"], outputCols=["code"])
    return indexer.fit(df.where("l_linenumber <= 5")).transform(df).drop("k")
