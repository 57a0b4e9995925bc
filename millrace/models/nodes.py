"""Fitted trees as tables of nodes, scored by joins."""

from __future__ import annotations

from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions.columns import col, quoted
from millrace.operators.sizes import broadcast_if, fits_broadcast
from millrace.sources.scratch import scratch_path

#: Node tables that are written by hand have these columns.
SCHEMA = (
    "tree int, node int, feature int, bound double, categories array<double>, below int, above int,"
    " n bigint, votes array<double>, depth int"
)


def tree_nodes(model: DecisionTreeClassificationModel | RandomForestClassificationModel) -> DataFrame:
    """One row for each node of each tree, read from the model as it is saved.

    Columns: tree, node (0 is the root), feature (its place in the vector; null in a leaf),
    bound or, of a feature of categories, the categories that go to `below`; below and above
    (the children; values up to the bound go below), n (training rows), votes (training weight
    by class) and depth (levels below the root of the deepest tree).
    """
    spark = SparkSession.active()
    depth = max(t.depth for t in getattr(model, "trees", [model]))
    path = scratch_path(spark, "trees")
    model.save(path)
    saved = spark.read.parquet(f"{path}/data")
    if "treeID" in saved.columns:
        saved = saved.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        saved = saved.select(F.lit(0).alias("tree"), "*")
    inner = F.col("leftChild") >= 0
    continuous = F.col("split.numCategories") == -1
    values = F.col("split.leftCategoriesOrThreshold")
    return saved.select(
        "tree",
        F.col("id").alias("node"),
        F.when(inner, F.col("split.featureIndex")).alias("feature"),
        F.when(inner & continuous, values[0]).alias("bound"),
        F.when(inner & ~continuous, values).alias("categories"),
        F.when(inner, F.col("leftChild")).alias("below"),
        F.when(inner, F.col("rightChild")).alias("above"),
        F.col("rawCount").alias("n"),
        F.col("impurityStats").alias("votes"),
        F.lit(depth).alias("depth"),
    )


def reached_leaves(df: DataFrame, nodes: DataFrame, key: str, features: str = "features") -> DataFrame:
    """Rows (`key`, tree, node, votes): the leaf of every tree that every row of `df` comes to.

    All rows go down one level at a time, by a join with the nodes; rows in a leaf stay there.
    The roots, one row a tree, are dealt to all rows. `features` is a vector or an array of doubles. Levels of few nodes are
    broadcast after a check; larger tables are joined by tree and node, from the second level on.
    """
    is_array = df.schema[features].dataType.typeName() == "array"
    x = col(features) if is_array else vector_to_array(col(features))
    small = fits_broadcast(nodes)
    table = nodes.select(*[F.col(c).alias(f"__{c}") for c in nodes.columns])
    depth = nodes.agg(F.max("depth")).first()[0] or 0
    kinds = {f"__{f.name}": f.dataType for f in nodes.schema}
    roots = [  # one row a tree
        F.struct(*[F.lit(v).cast(t).alias(c) for (c, t), v in zip(kinds.items(), root)])
        for root in nodes.where("node = 0").orderBy("tree").collect()
    ]
    if not roots:
        raise ValueError("no tree among the nodes")
    value = F.col("__x")[F.col("__feature")]
    goes_below = F.when(F.col("__bound").isNotNull(), value <= F.col("__bound")).otherwise(F.array_contains("__categories", value))
    step = F.when(F.col("__feature").isNull(), F.col("__node")).when(goes_below, F.col("__below")).otherwise(F.col("__above"))
    at = df.select(col(key), x.alias("__x"), F.explode(F.array(*roots)).alias("r")).select(col(key), "__x", "r.*")
    for _ in range(depth):
        moved = at.select(col(key), "__x", F.col("__tree").alias("tree"), step.alias("node"))
        met = (F.col("tree") == F.col("__tree")) & (F.col("node") == F.col("__node"))
        at = moved.join(broadcast_if(small, table), met)
    return at.select(col(key), F.col("__tree").alias("tree"), F.col("__node").alias("node"), F.col("__votes").alias("votes"))


def predict_by_nodes(df: DataFrame, nodes: DataFrame, key: str, features: str = "features") -> DataFrame:
    """Rows (`key`, prediction, probability): what a forest or a tree says, from its nodes alone.

    Votes of a leaf count by their shares, each tree alike; the class of the largest mean share
    wins, the first of equals. Rows of one `key` must have the same features.
    """
    leaves = reached_leaves(df, nodes, key, features)
    total = F.aggregate("votes", F.lit(0.0), lambda s, v: s + v)
    shares = leaves.select(col(key), F.posexplode("votes").alias("class", "v"), total.alias("total"))
    by_class = shares.groupBy(col(key), "class").agg(F.avg(F.try_divide("v", "total")).alias("share"))
    probability = F.transform(F.array_sort(F.collect_list(F.struct("class", "share"))), lambda s: s["share"])
    found = by_class.groupBy(col(key)).agg(probability.alias("probability"))
    best = F.array_position("probability", F.array_max("probability")) - 1
    return found.select(F.col(quoted(key)), best.cast("double").alias("prediction"), "probability")
