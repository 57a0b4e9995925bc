"""Wine: tables to tables, three feature sets, champion against challengers, noise test."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import models
from millrace import operators as op
from millrace.functions import NUMERICS, STRINGS, columns_of
from millrace.operators.setops import union_all
from millrace.sources import drop_tables, read_csv, reset_schema, stage, write_table

# Label, split and the limits of cleaning and testing.
LABEL = "Wine"
TEST_SHARE = 0.2
OUTLIER_STD = 3.0
TOLERANCE = 0.01
PERTURBATION_STD = 1.2
MAX_TRIALS = 50
CONFIDENCE = 0.95
SEED = 42
KEY = "row_key"
CHAMPION, MAX, PRODUCT = "production", "max", "product"


def with_key(df: DataFrame) -> DataFrame:
    """A key that depends on a row's content; equal rows share it, and so a split's side."""
    return df.withColumn(KEY, F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))


def features_of(df: DataFrame) -> list[str]:
    return columns_of(df, NUMERICS, {LABEL, KEY})


def clean(df: DataFrame) -> DataFrame:
    """No missing values, no outliers in any number column, categories encoded."""
    numbers = columns_of(df, NUMERICS, {LABEL, KEY})
    strings = columns_of(df, STRINGS, {LABEL})
    kept = op.zscore_filter_sequential(op.drop_missing(df), numbers, OUTLIER_STD, TOLERANCE)
    return op.drop_columns(op.label_encode(kept, strings), strings)


def normalize(df: DataFrame) -> dict[str, DataFrame]:
    """Train and test part, both scaled with the training part's range; and that range."""
    cols = features_of(df)
    train, test = op.random_split(df, [1 - TEST_SHARE, TEST_SHARE], KEY, SEED)
    params = op.minmax_fit(train, cols)
    return {
        "train": op.minmax_apply(train, params, cols),
        "test": op.minmax_apply(test, params, cols),
        "normalization": params,
    }


def max_features(df: DataFrame) -> DataFrame:
    return op.pairwise(df, features_of(df), "max", name="max_{a}_{b}")


def product_features(df: DataFrame) -> DataFrame:
    return op.pairwise(df, features_of(df), name="{a}*{b}")


FEATURE_SETS: dict[str, Callable[[DataFrame], DataFrame]] = {
    CHAMPION: lambda df: df,
    MAX: max_features,
    PRODUCT: product_features,
}


def feature_set(df: DataFrame, kind: str) -> tuple[DataFrame, list[str]]:
    """The frame with a feature set, and its columns, under names that vector assembly takes."""
    derived = FEATURE_SETS[kind](df)
    names = {c: f"f{i}" for i, c in enumerate(features_of(derived))}
    return op.rename(derived, names), list(names.values())


def _classifier(cols: Sequence[str]) -> Pipeline:
    return models.build_pipeline(models.assemble(cols), models.estimator("lr", LABEL))


def validation_scores(train: DataFrame) -> DataFrame:
    """Accuracy of each feature set on a validation part of the training rows: (model, value)."""
    rows = []
    for name in FEATURE_SETS:
        data, cols = feature_set(train, name)
        fitting, validation = op.random_split(data, [1 - TEST_SHARE, TEST_SHARE], KEY, SEED + 1)
        fitted = models.fit(_classifier(cols), fitting)
        score = models.accuracy(models.predict(fitted, validation), LABEL, out="value")
        rows.append(score.select(F.lit(name).alias("model"), "value"))
    return union_all(rows)


def evaluate(train: DataFrame, test: DataFrame, kind: str) -> DataFrame:
    """The chosen feature set, fitted on all training rows: test accuracy, and under noise."""
    train_set, cols = feature_set(train, kind)
    test_set, _ = feature_set(test, kind)
    fitted = models.fit(_classifier(cols), train_set)
    calm = models.accuracy(models.predict(fitted, test_set), LABEL)
    noisy = models.perturbation_test(
        fitted, test_set, cols, PERTURBATION_STD, MAX_TRIALS, KEY, SEED, LABEL, CONFIDENCE,
        tolerance=TOLERANCE,
    )
    return noisy.withColumn("accuracy", calm.scalar())


def run(spark: SparkSession, csv_path: str, schema: str = "wine") -> DataFrame:
    """The whole chain over tables of one schema; one row with the decision and the scores."""
    name = {n: f"{schema}.{n}" for n in
            ("original", "clean", "train", "test", "normalization", "scores")}
    reset_schema(spark, schema, "wine data, from raw to scored")
    write_table(with_key(read_csv(spark, csv_path)), name["original"])

    cleaned = stage([name["original"]], [name["clean"]])(clean)
    cleaned(spark)

    @stage([name["clean"]], [name["train"], name["test"], name["normalization"]])
    def normalized(df: DataFrame) -> dict[str, DataFrame]:
        return {name[k]: v for k, v in normalize(df).items()}

    normalized(spark)
    stage([name["train"]], [name["scores"]])(validation_scores)(spark)
    decision = models.decide(
        spark.table(name["scores"]), CHAMPION, [MAX, PRODUCT], TOLERANCE
    ).first()
    result = spark.createDataFrame([decision])
    if decision["decision"] != models.select.DO_NOTHING:
        report = evaluate(
            spark.table(name["train"]), spark.table(name["test"]), decision["decision"]
        )
        result = spark.createDataFrame([{**decision.asDict(), **report.first().asDict()}])
    drop_tables(spark, [name["scores"]])
    return result
