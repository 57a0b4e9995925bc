"""Heart disease records: two ways to clean them, smoking rates from pages, model choice."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace import models
from millrace import operators as op
from millrace.functions import (
    NUMERICS,
    columns_of,
    extract_json_block,
    extract_list_items,
    extract_row_headers,
    extract_table_cells,
    extract_table_rows,
    parse_rate,
)
from millrace.functions.html import PERCENT_IN_PARENTHESES
from millrace.operators.setops import union_all
from millrace.sources import read_csv, write_csv, write_table

# The columns of the data and the limits of their valid values.
LABEL = "target"
BAD_HEADER = {"ekgday(day": "ekgday"}
RETAINED = [
    "age", "sex", "painloc", "painexer", "cp", "trestbps", "smoke", "fbs", "prop", "nitr", "pro",
    "diuretic", "thaldur", "thalach", "exang", "oldpeak", "slope",
]
FLAGS = ["fbs", "prop", "nitr", "pro", "diuretic"]
MODE_COLUMNS = ["painloc", "painexer", "exang", "slope"]
MEAN_COLUMNS = ["thaldur", "thalach"]
MOSTLY_EMPTY_OR_UNUSED = [
    "restckm", "exerckm", "restef", "restwm", "exeref", "exerwm", "dm", "pncaden", "smoke",
    "thalsev", "thalpul", "earlobe",
]
MEASURES = [
    "age", "trestbps", "chol", "cigs", "years", "ekgmo", "ekgday", "ekgyr", "thaldur", "thaltime",
    "met", "thalach", "thalrest", "tpeakbps", "tpeakbpd", "dummy", "trestbpd", "oldpeak", "rldv5",
    "rldv5e", "cmo", "cday", "cyr",
]
CATEGORIES = [
    "painloc", "painexer", "relrest", "cp", "sex", "htn", "smoke", "fbs", "dm", "famhist",
    "restecg", "dig", "prop", "nitr", "pro", "diuretic", "proto", "exang", "xhypo", "slope", "ca",
    "exerckm", "restwm", "exerwm", "thal", "thalsev", "thalpul", "earlobe",
]
PAIN = ["painloc", "painexer", "relrest"]
SKEWED = ["cigs", "years", "rldv5e"]
FIRST_ROWS = 899
HIGHEST_PROTOCOL = 12
WRONG_PROP = 22
Z_LIMIT = 6.0
AGE_BANDS = [(15, 17), (18, 24), (25, 34), (35, 44), (45, 54), (55, 64), (65, 74), (75, 1000)]
CHART_CAPTION = "Proportion of people 15 years and over who were current daily smokers by age, 2011"
CHART_ROW = 7
MALE, FEMALE = 1, 0
TEST_SHARE = 0.1
FOLDS = 5
SEED = 42
MODELS = {"lr": {}, "tree": {}, "forest": {"seed": SEED}}
LINEAR_MODELS = {"lr": {}, "svm": {}}


def clean_for_reporting(df: DataFrame) -> DataFrame:
    """Measures without outliers and gaps; codes repaired, filled and narrowed to booleans.

    All columns not dropped and not measures are categories.
    """
    df = op.rename(op.drop_columns(df, MOSTLY_EMPTY_OR_UNUSED), BAD_HEADER)
    measures = [c for c in MEASURES if c in df.columns]
    categories = [c for c in df.columns if c not in measures]
    df = op.impute(op.iqr_to_null(df, measures), {c: "mean" for c in measures})
    codes = {
        "proto": op.valid_code(
            lambda c: c < HIGHEST_PROTOCOL, lambda c: c > HIGHEST_PROTOCOL, fill_missing=False
        ),
        "prop": op.valid_code(lambda c: c != WRONG_PROP, fill_missing=False),
    }
    df = op.repair(df, {c: rule for c, rule in codes.items() if c in categories})
    df = op.impute(df, {c: "mode" for c in categories})
    df = op.replace_columns(df, {c: F.col(c).cast("int") for c in categories})
    return op.narrow_booleans(df, categories)


def clean_all_columns(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """The first rows, every category filled by mode, every number by mean, no extreme rows."""
    df = op.rename(op.first_n(df, order_by, FIRST_ROWS), BAD_HEADER)
    df = op.impute(df, {c: "mode" for c in CATEGORIES if c in df.columns})
    df = op.row_sum(df, "pncaden", PAIN)
    if "restckm" in df.columns:
        df = op.impute(df, {"restckm": 0})
    numbers = [c for c in columns_of(df, NUMERICS) if c not in order_by]
    df = op.impute(df, {c: "mean" for c in numbers})
    return op.zscore_filter(df, numbers, Z_LIMIT)


def log_and_round(df: DataFrame) -> DataFrame:
    df = op.log1p(df, [c for c in SKEWED if c in df.columns])
    return op.round_columns(df, columns_of(df, NUMERICS), 2)


def clean_for_modelling(df: DataFrame, mean_over: str = "in_range") -> DataFrame:
    """The columns for modelling, repaired; `smoke` keeps its gaps.

    `mean_over` "in_range" fills pressure and depression with the mean of valid values (of
    pressures above 100), "all" with the mean of all values.
    """
    keep = [c for c in [*RETAINED, LABEL] if c in df.columns]
    extra = [c for c in df.columns if c not in RETAINED and c != LABEL]
    pressure = (lambda c: c > 100) if mean_over == "in_range" else mean_over
    rules = {c: op.Repair("mode") for c in MODE_COLUMNS}
    rules |= {c: op.Repair("mean") for c in MEAN_COLUMNS}
    rules |= {c: op.binary_flag() for c in FLAGS}
    rules["trestbps"] = op.in_range(100, over=pressure)
    rules["oldpeak"] = op.in_range(0, 4, over=mean_over)
    return op.repair(df.select(*extra, *keep), rules)


def bands_by_age(pages: DataFrame) -> DataFrame:
    """(lo, hi, rate) from the chart of a page (column `html`)."""
    chart = extract_json_block(F.col("html"), CHART_CAPTION, "array<array<array<double>>>")
    edges = [F.struct(F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for lo, hi in AGE_BANDS]
    zipped = F.arrays_zip(F.array(*edges).alias("band"), F.flatten(F.get(chart, F.lit(CHART_ROW))).alias("p"))
    rows = pages.select(F.explode(zipped).alias("z"))
    return rows.select(
        F.col("z.band.lo").alias("lo"), F.col("z.band.hi").alias("hi"), (F.col("z.p") / 100).alias("rate")
    ).filter(F.col("lo").isNotNull() & F.col("rate").isNotNull())


def bands_by_age_table(pages: DataFrame) -> DataFrame:
    """(lo, hi, rate in per cent) from the second table of a page; tenth cell of each row."""
    rows = F.explode(extract_table_rows(F.col("html"), 1, "responsive-enabled")).alias("row")
    header = F.get(extract_row_headers(F.col("row")), F.lit(0))
    ends = F.regexp_extract_all(header, F.lit(r"(\d+)"), 1)
    rate = F.get(extract_table_cells(F.col("row")), F.lit(9)).try_cast("double")
    return (
        pages.select(rows)
        .select(
            F.get(ends, F.lit(0)).cast("int").alias("lo"),
            F.get(ends, F.lit(1)).cast("int").alias("hi"),
            rate.alias("rate"),
        )
        .filter(F.col("lo").isNotNull() & F.col("rate").isNotNull())
    )


def bands_by_sex(pages: DataFrame) -> DataFrame:
    """(sex, lo, hi, rate in per cent) from two lists of a page.

    The first list gives the rates of men and women, the second the rates by age. The age
    rates stand for women; men's are scaled by the ratio of the two.
    """
    by_sex = extract_list_items(F.col("html"), "block-list", 0)
    percent = [
        F.regexp_extract(F.get(by_sex, F.lit(i)), PERCENT_IN_PARENTHESES, 1).try_cast("double")
        for i in (0, 1)
    ]
    ages = F.explode(extract_list_items(F.col("html"), "block-list", 1)).alias("item")
    rates = pages.select((percent[0] / percent[1]).alias("ratio"), ages).select(
        "ratio", parse_rate(F.col("item")).alias("r")
    ).select("ratio", "r.*").filter(F.col("lo").isNotNull() & F.col("rate").isNotNull())
    women = rates.select(F.lit(FEMALE).alias("sex"), "lo", "hi", "rate")
    men = op.scale_rates(rates, F.col("ratio")).select(F.lit(MALE).alias("sex"), "lo", "hi", "rate")
    return union_all([women, men])


def impute_smoking(
    df: DataFrame, by_age: DataFrame, by_sex: DataFrame, key: str, seed: int = SEED
) -> DataFrame:
    """Fill `smoke` from two drawn sources, which are kept; rates are shares of 1."""
    df = op.copy_column(df, "smoke", "source_1", "source_2")
    df = op.impute_bernoulli(df, "source_1", by_age, "age", key, f"{seed}-1")
    df = op.impute_bernoulli(df, "source_2", by_sex, "age", key, f"{seed}-2", by=["sex"])
    return op.impute_from_votes(df, "smoke", ["source_1", "source_2"])


def smoking_rate(df: DataFrame, by_age: DataFrame, by_sex: DataFrame) -> DataFrame:
    """Replace `smoke` by the mean of the two sources' rates."""
    return op.mean_of_rates(df, "smoke", [(by_age, "age", []), (by_sex, "age", ["sex"])])


def choose_and_report(
    df: DataFrame,
    features: Sequence[str],
    key: str,
    kinds: Mapping[str, Mapping[str, object]] = MODELS,
) -> tuple[DataFrame, DataFrame]:
    """Cross-validated scores (model, value), and the best model's report on the test rows.

    `kinds` gives the parameters of each kind of model. The test rows have the share of each label that all rows have, and no part in the choice.
    """
    labelled = op.drop_missing(df.select(key, *features, LABEL))
    data = labelled.withColumnRenamed(LABEL, "label")
    train, test = op.stratified_split(data, "label", TEST_SHARE, key, SEED)
    steps = {
        kind: models.build_pipeline(models.assemble(features), models.estimator(kind, **params))
        for kind, params in kinds.items()
    }
    scores = [
        (kind, models.cross_validate(model, train, FOLDS, key, SEED).score)
        for kind, model in steps.items()
    ]
    table = df.sparkSession.createDataFrame(scores, "model string, value double")
    best = models.select_best(table).first()["model"]
    report = models.classification_report(models.predict(models.fit(steps[best], train), test))
    return table, report.withColumn("model", F.lit(best))


def six_models(
    first: DataFrame,
    second: DataFrame,
    third: DataFrame,
    key: str,
    kinds: Mapping[str, Mapping[str, object]] = LINEAR_MODELS,
) -> tuple[DataFrame, DataFrame]:
    """Two model kinds on three cleaned versions of the data: all scores, and the best's report."""
    datasets = {}
    for name, df in {"all_columns": first, "modelling": second, "with_rates": third}.items():
        numbers = [c for c in columns_of(df, NUMERICS) if c not in (key, LABEL)]
        data = op.drop_missing(df.select(key, *numbers, LABEL)).withColumnRenamed(LABEL, "label")
        train, test = op.random_split(data, [0.8, 0.2], key, SEED)
        prepared = models.build_pipeline(
            models.assemble(numbers, "raw"), models.standard_scale("raw", "features")
        ).fit(train)
        datasets[name] = tuple(
            prepared.transform(part).select("label", "features") for part in (train, test)
        )
    estimators = {kind: models.estimator(kind, **params) for kind, params in kinds.items()}
    metrics = models.evaluate_matrix(datasets, estimators)
    named = metrics.withColumn("id", F.concat_ws(":", "model", "dataset"))
    best = models.select_best(named, "id").first()
    return metrics, models.final_report(estimators[best["model"]], *datasets[best["dataset"]])


def run_reporting(spark: SparkSession, source: str, target: str, table: str) -> dict[str, DataFrame]:
    """Load raw records into a table, clean them into another and a file; summaries returned."""
    write_table(read_csv(spark, source), f"raw_{table}")
    raw = spark.table(f"raw_{table}")
    clean = clean_for_reporting(raw)
    write_table(clean, table)
    clean = spark.table(table)
    write_csv(clean, target)
    measures = [c for c in MEASURES if c in clean.columns]
    transformed = op.sqrt_log(clean, "rldv5e")
    return {
        "raw_boxes": op.box_stats(op.rename(raw, BAD_HEADER), measures),
        "clean_boxes": op.box_stats(clean, measures),
        "qq_thalrest": op.qq_points(clean, "thalrest"),
        "qq_rldv5e": op.qq_points(transformed, "rldv5e"),
        "box_rldv5e": op.box_stats(transformed, ["rldv5e"]),
        "age_chol": op.pair_stats(clean, "age", "chol"),
    }
