"""Passengers: typed features, a forest, a grid chosen by cross-validation, area under ROC."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Model
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from millrace import models
from millrace import operators as op
from millrace.functions import NUMERICS, columns_of

# The split, the folds and the grid.
SPLIT = (0.8, 0.2)
SPLIT_SEED = 7576
FOLDS = 3
DEPTHS = (2, 4, 6, 8, 10)
TREES = (10, 20, 50, 100)


@dataclass(frozen=True)
class Outcome:
    model: Model
    params: dict[str, object]
    auc: DataFrame


def train_and_score(
    df: DataFrame,
    label: str = "Survived",
    key: str = "PassengerId",
    exclude: tuple[str, ...] = ("Name",),
    depths: tuple[int, ...] = DEPTHS,
    trees: tuple[int, ...] = TREES,
    parallelism: int = 8,
) -> Outcome:
    """Fit on the training part only; the area under ROC is that of the held-out part."""
    numbers = columns_of(df, NUMERICS, {key})
    data = op.apply_columns(op.drop_missing(df, [label]), numbers, lambda c: c.cast("double"))
    train, test = op.random_split(data, SPLIT, key, SPLIT_SEED)
    forest = models.estimator("forest", label, seed=SPLIT_SEED, maxBins=256)
    steps = models.build_pipeline(*models.typed_stages(data, label, [key, *exclude]), forest)
    grid = models.param_grid({forest.maxDepth: depths, forest.numTrees: trees})
    evaluator = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC")
    fitted = models.cross_validate(
        steps, train, FOLDS, key, SPLIT_SEED, grid, evaluator, parallelism
    )
    scored = models.predict(fitted.model, test)
    score = scored.select(label, vector_to_array("probability")[1].alias("score"))
    return Outcome(fitted.model, models.best_params(fitted), models.auc(score, "score", label))
