"""Choosing between models, final reports, and robustness under noise.

Scores are tables (model, ..., value), so a choice is a query over them.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from statistics import NormalDist, fmean, pstdev

from pyspark.ml import Estimator, Transformer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.columns import col
from millrace.models.evaluate import accuracy, binary_report
from millrace.models.train import fit, kept
from millrace.operators.aggregate import best_of
from millrace.operators.derive import perturb
from millrace.operators.setops import union_all

DO_NOTHING = "do_nothing"


def select_best(metrics: DataFrame, model: str = "model", value: str = "value") -> DataFrame:
    """The row of the best score, lower name first on ties."""
    return best_of(metrics, model, value)


def decide(
    metrics: DataFrame,
    champion: str,
    challengers: Sequence[str],
    tolerance: float = 0.0,
    model: str = "model",
    value: str = "value",
) -> DataFrame:
    """One row (best_challenger, best_value, champion_value, decision).

    The best challenger is named, unless it is worse than the champion by more than the
    tolerance. A challenger beats the ones after it in the list only if strictly better.
    """
    names = [champion, *challengers]
    wide = metrics.agg(
        *[F.max(F.when(col(model) == n, col(value))).alias(f"m{i}") for i, n in enumerate(names)]
    )
    last = len(names) - 1
    best, score = F.lit(names[last]), F.col(f"m{last}")
    for i in range(last - 1, 0, -1):
        better = F.col(f"m{i}") > score
        best = F.when(better, F.lit(names[i])).otherwise(best)
        score = F.when(better, F.col(f"m{i}")).otherwise(score)
    chosen = wide.select(
        best.alias("best_challenger"), score.alias("best_value"), F.col("m0").alias("champion_value")
    )
    worse = F.col("best_value") - F.col("champion_value") < -tolerance
    return chosen.withColumn(
        "decision", F.when(worse, DO_NOTHING).otherwise(F.col("best_challenger"))
    )


def evaluate_matrix(
    datasets: Mapping[str, tuple[DataFrame, DataFrame]],
    models: Mapping[str, Estimator],
    label: str = "label",
) -> DataFrame:
    """Accuracy of every model on every (train, test) pair: (model, dataset, metric, value)."""
    rows = []
    for dataset, (train, test) in datasets.items():
        with kept(train) as data:
            fitted = {name: model.fit(data) for name, model in models.items()}
        for name, model in fitted.items():
            score = accuracy(model.transform(test), label, out="value")
            rows.append(
                score.select(
                    F.lit(name).alias("model"),
                    F.lit(dataset).alias("dataset"),
                    F.lit("accuracy").alias("metric"),
                    "value",
                )
            )
    return union_all(rows)


def final_report(
    model: Estimator, train: DataFrame, test: DataFrame, label: str = "label"
) -> DataFrame:
    """Refit a chosen model and score it on rows that had no part in the choice."""
    return binary_report(fit(model, train).transform(test), label)


def perturbation_test(
    model: Transformer,
    test: DataFrame,
    cols: Sequence[str],
    std: float,
    trials: int,
    key: str,
    seed: int | str,
    label: str = "label",
    level: float = 0.95,
    tolerance: float = 0.0,
    first_round: int = 4,
) -> DataFrame:
    """Accuracy of a fitted model under normal noise on its input columns.

    One row (trials, mean, std_error, ci_lo, ci_hi). The result is that of the first trial,
    from the second on, at which the confidence interval's half width is within `tolerance`,
    or else of the last. Trials are scored in rounds, each in one pass and as long as all
    before it together, so that at most twice the trials that count are scored; the length of
    the rounds does not change the result. Every trial is a copy of the test rows with its own
    noise, which depends on the row's key, the seed, the trial and the column. Without test
    rows all numbers are null.
    """
    z = NormalDist().inv_cdf(0.5 + level / 2)
    right = (col(label) == F.col("prediction")).cast("double")
    scores: list[float] = []
    result = (None,) * 5
    with kept(test) as rows:
        while len(scores) < trials:
            last = min(trials, max(first_round, 2 * len(scores)))
            copies = rows.withColumn("__trial", F.explode(F.sequence(F.lit(len(scores) + 1), F.lit(last))))
            noisy = perturb(copies, cols, std, key, seed, F.col("__trial"))
            scored = model.transform(noisy).groupBy("__trial").agg(F.avg(right).alias("score"))
            found = sorted(scored.collect())  # one row a trial
            if not found:
                break
            done = False
            for _, score in found:
                scores.append(score)
                error = pstdev(scores) / math.sqrt(len(scores))
                mean = fmean(scores)
                result = (len(scores), mean, error, mean - z * error, mean + z * error)
                done = len(scores) > 1 and z * error <= tolerance
                if done:
                    break
            if done:
                break
    names = "trials int, mean double, std_error double, ci_lo double, ci_hi double"
    return test.sparkSession.createDataFrame([result], names)
