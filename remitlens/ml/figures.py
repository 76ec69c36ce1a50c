"""Figures of binary classifiers and scoring rules, in DataFrame functions and whole numbers.

The area under the ROC curve is the rank-sum statistic with tied ranks: rows are counted by score, scores are put in order in
ranges that each start from the counts before them, and no task holds more than its range. All figures are quotients of whole
numbers, so they do not depend on how rows are partitioned.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from remitlens.functions.numeric import count_where
from remitlens.operators.ranking import running_totals


def share(part: Column, whole: Column) -> Column:
    """part / whole, 0 where it is undefined."""
    return F.when(whole > 0, part.cast("double") / whole.cast("double")).otherwise(F.lit(0.0))


def cells(scored: DataFrame) -> DataFrame:
    """Rows per actual and predicted label of each rule, and the figures that follow from them."""
    actual, predicted = F.col("label") == 1, F.col("prediction") == 1
    counted = scored.groupBy("rule").agg(
        count_where(~actual & ~predicted).alias("true_safe"),
        count_where(~actual & predicted).alias("false_fraud"),
        count_where(actual & ~predicted).alias("false_safe"),
        count_where(actual & predicted).alias("true_fraud"),
    )
    tn, fp, fn, tp = (F.col(name) for name in ("true_safe", "false_fraud", "false_safe", "true_fraud"))
    return counted.select(
        "*",
        share(tp + tn, tp + tn + fp + fn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(tp * 2, tp * 2 + fp + fn).alias("f1"),
    )


def areas(scored: DataFrame) -> DataFrame:
    """rule and auc: the share of pairs of a fraud and a safe row in which the fraud has the higher score, equal scores counting
    half; 0 if a class is empty."""
    counted = scored.groupBy("rule", "score").agg(
        count_where(F.col("label") == 1).alias("frauds"), count_where(F.col("label") != 1).alias("safe")
    )
    placed = running_totals(counted, [F.col("rule"), F.col("score")], {"safe_before": F.col("safe")}, "auc-scores")
    wide = "decimal(38,0)"
    frauds, safe, before = (F.col(name).cast(wide) for name in ("frauds", "safe", "safe_before"))
    # Twice the pairs; counts run on over the rules, so each rule starts from its least.
    summed = placed.groupBy("rule").agg(
        F.sum((frauds * before * 2 + frauds * safe).cast(wide)).alias("twice"),
        F.sum(frauds).cast(wide).alias("p"), F.sum(safe).cast(wide).alias("n"), F.min(before).cast(wide).alias("start"),
    )
    p, n = F.col("p"), F.col("n")
    return summed.select("rule", share((F.col("twice") - p * F.col("start") * 2).cast(wide), (p * n * 2).cast(wide)).alias("auc"))


def figures(scored: DataFrame) -> DataFrame:
    """One row per rule: cells, accuracy, precision, recall, F1 and AUC. ``scored``: rule, label (1 is fraud), prediction, score."""
    return cells(scored).join(areas(scored), "rule")


def with_best(table: DataFrame, order: Sequence[str]) -> DataFrame:
    """Marks the rule with the highest F1; of equal ones the first of ``order``. There are as many rows as rules."""
    place = F.array_position(F.array(*[F.lit(name) for name in order]), F.col("rule"))
    best = table.agg(F.max(F.struct("f1", (-place).alias("place"), "rule")).alias("best")).select("best.rule").scalar()
    return table.withColumn("is_best", F.col("rule") == best)


def by_rules(table: DataFrame, rules: Mapping[str, tuple[Column, Column]], label: str) -> DataFrame:
    """``scored`` rows of fixed rules, each a score and a prediction over the columns of ``table``; one pass over it."""
    told = [
        F.struct(F.lit(name).alias("rule"), score.cast("double").alias("score"), prediction.cast("int").alias("prediction"))
        for name, (score, prediction) in rules.items()
    ]
    long = table.select(F.col(label).cast("int").alias("label"), F.explode(F.array(*told)).alias("told"))
    return long.select("told.rule", "label", "told.prediction", "told.score")


def stacked_predictions(predictions: Mapping[str, DataFrame], label: str) -> DataFrame:
    """``scored`` rows of fitted classifiers; the score is the probability of fraud."""
    from pyspark.ml.functions import vector_to_array

    parts = [
        rows.select(
            F.lit(name).alias("rule"), F.col(label).cast("int").alias("label"), F.col("prediction").cast("int").alias("prediction"),
            vector_to_array("probability")[1].alias("score"),
        )
        for name, rows in predictions.items()
    ]
    return reduce(DataFrame.unionByName, parts)
