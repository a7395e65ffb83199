"""Metrics over prediction tables: rows with ``label``, ``prediction`` (0.0 or 1.0) and ``score``,
in groups named by ``by``."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opinara.functions.numeric import ratio, round_half_up
from opinara.staging import stage

#: Distinct scores one running sum handles; beyond it scores are cut into ranges.
SCORES_PER_RANGE = 1_000_000

METRIC_DIGITS = 4
METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def _cells(df: DataFrame, by: Sequence[str]) -> DataFrame:
    def cell(actual: int, predicted: int) -> Column:
        return F.count_if((F.col("label") == actual) & (F.col("prediction") == predicted))

    return df.groupBy(*by).agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def confusion_matrix(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """``(*by, actual, predicted, n)`` with all four cells of every group."""
    cells = F.stack(
        F.lit(4),
        F.lit(0), F.lit(0), F.col("tn"), F.lit(0), F.lit(1), F.col("fp"),
        F.lit(1), F.lit(0), F.col("fn"), F.lit(1), F.lit(1), F.col("tp"),
    ).alias("actual", "predicted", "n")
    return _cells(df, by).select(*by, cells)


def _from_cells(cells: DataFrame, by: Sequence[str], *names: str) -> DataFrame:
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    values = {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }
    return cells.select(*by, *[round_half_up(values[n], METRIC_DIGITS).alias(n) for n in names])


def accuracy(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    return _from_cells(_cells(df, by), by, "accuracy")


def precision_recall_f1(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """Of the positive class; 0 where undefined."""
    return _from_cells(_cells(df, by), by, "precision", "recall", "f1")


def score_counts(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(*by, score, pos, neg)``: tied scores in one row. A row without a score (null or NaN) takes
    no part."""
    scored = df.where(F.col("score").isNotNull() & ~F.isnan("score"))
    return scored.groupBy(*by, "score").agg(
        F.count_if(F.col("label") == 1).alias("pos"), F.count_if(F.col("label") == 0).alias("neg")
    )


def score_range(counts: DataFrame, n_scores: int, per_range: int) -> DataFrame:
    """Add ``part``: the score's range out of enough quantile ranges.

    Scores are distinct within a group, so no range is dominated by one value.
    """
    ranges = math.ceil(n_scores / per_range)
    if ranges <= 1:
        return counts.withColumn("part", F.lit(0.0))
    marks = [i / ranges for i in range(1, ranges)]
    inner = counts.agg(F.percentile_approx("score", marks, max(10_000, 10 * ranges)).alias("q")).first().q
    marks = F.array(*[F.lit(float(q)) for q in sorted(set(inner))])
    return counts.withColumn("part", F.size(F.filter(marks, lambda q: q <= F.col("score"))).cast("double"))


def ranked_scores(df: DataFrame, by: Sequence[str], per_range: int = SCORES_PER_RANGE) -> DataFrame:
    """``(*by, score, pos, neg, pos_from, neg_from, n_pos, n_neg)`` where ``pos_from`` and
    ``neg_from`` count rows scored at or above ``score``."""
    return _ranked(df, by, per_range).drop("part", "above", "next_head")


def _ranked(df: DataFrame, by: Sequence[str], per_range: int) -> DataFrame:
    """As ``ranked_scores``, with the score's range, the one above, and the first step of the next.

    A running sum per score range, plus the totals of the ranges above it.
    """
    counts = stage(score_counts(df, by), "scores")
    counts = score_range(counts, counts.count(), per_range)
    head = F.max_by(F.struct("pos", "neg"), "score").alias("head")
    totals = counts.groupBy(*by, "part").agg(F.sum("pos").alias("part_pos"), F.sum("neg").alias("part_neg"), head)
    down = W.partitionBy(*by).orderBy(F.desc("part"))
    whole = W.partitionBy(*by)
    offsets = totals.select(
        *by,
        "part",
        (F.sum("part_pos").over(down) - F.col("part_pos")).alias("pos_above"),
        (F.sum("part_neg").over(down) - F.col("part_neg")).alias("neg_above"),
        F.sum("part_pos").over(whole).alias("n_pos"),
        F.sum("part_neg").over(whole).alias("n_neg"),
        F.lag("part").over(down).alias("above"),
        F.lead("head").over(down).alias("next_head"),
    )
    within = W.partitionBy(*by, "part").orderBy(F.desc("score"))
    return counts.join(offsets, [*by, "part"]).select(
        *by,
        "score",
        "pos",
        "neg",
        (F.sum("pos").over(within) + F.col("pos_above")).alias("pos_from"),
        (F.sum("neg").over(within) + F.col("neg_above")).alias("neg_from"),
        "n_pos",
        "n_neg",
        "part",
        "above",
        "next_head",
    )


def _corners(ranked: DataFrame, by: Sequence[str]) -> DataFrame:
    """The first and last score of each group, and those whose step differs from the next one's.

    A point between two equal steps lies on the line through its neighbours. The step after the
    last score of a range is the first one of the next range below.
    """
    within = W.partitionBy(*by, "part").orderBy(F.desc("score"))
    step = F.struct("pos", "neg")
    following = F.coalesce(F.lead(step).over(within), F.col("next_head"))
    first = F.lag("score").over(within).isNull() & F.col("above").isNull()
    return ranked.withColumn("corner", first | following.isNull() | (following != step)).where("corner")


def roc_auc(df: DataFrame, by: Sequence[str] = ("model",), per_range: int = SCORES_PER_RANGE) -> DataFrame:
    """``(*by, roc_auc)``: the share of positive-negative pairs ranked right, ties counting half;
    null if a group has one class only."""
    below = F.col("n_neg") - F.col("neg_from") + F.col("neg") / 2.0
    pairs = F.max("n_pos").cast("double") * F.max("n_neg")
    won = F.sum(F.col("pos") * below)
    area = F.when(pairs > 0, won / pairs)
    return ranked_scores(df, by, per_range).groupBy(*by).agg(round_half_up(area, METRIC_DIGITS).alias("roc_auc"))


def roc_curve(
    df: DataFrame, by: Sequence[str] = ("model",), per_range: int = SCORES_PER_RANGE, corners_only: bool = True
) -> DataFrame:
    """``(*by, threshold, fpr, tpr)``: the origin (null threshold) and a point per distinct score, without
    those that lie between equal steps unless all are asked for."""
    ranked = _ranked(df, by, per_range)
    points = (_corners(ranked, by) if corners_only else ranked).select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(F.col("neg_from").cast("double"), F.col("n_neg")).alias("fpr"),
        F.try_divide(F.col("pos_from").cast("double"), F.col("n_pos")).alias("tpr"),
    )
    origin = df.select(*by).distinct().select(
        *by, F.lit(None).cast("double").alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr")
    )
    return points.unionByName(origin)


def metrics(df: DataFrame, by: Sequence[str] = ("model",)) -> DataFrame:
    """``(*by, accuracy, precision, recall, f1, roc_auc)``."""
    keys = list(by)
    at_cut = _from_cells(_cells(df, by), by, "accuracy", "precision", "recall", "f1")
    return at_cut.join(roc_auc(df, by), keys).select(*keys, *METRICS)


def comparison(metric_rows: DataFrame, order_by: str = "f1", name: str = "model") -> DataFrame:
    """One row per model with its ``rank``, best first. One row per model, so one task ranks them."""
    order = W.partitionBy(F.lit(1)).orderBy(F.desc_nulls_last(order_by), name)
    return metric_rows.withColumn("rank", F.row_number().over(order).cast("bigint"))


def select_best(
    metric_rows: DataFrame, primary_metric: str = "f1", model_order: Sequence[str] = (), name: str = "model"
) -> DataFrame:
    """The row with the highest metric; among equals the one first in ``model_order``. Null is lowest."""
    place = F.array_position(F.array(*[F.lit(m) for m in model_order]).cast("array<string>"), F.col(name))
    place = F.when(place > 0, place).otherwise(len(model_order) + 1)
    return metric_rows.orderBy(F.desc_nulls_last(primary_metric), place, name).limit(1)
