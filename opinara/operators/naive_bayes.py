"""Multinomial naive Bayes as aggregates.

With two classes the log-odds are linear in the features, so a fitted model is an intercept and
one weight per term, and scoring is an inner product.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.functions.numeric import round_half_up, sigmoid
from opinara.operators.features import dot, read_settings, vector_entries, write_settings

#: Digits kept of a margin before its sign decides the class.
MARGIN_DIGITS = 9


def term_mass(df: DataFrame, label: str = "label", weight: str | None = None) -> DataFrame:
    """``(idx, mass_0, mass_1)``: feature weight per term and class."""
    factor = F.lit(1.0) if weight is None else F.col(weight)
    entries = vector_entries(df, label, factor.alias("factor"))
    amount = F.col("weight") * F.col("factor")
    by_class = [F.sum(F.when(F.col(label) == c, amount).otherwise(0.0)).alias(f"mass_{c}") for c in (0, 1)]
    return entries.groupBy("idx").agg(*by_class)


class LinearClassifier:
    """``sigmoid(intercept + features . weights)``; a margin of 0 is negative."""

    kind = "linear"

    def __init__(self, weights: list[float], intercept: float):
        self.weights, self.intercept = weights, intercept

    def margin(self, df: DataFrame, out: str = "margin") -> DataFrame:
        scored = dot(df, self.weights, "features", out)
        return scored.withColumn(out, F.col(out) + self.intercept)

    def score(self, df: DataFrame) -> DataFrame:
        names = df.columns
        margin = F.col("__margin")
        return self.margin(df, "__margin").select(
            *names,
            (round_half_up(margin, MARGIN_DIGITS) > 0).cast("double").alias("prediction"),
            sigmoid(margin).alias("score"),
        )

    def save(self, spark: SparkSession, path: str) -> None:
        rows = list(enumerate(self.weights))
        spark.createDataFrame(rows, "idx int, weight double").coalesce(1).write.mode("overwrite").parquet(
            f"{path}/weights"
        )
        write_settings(spark, {"intercept": self.intercept}, f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LinearClassifier:
        rows = sorted(spark.read.parquet(f"{path}/weights").collect())
        return cls([r.weight for r in rows], read_settings(spark, f"{path}/settings")["intercept"])


def fit_naive_bayes(
    df: DataFrame, n_features: int, alpha: float = 1.0, label: str = "label", weight: str | None = None
) -> LinearClassifier:
    """Fit from ``features``; both class masses come back as one row per term."""
    amount = F.lit(1.0) if weight is None else F.col(weight)
    sizes = df.agg(*[F.sum(F.when(F.col(label) == c, amount)).alias(f"n_{c}") for c in (0, 1)]).first()
    if not sizes.n_0 or not sizes.n_1:
        raise ValueError("naive Bayes needs rows of both classes")
    mass = {0: [alpha] * n_features, 1: [alpha] * n_features}
    for row in term_mass(df, label, weight).collect():
        mass[0][row.idx] += row.mass_0
        mass[1][row.idx] += row.mass_1
    total = {c: math.log(math.fsum(mass[c])) for c in (0, 1)}
    weights = [(math.log(p) - total[1]) - (math.log(q) - total[0]) for q, p in zip(mass[0], mass[1])]
    return LinearClassifier(weights, math.log(sizes.n_1) - math.log(sizes.n_0))
