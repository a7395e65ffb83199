"""Trainable models by name."""

from __future__ import annotations

import math

from collections.abc import Callable
from typing import Any

from pyspark.ml.classification import (
    LinearSVC,
    LinearSVCModel,
    LogisticRegression,
    LogisticRegressionModel,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.functions.numeric import sigmoid
from opinara.operators.features import read_settings, vector_entries, write_settings
from opinara.operators.labels import with_class_weights
from opinara.operators.naive_bayes import LinearClassifier, fit_naive_bayes
from opinara.operators.sampling import stratified_folds
from opinara.staging import stage

#: Deepest tree MLlib grows.
MAX_TREE_DEPTH = 30

#: Rows worth a task of their own in the passes of a linear solver.
ROWS_PER_TASK = 5_000

#: MB of node statistics of a forest's task, least and most.
NODE_MB = (64, 1024)

#: Calibration folds.
CALIBRATION_FOLDS = 3


class LogisticClassifier:
    kind = "logistic"

    def __init__(self, model: LogisticRegressionModel):
        self.model = model

    def score(self, df: DataFrame) -> DataFrame:
        names = df.columns
        return self.model.transform(df).select(
            *names, F.col("prediction"), vector_to_array("probability")[1].alias("score")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> LogisticClassifier:
        return cls(LogisticRegressionModel.load(f"{path}/model"))


class MarginClassifier:
    """A bare linear SVM: the score is the margin, not a probability."""

    kind = "margin"

    def __init__(self, model: LinearSVCModel):
        self.model = model

    def score(self, df: DataFrame) -> DataFrame:
        names = df.columns
        return self.model.transform(df).select(
            *names, F.col("prediction"), vector_to_array("rawPrediction")[1].alias("score")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> MarginClassifier:
        return cls(LinearSVCModel.load(f"{path}/model"))


class CalibratedClassifier:
    """Mean probability of several (linear margin, sigmoid) pairs."""

    kind = "calibrated"

    def __init__(self, members: list[tuple[LinearClassifier, float, float]]):
        self.members = members

    def score(self, df: DataFrame) -> DataFrame:
        names = df.columns
        total = F.lit(0.0)
        for i, (margin, slope, shift) in enumerate(self.members):
            df = margin.margin(df, f"__margin{i}")
            total = total + sigmoid(F.col(f"__margin{i}") * slope + shift)
        mean = total / len(self.members)
        return df.select(*names, (mean > 0.5).cast("double").alias("prediction"), mean.alias("score"))

    def save(self, spark: SparkSession, path: str) -> None:
        for i, (margin, _, _) in enumerate(self.members):
            margin.save(spark, f"{path}/member{i}")
        write_settings(spark, {"sigmoids": [[a, b] for _, a, b in self.members]}, f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> CalibratedClassifier:
        sigmoids = read_settings(spark, f"{path}/settings")["sigmoids"]
        return cls(
            [(LinearClassifier.load(spark, f"{path}/member{i}"), a, b) for i, (a, b) in enumerate(sigmoids)]
        )


class ForestClassifier:
    """A forest over all features."""

    kind = "forest"

    def __init__(self, model: RandomForestClassificationModel):
        self.model = model

    def score(self, df: DataFrame) -> DataFrame:
        names = df.columns
        return self.model.transform(df).select(
            *names, F.col("prediction"), vector_to_array("probability")[1].alias("score")
        )

    def save(self, spark: SparkSession, path: str) -> None:
        self.model.write().overwrite().save(f"{path}/model")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> ForestClassifier:
        return cls(RandomForestClassificationModel.load(f"{path}/model"))


def _weighted(df: DataFrame, params: dict[str, Any]) -> tuple[DataFrame, dict[str, str], float]:
    """Rows with class weights if asked for, the estimator setting, and the total weight."""
    if params.get("class_weight") == "balanced":
        df = with_class_weights(df)
        return df, {"weightCol": "weight"}, df.agg(F.sum("weight")).first()[0]
    return df, {}, float(df.count())


def _packed(df: DataFrame, rows: float) -> DataFrame:
    """Fewer, fuller partitions for a solver's many passes; large tables keep theirs."""
    return df.coalesce(max(1, math.ceil(rows / ROWS_PER_TASK)))


def _spread(df: DataFrame, rows: float) -> DataFrame:
    """A large table in even partitions, one a core at least: passes wait for the fullest; small tables keep theirs."""
    if rows <= ROWS_PER_TASK:
        return df
    return df.repartition(max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()))


def fit_logistic(df: DataFrame, params: dict[str, Any], seed: int, n_features: int) -> LogisticClassifier:
    """L2 penalty 1/C on the summed loss, which MLlib averages."""
    df, extra, total = _weighted(df, params)
    estimator = LogisticRegression(
        regParam=1.0 / (params.get("C", 1.0) * total),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=params.get("max_iter", 100),
        tol=params.get("tol", 1e-4),
        **extra,
    )
    return LogisticClassifier(estimator.fit(_packed(df, total)))


def fit_sgd_linear(df: DataFrame, params: dict[str, Any], seed: int, n_features: int) -> LogisticClassifier:
    """Log loss averaged over rows with an L2 penalty ``alpha``."""
    df, extra, total = _weighted(df, params)
    estimator = LogisticRegression(
        regParam=params.get("alpha", 0.0001),
        elasticNetParam=0.0,
        standardization=False,
        maxIter=params.get("max_iter", 1000),
        tol=params.get("tol", 1e-4),
        **extra,
    )
    return LogisticClassifier(estimator.fit(_packed(df, total)))


def _fit_svc(df: DataFrame, params: dict[str, Any]) -> LinearSVCModel:
    df, extra, total = _weighted(df, params)
    return LinearSVC(
        regParam=1.0 / (params.get("C", 1.0) * total),
        standardization=False,
        maxIter=params.get("max_iter", 100),
        tol=params.get("tol", 1e-4),
        **extra,
    ).fit(_packed(df, total))


def fit_linear_svm(df: DataFrame, params: dict[str, Any], seed: int, n_features: int) -> MarginClassifier:
    return MarginClassifier(_fit_svc(df, params))


def _fit_sigmoid(margins: DataFrame) -> tuple[float, float]:
    """Platt's sigmoid over ``(label, margin)``.

    The smoothed targets become two weighted rows per margin: the target's share as a positive and
    the remainder as a negative.
    """
    sizes = margins.agg(*[F.count_if(F.col("label") == c).alias(f"n_{c}") for c in (0, 1)]).first()
    high = (sizes.n_1 + 1.0) / (sizes.n_1 + 2.0)
    low = 1.0 / (sizes.n_0 + 2.0)
    target = F.when(F.col("label") == 1, F.lit(high)).otherwise(F.lit(low))
    cell = F.array("margin")
    schema = "array<struct<label:double,weight:double>>"
    both = F.array(
        F.struct(F.lit(1.0).alias("label"), target.alias("weight")),
        F.struct(F.lit(0.0).alias("label"), (1.0 - target).alias("weight")),
    ).cast(schema)
    rows = margins.select(array_to_vector(cell).alias("features"), F.inline(both))
    model = LogisticRegression(regParam=0.0, standardization=False, maxIter=200, tol=1e-9, weightCol="weight").fit(_packed(rows, 2.0 * (sizes.n_0 + sizes.n_1)))
    return float(model.coefficients[0]), float(model.intercept)


def fit_calibrated_svm(df: DataFrame, params: dict[str, Any], seed: int, n_features: int) -> CalibratedClassifier:
    """One SVM per fold, fitted on the other folds and calibrated on the fold itself."""
    df = stage(stratified_folds(df.select("id", "label", "features"), CALIBRATION_FOLDS, seed=seed), "folds")
    members = []
    for fold in range(CALIBRATION_FOLDS):
        model = _fit_svc(df.where(F.col("fold") != fold).drop("fold"), params)
        margin = LinearClassifier([float(x) for x in model.coefficients.toArray()], float(model.intercept))
        held_out = margin.margin(df.where(F.col("fold") == fold).select("label", "features")).select("label", "margin")
        members.append((margin, *_fit_sigmoid(held_out)))
    return CalibratedClassifier(members)


def fit_multinomial_nb(df: DataFrame, params: dict[str, Any], seed: int, n_features: int) -> LinearClassifier:
    return fit_naive_bayes(df, n_features, params.get("alpha", 1.0))


def _memory_of_a_task(spark: SparkSession) -> float:
    """MB that Spark manages in an executor for each of the tasks that run in it at once."""
    context = spark.sparkContext
    driver = context._jvm.org.apache.spark.SparkEnv.get().blockManager().blockManagerId().hostPort()
    status, sizes = context._jsc.sc().getExecutorMemoryStatus().iterator(), {}
    while status.hasNext():
        entry = status.next()
        sizes[entry._1()] = entry._2()._1() / 2**20
    # A local session runs its tasks in the driver.
    executors = [size for place, size in sizes.items() if place != driver] or list(sizes.values())
    return min(executors) / max(1.0, context.defaultParallelism / len(executors))


def node_memory(spark: SparkSession) -> int:
    """MB of node statistics a task of the forest may keep, in MLlib's count.

    A quarter of its memory: rows, as dense bins, and the sums of other tasks have to fit too, and what MLlib
    keeps is half as much again as it counts. More nodes take more passes.
    """
    return int(min(NODE_MB[1], max(NODE_MB[0], _memory_of_a_task(spark) / 4)))


def fit_random_forest(df: DataFrame, params: dict[str, Any], seed: int, n_features: int) -> ForestClassifier:
    """A forest over all features. MLlib bins them densely: rows times features has to fit the executors.

    Rows remember the node they are in, so a pass for a level does not walk every tree from its root. A pass
    takes as many nodes as a task has memory for (``node_memory``).
    """
    df, extra, total = _weighted(df, params)
    depth = params.get("max_depth", MAX_TREE_DEPTH)
    if depth > MAX_TREE_DEPTH:
        raise ValueError(f"max_depth is {depth}; MLlib grows trees of {MAX_TREE_DEPTH} levels at most")
    estimator = RandomForestClassifier(
        numTrees=params.get("n_estimators", 100),
        maxDepth=depth,
        featureSubsetStrategy="sqrt",
        seed=seed,
        maxMemoryInMB=params.get("max_memory_mb") or node_memory(df.sparkSession),
        cacheNodeIds=True,
        **extra,
    )
    return ForestClassifier(estimator.fit(_spread(df.select("label", "features", *extra.values()), total)))


Fit = Callable[[DataFrame, dict[str, Any], int, int], Any]

#: Name -> function(rows with features and label, parameters, seed, number of features).
MODELS: dict[str, Fit] = {}


def register_model(name: str, fit: Fit) -> None:
    MODELS[name] = fit


def model_fitter(name: str) -> Fit:
    if name not in MODELS:
        raise ValueError(f"Unknown model {name!r}; choose one of {sorted(MODELS)}")
    return MODELS[name]


register_model("logistic_regression", fit_logistic)
register_model("linear_svm", fit_calibrated_svm)
register_model("multinomial_nb", fit_multinomial_nb)
register_model("random_forest", fit_random_forest)
register_model("sgd_linear", fit_sgd_linear)

_KINDS = {
    c.kind: c
    for c in (LinearClassifier, LogisticClassifier, MarginClassifier, CalibratedClassifier, ForestClassifier)
}


def save_model(spark: SparkSession, model, path: str) -> None:
    model.save(spark, path)
    write_settings(spark, {"kind": model.kind}, f"{path}/kind")


def load_model(spark: SparkSession, path: str):
    return _KINDS[read_settings(spark, f"{path}/kind")["kind"]].load(spark, path)
