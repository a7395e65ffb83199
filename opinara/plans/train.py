"""Train, compare and save models.

    python -m opinara.plans.train --splits DIR --output DIR [--models NAME ...] [--config FILE.json]
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import asdict, dataclass, replace
from functools import reduce
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.config import TrainingConfig, read_config
from opinara.functions.text import wants_lemmas
from opinara.operators.classifiers import model_fitter, save_model
from opinara.operators.cleaning import clean_table, cleaned_words, lemmas_of_words
from opinara.operators.evaluation import comparison, metrics, select_best
from opinara.operators.features import TermModel, write_settings
from opinara.operators.labels import check_labels, encode_label
from opinara.operators.lemmas import recurring_forms, row_frequencies
from opinara.plans.score import Scorer
from opinara.session import build_session
from opinara.sources.sinks import write_result
from opinara.sources.splits import load_splits
from opinara.staging import stage


@dataclass(frozen=True)
class Trained:
    config: TrainingConfig
    terms: TermModel
    models: dict[str, Any]
    validation: DataFrame
    champion: str
    lexicon: DataFrame | None = None

    def scorer(self, name: str | None = None) -> Scorer:
        name = name or self.champion
        return Scorer(self.config.cleaning, self.terms, self.models[name], name, self.lexicon)


def clean_splits(
    splits: DataFrame, config: TrainingConfig, lexicon: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """``(id, split, label, clean_review)`` staged by split, and the lexicon used.

    Without a lexicon the words of the training rows serve, so held-out rows do not leak into it.
    """
    check_labels(splits)
    text = "clean_review"
    rows = splits.select("id", "split", encode_label(F.col("sentiment")).alias("label"), F.col("review").alias(text))
    if wants_lemmas(config.cleaning):
        words = cleaned_words(rows, config.cleaning, text, text)
        if lexicon is None:
            lexicon = stage(recurring_forms(row_frequencies(words.where("split = 'train'"), text)), "lexicon")
        cleaned = lemmas_of_words(words, text, lexicon)
    else:
        cleaned = clean_table(rows, config.cleaning, text)
    return stage(cleaned, "clean", partition_by="split"), lexicon


def feature_table(cleaned: DataFrame, config: TrainingConfig) -> tuple[TermModel, DataFrame]:
    """A term model fitted on the training rows alone, and the features of all rows, staged once
    for every model."""
    train = cleaned.where("split = 'train'")
    terms = TermModel.fit(train, config.features)
    features = terms.transform(cleaned, "clean_review").drop("clean_review")
    return terms, stage(features, "features", partition_by="split")


def train_all(
    features: DataFrame, terms: TermModel, config: TrainingConfig, at_once: int | None = None
) -> dict[str, Any]:
    """Fit every active model on the same staged training rows, ``at_once`` of them at a time (all,
    unless told).

    A fit is a chain of short jobs that leaves cores idle, so fits run side by side, each in a
    scheduler pool of its name; with the fair scheduler (``build_session``) a long one does not
    hold up the rest. Every thread starts with the caller's job properties. The models are those
    of fits one after another.
    """
    if not config.active_models:
        return {}
    rows = features.where("split = 'train'").select("id", "label", "features")
    spark = features.sparkSession
    context = spark.sparkContext

    def fit(name: str) -> Any:
        context.setLocalProperty("spark.scheduler.pool", name)
        return model_fitter(name)(rows, config.params_for(name), config.seed, len(terms.vocabulary))

    with ThreadPoolExecutor(at_once or len(config.active_models)) as threads:
        fits = {name: threads.submit(inheritable_thread_target(spark)(fit), name) for name in config.active_models}
    return {name: running.result() for name, running in fits.items()}


def predictions(features: DataFrame, models: dict[str, Any]) -> DataFrame:
    """``(model, id, label, prediction, score)``: one pass over ``features`` per model."""
    rows = features.select("id", "label", "features")
    parts = [
        model.score(rows).select(F.lit(name).alias("model"), "id", "label", "prediction", "score")
        for name, model in models.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def validate(features: DataFrame, models: dict[str, Any], config: TrainingConfig) -> DataFrame:
    """Metrics of every model on the validation rows."""
    held_out = features.where("split = 'val'")
    return stage(metrics(stage(predictions(held_out, models), "predictions")), "validation")


def choose_champion(validation: DataFrame, config: TrainingConfig) -> str:
    """The model that is best by the primary metric; the first of the active ones among equals."""
    return select_best(validation, config.primary_metric, config.active_models).first().model


def train(
    splits: DataFrame, config: TrainingConfig = TrainingConfig(), lexicon: DataFrame | None = None, steps: Steps | None = None
) -> Trained:
    """Clean, build features, fit, evaluate on validation rows, choose a champion, by ``steps``."""
    steps = steps or Steps()
    cleaned, lexicon = steps.clean(splits, config, lexicon)
    terms, features = steps.build_features(cleaned, config)
    models = steps.fit(features, terms, config)
    validation = steps.evaluate(features, models, config)
    return Trained(config, terms, models, validation, steps.choose(validation, config), lexicon)


def save(spark: SparkSession, trained: Trained, path: str) -> None:
    """Features once, every model, and the champion's name."""
    trained.terms.save(spark, f"{path}/features")
    for name, model in trained.models.items():
        save_model(spark, model, f"{path}/models/{name}")
    if trained.lexicon is not None:
        trained.lexicon.write.mode("overwrite").parquet(f"{path}/lexicon")
    settings = {"cleaning": asdict(trained.config.cleaning), "models": list(trained.models)}
    write_settings(spark, settings, f"{path}/settings")
    write_settings(
        spark, {"model": trained.champion, "primary_metric": trained.config.primary_metric}, f"{path}/champion"
    )
    write_result(trained.validation, f"{path}/metrics/validation", "json")
    write_result(comparison(trained.validation), f"{path}/metrics/validation_comparison", "csv")


@dataclass(frozen=True)
class Steps:
    """What a training job does, in order; ``replace(Steps(), choose=...)`` puts in another step.

    A step gets what the ones before it returned, as the default of that step does, so tables stay
    DataFrames from the first step to the last.
    """

    clean: Callable[[DataFrame, TrainingConfig, DataFrame | None], tuple[DataFrame, DataFrame | None]] = clean_splits
    build_features: Callable[[DataFrame, TrainingConfig], tuple[TermModel, DataFrame]] = feature_table
    fit: Callable[[DataFrame, TermModel, TrainingConfig], dict[str, Any]] = train_all
    evaluate: Callable[[DataFrame, dict[str, Any], TrainingConfig], DataFrame] = validate
    choose: Callable[[DataFrame, TrainingConfig], str] = choose_champion
    persist: Callable[[SparkSession, Trained, str], None] = save


def run_job(
    splits: DataFrame, path: str, config: TrainingConfig = TrainingConfig(), lexicon: DataFrame | None = None,
    steps: Steps | None = None,
) -> Trained:
    """``train``, and its result written to ``path``."""
    steps = steps or Steps()
    trained = train(splits, config, lexicon, steps)
    steps.persist(splits.sparkSession, trained, path)
    return trained


def main() -> None:
    parser = argparse.ArgumentParser(description="Train and compare models.")
    parser.add_argument("--splits", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--models", nargs="+")
    parser.add_argument("--config", help="JSON file with training parameters")
    args = parser.parse_args()
    config = read_config(args.config).training
    if args.models:
        config = replace(config, active_models=tuple(args.models))
    spark = build_session("opinara-train")
    trained = run_job(load_splits(spark, args.splits), args.output, config)
    comparison(trained.validation).orderBy("rank").show(truncate=False)


if __name__ == "__main__":
    main()
