"""Evaluate saved models on held-out rows.

    python -m opinara.plans.evaluate --model DIR --splits DIR [--models NAME ...]
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.operators.classifiers import load_model
from opinara.operators.cleaning import clean_table
from opinara.operators.evaluation import comparison, confusion_matrix, metrics, roc_curve
from opinara.operators.features import read_settings
from opinara.operators.labels import check_labels, encode_label
from opinara.plans.score import load_scorer
from opinara.plans.train import predictions
from opinara.session import build_session
from opinara.sources.sinks import write_result
from opinara.sources.splits import load_splits
from opinara.staging import stage

log = logging.getLogger(__name__)


def held_out_predictions(
    spark: SparkSession, path: str, rows: DataFrame, names: list[str] | None = None
) -> DataFrame:
    """Predictions of every saved model among ``names``; a missing one is skipped with a warning."""
    saved = read_settings(spark, f"{path}/settings")["models"]
    wanted = names or saved
    for name in wanted:
        if name not in saved:
            log.warning("no saved model %s under %s; skipped", name, path)
    wanted = [name for name in wanted if name in saved]
    if not wanted:
        raise ValueError(f"none of the models {names} is saved under {path}")
    check_labels(rows)
    scorer = load_scorer(spark, path, wanted[0])
    labelled = rows.select("id", encode_label(F.col("sentiment")).alias("label"), "review")
    cleaned = clean_table(labelled, scorer.cleaning, lexicon=scorer.lexicon)
    features = stage(scorer.terms.transform(cleaned).select("id", "label", "features"), "features")
    models = {name: load_model(spark, f"{path}/models/{name}") for name in wanted}
    return stage(predictions(features, models), "predictions")


def evaluate(spark: SparkSession, path: str, rows: DataFrame, names: list[str] | None = None, write: bool = True) -> DataFrame:
    """Metrics per model, best first; optionally written with confusion cells and ROC points."""
    predicted = held_out_predictions(spark, path, rows, names)
    scores = comparison(metrics(predicted))
    if write:
        write_result(scores.drop("rank"), f"{path}/metrics/test", "json")
        write_result(scores, f"{path}/metrics/test_comparison", "csv")
        write_result(confusion_matrix(predicted), f"{path}/metrics/test_confusion", "json")
        write_result(roc_curve(predicted), f"{path}/metrics/test_roc", "parquet")
    return scores


def main() -> None:
    parser = argparse.ArgumentParser(description="Evaluate saved models on the test split.")
    parser.add_argument("--model", required=True)
    parser.add_argument("--splits", required=True)
    parser.add_argument("--models", nargs="+")
    args = parser.parse_args()
    spark = build_session("opinara-evaluate")
    evaluate(spark, args.model, load_splits(spark, args.splits, "test"), args.models).orderBy("rank").show(truncate=False)


if __name__ == "__main__":
    main()
