"""Scoring new text with a saved model.

    python -m opinara.plans.score --model DIR --input PATH --output PATH [--model-name NAME] [--preview ROWS]
    python -m opinara.plans.score --model DIR --text "a text" [--model-name NAME]
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass, replace
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.config import CleaningConfig
from opinara.functions.numeric import round_half_up
from opinara.functions.text import wants_lemmas
from opinara.operators.cleaning import clean_table
from opinara.operators.classifiers import load_model
from opinara.operators.evaluation import METRIC_DIGITS
from opinara.operators.features import TermModel, read_settings
from opinara.operators.labels import decode_label
from opinara.session import build_session
from opinara.sources.reviews import read_table
from opinara.sources.sinks import write_result


@dataclass(frozen=True)
class Scorer:
    """A fitted model with everything its texts go through."""

    cleaning: CleaningConfig
    terms: TermModel
    model: Any
    model_name: str
    lexicon: DataFrame | None = None


def model_scores(df: DataFrame, scorer: Scorer, text_column: str) -> DataFrame:
    """All columns plus ``prediction`` and ``score``; every row survives, null text scores as empty.

    Without lemmas, and on a stream, this is a chain of projections.
    """
    if text_column not in df.columns:
        raise ValueError(f"missing text column {text_column!r}; found columns {df.columns}")
    names = df.columns
    cleaned = clean_table(df, scorer.cleaning, text_column, "__clean", scorer.lexicon)
    featured = scorer.terms.transform(cleaned, "__clean", "features")
    return scorer.model.score(featured).select(*names, "prediction", "score")


def score(df: DataFrame, scorer: Scorer, text_column: str = "review") -> DataFrame:
    """All columns plus ``predicted_label`` and ``confidence``, the probability of *positive*."""
    names = df.columns
    return model_scores(df, scorer, text_column).select(
        *names,
        decode_label(F.col("prediction")).alias("predicted_label"),
        confidence(F.col("score"), scorer).alias("confidence"),
    )


def confidence(score_column, scorer: Scorer):
    """The positive-class probability; a bare margin is squashed to one."""
    if getattr(scorer.model, "kind", None) == "margin":
        score_column = 1.0 / (1.0 + F.exp(-score_column))
    return round_half_up(score_column, METRIC_DIGITS)


def predict_batch(df: DataFrame, scorer: Scorer, text_column: str = "review") -> DataFrame:
    """``(text, predicted_label, confidence, model_used)``."""
    texts = df.select(F.col(text_column).alias("text"))
    return score(texts, scorer, "text").withColumn("model_used", F.lit(scorer.model_name))


def champion(spark: SparkSession, path: str) -> str:
    return read_settings(spark, f"{path}/champion")["model"]


def load_scorer(spark: SparkSession, path: str, model_name: str | None = None) -> Scorer:
    """The champion, or a model by name."""
    settings = read_settings(spark, f"{path}/settings")
    name = model_name or champion(spark, path)
    if name not in settings["models"]:
        raise ValueError(f"no saved model {name!r} under {path}; saved models are {settings['models']}")
    cleaning = CleaningConfig(**settings["cleaning"])
    lexicon = spark.read.parquet(f"{path}/lexicon") if wants_lemmas(cleaning) else None
    return Scorer(cleaning, TermModel.load(spark, f"{path}/features"), load_model(spark, f"{path}/models/{name}"), name, lexicon)


def with_model(spark: SparkSession, scorer: Scorer, path: str, name: str) -> Scorer:
    """The same features with another saved model."""
    return replace(scorer, model=load_model(spark, f"{path}/models/{name}"), model_name=name)


def score_table(
    spark: SparkSession, path: str, scorer: Scorer, text_column: str = "review", fmt: str = "csv",
    out: str | None = None, out_fmt: str = "csv",
) -> DataFrame:
    """Score a stored table: all its columns plus label and confidence, optionally written."""
    scored = score(read_table(spark, path, fmt), scorer, text_column)
    if out is not None:
        write_result(scored, out, out_fmt)
    return scored


def preview(df: DataFrame, id_col: str = "id", k: int = 10) -> DataFrame:
    return df.orderBy(id_col).limit(k)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Score a table of texts, or one text.")
    parser.add_argument("--model", required=True)
    parser.add_argument("--model-name")
    parser.add_argument("--text", help="one text, whose label is printed")
    parser.add_argument("--input", help="a table")
    parser.add_argument("--output", help="where the scored table is written; without it, it is only previewed")
    parser.add_argument("--format", default="csv", help="of the input")
    parser.add_argument("--output-format", help="that of the input unless told")
    parser.add_argument("--text-column", default="review")
    parser.add_argument("--preview", type=int, metavar="ROWS", help="scored rows to print; 10 without an output, else 0")
    args = parser.parse_args(argv)
    if args.text is None and args.input is None:
        parser.error("give a --text, an --input or both")
    spark = build_session("opinara-score")
    scorer = load_scorer(spark, args.model, args.model_name)
    if args.text is not None:
        predict_batch(spark.createDataFrame([(args.text,)], "review string"), scorer).show(truncate=False)
    if args.input is not None:
        out_format = args.output_format or args.format
        scored = score_table(spark, args.input, scorer, args.text_column, args.format, args.output, out_format)
        rows = args.preview if args.preview is not None else 0 if args.output else 10
        if rows > 0:
            scored.show(rows, truncate=False)


if __name__ == "__main__":
    main()
