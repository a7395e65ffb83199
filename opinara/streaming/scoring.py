"""Scoring a stream of texts.

    python -m opinara.streaming.scoring --model DIR --input DIR --output DIR --checkpoint DIR
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from opinara.operators.cleaning import LexiconTooLarge
from opinara.plans.score import Scorer, load_scorer, score
from opinara.session import build_session


def score_stream(stream: DataFrame, scorer: Scorer, text_column: str = "review") -> DataFrame:
    """A scored stream, a chain of projections.

    The lexicon of the saved model travels to the rows and decides the lemmas of every word in place,
    whatever words the stream brings; ``LexiconTooLarge`` if it cannot (see ``start_scoring``).
    """
    return score(stream, scorer, text_column)


def start_scoring(
    stream: DataFrame, scorer: Scorer, out: str, checkpoint: str, text_column: str = "review", fmt: str = "parquet"
) -> StreamingQuery:
    """Score what the source holds now and append it to ``out``; run again for what came since.

    The file sink commits every file once, through restarts. Only if the lexicon is too large to
    travel, every micro-batch is scored as a table of its own and written under its number, so a
    batch that is repeated after a failure replaces itself.
    """
    try:
        scored = score_stream(stream, scorer, text_column)
        writer = scored.writeStream.format(fmt).option("path", out)
    except LexiconTooLarge:

        def write_batch(batch: DataFrame, number: int) -> None:
            score(batch, scorer, text_column).write.mode("overwrite").format(fmt).save(f"{out}/batch={number}")

        writer = stream.writeStream.foreachBatch(write_batch)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def main() -> None:
    parser = argparse.ArgumentParser(description="Score the files that a folder has got since the last run.")
    parser.add_argument("--model", required=True)
    parser.add_argument("--model-name")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True)
    parser.add_argument("--format", default="parquet")
    parser.add_argument("--text-column", default="review")
    args = parser.parse_args()
    spark = build_session("opinara-stream")
    schema = spark.read.format(args.format).load(args.input).schema
    stream = spark.readStream.schema(schema).format(args.format).load(args.input)
    scorer = load_scorer(spark, args.model, args.model_name)
    start_scoring(stream, scorer, args.output, args.checkpoint, args.text_column).awaitTermination()


if __name__ == "__main__":
    main()
