"""Load, sample and split a labelled table.

    python -m opinara.plans.prepare --input PATH --output DIR [--subset dev|medium|full] [--config FILE.json]
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame

from opinara.config import SUBSETS, SplitConfig, read_config, subset_size
from opinara.operators.sampling import stratified_split, stratified_subset
from opinara.session import build_session
from opinara.sources.reviews import load_reviews
from opinara.sources.splits import write_splits
from opinara.staging import stage


def prepare(reviews: DataFrame, subset: str = "full", split: SplitConfig = SplitConfig()) -> DataFrame:
    """``reviews`` sampled and with ``split``.

    The deduplicated rows are staged: drawing reads their ids and labels a few times, and the
    split column is then a filter over them.
    """
    rows = stage(reviews, "reviews")
    n = subset_size(subset)
    if n is not None:
        rows = stage(stratified_subset(rows, n, seed=split.seed), "subset")
    return stratified_split(rows, split.test_size, split.val_size, seed=split.seed)


def main() -> None:
    parser = argparse.ArgumentParser(description="Write train, validation and test splits.")
    parser.add_argument("--input", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--format", default="csv")
    parser.add_argument("--id-column")
    parser.add_argument("--subset", choices=sorted(SUBSETS), default="full")
    parser.add_argument("--output-format", default="parquet")
    parser.add_argument("--config", help="JSON file with split parameters")
    args = parser.parse_args()
    split = read_config(args.config).split
    spark = build_session("opinara-prepare")
    rows = load_reviews(spark, args.input, args.format, args.id_column)
    write_splits(prepare(rows, args.subset, split), args.output, args.output_format)


if __name__ == "__main__":
    main()
