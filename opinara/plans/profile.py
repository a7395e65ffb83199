"""Profile a labelled table.

    python -m opinara.plans.profile (--splits DIR | --input PATH) --output DIR [--config FILE.json]
"""

from __future__ import annotations

import argparse
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from opinara.config import ProfileConfig, read_config
from opinara.operators import profiling as p
from opinara.operators.cleaning import clean_table
from opinara.operators.sampling import sample_reviews
from opinara.session import build_session
from opinara.sources.reviews import load_reviews
from opinara.sources.sinks import write_result
from opinara.sources.splits import load_splits
from opinara.staging import stage


def profile(
    raw: DataFrame, clean: DataFrame | None = None, splits: DataFrame | None = None,
    config: ProfileConfig = ProfileConfig(),
) -> dict[str, DataFrame]:
    """One DataFrame per section.

    ``clean`` has ``clean_review``; without it words are counted in the raw text. Pass staged or
    stored tables. The sections on lengths read one staged table of length frequencies, made in one
    scan of the texts; of the others, repeated texts, terms and samples scan the text.
    """
    measures = stage(p.measure_table(raw), "measures")
    chars, lengths = p.measured(measures, "chars"), p.measured(measures, "words")
    by_label = p.measured(measures, "words", "sentiment")
    words, text = (clean, "clean_review") if clean is not None else (raw, "review")
    low, high = config.ngram_range
    sections = {
        "dataset_overview": p.dataset_overview(raw),
        "missing_values": p.missing_values(raw),
        "duplicate_stats": p.duplicate_stats(raw),
        "label_distribution": p.label_distribution(raw),
        "char_length_stats": p.describe(chars),
        "word_count_stats": p.describe(lengths),
        "length_histogram": p.histogram(chars, config.histogram_bins),
        "word_histogram": p.histogram(lengths, config.histogram_bins),
        "classwise_word_stats": p.describe(by_label, "sentiment"),
        "classwise_boxplot": p.boxplot(by_label),
        "top_words": p.top_words(words, text, config.top_n_words),
        "top_ngrams": p.top_ngrams(words, text, low, high, config.top_n_ngrams),
        "class_term_freq": p.class_term_freq(words, text, k=config.class_terms),
        "sample_reviews": sample_reviews(
            raw, config.sample_rows, seed=config.seed, snippet_chars=config.snippet_chars
        ),
    }
    if splits is not None:
        sections["split_inspection"] = p.split_inspection(splits)
    return sections


#: Section -> columns that name a row.
SECTION_KEYS = {
    "dataset_overview": ("column_name", "dtype"),
    "missing_values": ("column_name",),
    "duplicate_stats": (),
    "label_distribution": ("sentiment",),
    "char_length_stats": (),
    "word_count_stats": (),
    "length_histogram": ("bin",),
    "word_histogram": ("bin",),
    "classwise_word_stats": ("sentiment",),
    "classwise_boxplot": ("sentiment",),
    "top_words": ("term",),
    "top_ngrams": ("term",),
    "class_term_freq": ("sentiment", "term"),
    "split_inspection": ("split", "sentiment"),
    "sample_reviews": ("id", "sentiment", "review_snippet"),
}


def _tidy(section: str, df: DataFrame) -> DataFrame:
    keys = SECTION_KEYS[section]
    values = [c for c in df.columns if c not in keys] or None
    key = F.concat_ws("|", *[F.col(k).cast("string") for k in keys]) if keys else F.lit("")

    def entry(stat: str, value: Column):
        return F.struct(F.lit(stat).alias("stat"), value.cast("double").alias("value"))

    entries = [entry(c, F.col(c)) for c in values] if values else [entry("row", F.lit(1))]
    return df.select(F.lit(section).alias("section"), key.alias("key"), F.inline(F.array(*entries)))


def profile_report(sections: dict[str, DataFrame]) -> DataFrame:
    """``(section, key, stat, value)``, one row per statistic."""
    return reduce(DataFrame.unionByName, [_tidy(name, df) for name, df in sections.items()])


def main() -> None:
    parser = argparse.ArgumentParser(description="Profile the training rows, or a table without splits.")
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--splits")
    source.add_argument("--input")
    parser.add_argument("--format", default="csv", help="of --input")
    parser.add_argument("--id-column", help="of --input")
    parser.add_argument("--output", required=True)
    parser.add_argument("--config", help="JSON file with profile and cleaning parameters")
    args = parser.parse_args()
    config = read_config(args.config)
    spark = build_session("opinara-profile")
    if args.splits:
        splits = load_splits(spark, args.splits)
        raw = load_splits(spark, args.splits, "train").select("id", "review", "sentiment")
    else:
        splits = None
        raw = stage(load_reviews(spark, args.input, args.format, args.id_column), "reviews")
    clean = clean_table(raw, config.training.cleaning)
    report = profile_report(profile(raw, stage(clean, "clean"), splits, config.profile))
    write_result(report, args.output, "json")


if __name__ == "__main__":
    main()
