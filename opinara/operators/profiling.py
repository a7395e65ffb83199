"""Corpus profile."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opinara.functions.numeric import round_half_up
from opinara.functions.rows import element_rows
from opinara.functions.text import split_words
from opinara.functions.tokens import without_stopwords, word_tokens
from opinara.functions.wordlists import COUNTER_STOPWORDS
from opinara.operators.heavy_hitters import most_frequent
from opinara.operators.ranking import top_per_group
from opinara.staging import stage

QUARTILES = (0.25, 0.5, 0.75)
STATS = ("count", "mean", "std", "min", "q25", "q50", "q75", "max")


def dataset_overview(df: DataFrame) -> DataFrame:
    """``(column_name, dtype, n_rows, n_columns)``, one row per column."""
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.lit(t).alias("dtype")) for c, t in df.dtypes])
    rows = df.agg(F.count(F.lit(1)).alias("n_rows"))
    return rows.select(F.inline(entries), "n_rows", F.lit(len(df.columns)).cast("bigint").alias("n_columns"))


def missing_values(df: DataFrame) -> DataFrame:
    """``(column_name, n_missing, pct_missing)``."""
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *[F.count_if(F.col(f"`{c}`").isNull()).alias(f"c_{n}") for n, c in enumerate(df.columns)])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c_{n}").alias("n_missing")) for n, c in enumerate(df.columns)])
    share = F.try_divide(F.col("n_missing") * 100.0, F.col("n_rows"))
    return counts.select(F.inline(entries), "n_rows").select(
        "column_name", "n_missing", round_half_up(share, 3).alias("pct_missing")
    )


def duplicate_stats(df: DataFrame, text: str = "review") -> DataFrame:
    """``(n_rows, n_duplicates, pct_duplicates)``: rows repeating an earlier text; null is one text.

    Only 256-bit digests and counts are shuffled, after copies met on the map side.
    """
    copies = df.groupBy(F.sha2(text, 256).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    sums = copies.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"), F.count(F.lit(1)).alias("n_texts"))
    duplicates = F.col("n_rows") - F.col("n_texts")
    share = F.try_divide(duplicates * 100.0, F.col("n_rows"))
    return sums.select(
        "n_rows", duplicates.alias("n_duplicates"), round_half_up(share, 3).alias("pct_duplicates")
    )


def label_distribution(df: DataFrame, label: str = "sentiment") -> DataFrame:
    """``(label, n, pct)``; shares are of all rows, null labels included."""
    sizes = df.groupBy(F.col(label)).agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.sum("n").alias("total"))
    share = round_half_up(F.col("n") * 100.0 / F.col("total"), 2)
    return sizes.crossJoin(F.broadcast(total)).where(F.col(label).isNotNull()).select(label, "n", share.alias("pct"))


def char_length(text: str) -> Column:
    return F.length(F.coalesce(F.col(text), F.lit(""))).cast("bigint")


def word_count(text: str) -> Column:
    return F.size(split_words(F.coalesce(F.col(text), F.lit("")))).cast("bigint")


def value_counts(df: DataFrame, value: Column, *by: str) -> DataFrame:
    """``(*by, value, n)``: the distinct values of a measure with their frequency.

    Every statistic below reads this table, whose size is the number of different lengths, so
    exact quantiles need no sort of the rows.
    """
    return df.groupBy(*by, value.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def measure_table(df: DataFrame, text: str = "review", label: str = "sentiment") -> DataFrame:
    """``(measure, label, value, n)``: frequencies of the lengths in ``chars`` and in ``words``.

    Both come from one scan of the text, as two grouping sets that are combined on the map side.
    Every statistic of lengths is a roll-up of this table.
    """
    rows = df.select(F.col(f"`{label}`").alias(label), char_length(text).alias("chars"), word_count(text).alias("words"))
    sets = [[label, "chars"], [label, "words"]]
    counts = rows.groupingSets(sets, label, "chars", "words").agg(
        F.grouping("words").alias("without_words"), F.count(F.lit(1)).alias("n")
    )
    of_chars = F.col("without_words") == 1
    return counts.select(
        F.when(of_chars, "chars").otherwise("words").alias("measure"), label,
        F.when(of_chars, F.col("chars")).otherwise(F.col("words")).alias("value"), "n",
    )


def measured(measures: DataFrame, measure: str, *by: str) -> DataFrame:
    """The ``value_counts`` of one measure, over rows that have every column of ``by``."""
    rows = measures.where(F.col("measure") == measure)
    for name in by:
        rows = rows.where(F.col(f"`{name}`").isNotNull())
    return rows.groupBy(*by, "value").agg(F.sum("n").alias("n"))


def _merged_moments(entries: Column) -> Column:
    """``(n, mean, squares)`` of ``(n, value)`` entries: count, mean and squared deviations from it.

    The update for two parts moves the mean by the difference of their means and never subtracts
    sums of squares, so values far from zero keep their deviation.
    """
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("squares"))

    def merge(state: Column, entry: Column) -> Column:
        n, m = state["n"], entry["n"].cast("double")
        total, apart = n + m, entry["value"].cast("double") - state["mean"]
        return F.struct(
            total.alias("n"), (state["mean"] + apart * (m / total)).alias("mean"),
            (state["squares"] + apart * apart * (n * m / total)).alias("squares"),
        )

    return F.aggregate(F.sort_array(entries), start, merge)


def describe(counts: DataFrame, *by: str) -> DataFrame:
    """count, mean, sample deviation, minimum, quartiles and maximum of a frequency table."""
    n = F.col("n")
    # Distinct values with their numbers: as many as there are lengths, which the quartiles hold too.
    joined = counts.groupBy(*by).agg(
        F.sum("n").alias("count"), _merged_moments(F.collect_list(F.struct("n", "value"))).alias("moments"),
        F.min("value").alias("min"), F.percentile("value", list(QUARTILES), n).alias("q"), F.max("value").alias("max"),
    )
    std = F.sqrt(F.try_divide(F.col("moments.squares"), (F.col("count") - 1).cast("double")))
    columns = {
        "count": F.col("count").cast("double"), "mean": F.col("moments.mean"), "std": std,
        "min": F.col("min").cast("double"), "q25": F.col("q")[0], "q50": F.col("q")[1],
        "q75": F.col("q")[2], "max": F.col("max").cast("double"),
    }
    return joined.select(*by, *[round_half_up(columns[s], 2).alias(s) for s in STATS])


def char_length_stats(df: DataFrame, text: str = "review") -> DataFrame:
    return describe(value_counts(df, char_length(text)))


def word_count_stats(df: DataFrame, text: str = "review") -> DataFrame:
    return describe(value_counts(df, word_count(text)))


def classwise_word_stats(df: DataFrame, text: str = "review", label: str = "sentiment") -> DataFrame:
    labelled = df.where(F.col(label).isNotNull())
    return describe(value_counts(labelled, word_count(text), label), label)


def histogram(counts: DataFrame, bins: int = 50) -> DataFrame:
    """``(bin, bin_start, bin_end, n)``: equal-width bins from minimum to maximum, the last one
    closed; empty bins are listed. One value only gives one bin around it."""
    ends = counts.agg(F.min("value").cast("double").alias("low"), F.max("value").cast("double").alias("high"))
    width = F.col("high") - F.col("low")
    ends = ends.select(
        F.when(width == 0, F.col("low") - 0.5).otherwise(F.col("low")).alias("low"),
        F.when(width == 0, F.lit(1.0)).otherwise(width).alias("width"),
    )
    place = F.least(F.floor((F.col("value") - F.col("low")) / F.col("width") * bins), F.lit(bins - 1))
    filled = counts.crossJoin(F.broadcast(ends)).groupBy(place.alias("bin")).agg(F.sum("n").alias("n"))
    every = ends.select("low", "width", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(bins - 1).cast("bigint"))).alias("bin"))

    def edge(index: Column) -> Column:
        return round_half_up(F.col("low") + F.col("width") * index / bins, 6)

    return every.join(filled, "bin", "left").select(
        "bin",
        edge(F.col("bin")).alias("bin_start"),
        edge(F.col("bin") + 1).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def length_histogram(df: DataFrame, text: str = "review", bins: int = 50) -> DataFrame:
    return histogram(value_counts(df, char_length(text)), bins)


def word_histogram(df: DataFrame, text: str = "review", bins: int = 50) -> DataFrame:
    return histogram(value_counts(df, word_count(text)), bins)


def classwise_boxplot(df: DataFrame, text: str = "review", label: str = "sentiment") -> DataFrame:
    """Quartiles, whiskers (furthest values within 1.5 interquartile ranges) and outliers per label."""
    return boxplot(value_counts(df.where(F.col(label).isNotNull()), word_count(text), label), label)


def boxplot(counts: DataFrame, label: str = "sentiment") -> DataFrame:
    """``classwise_boxplot`` of a frequency table."""
    quartiles = counts.groupBy(label).agg(F.percentile("value", list(QUARTILES), F.col("n")).alias("q"))
    reach = (F.col("q")[2] - F.col("q")[0]) * 1.5
    inside = F.col("value").between(F.col("q")[0] - reach, F.col("q")[2] + reach)
    # The furthest value within reach, but never inside the box.
    low = F.least(F.min(F.when(inside, F.col("value"))), F.first("q")[0])
    high = F.greatest(F.max(F.when(inside, F.col("value"))), F.first("q")[2])
    outliers = F.sum(F.when(~inside, F.col("n")).otherwise(0))
    return counts.join(quartiles, label).groupBy(label).agg(
        *[F.first("q")[i].alias(name) for i, name in enumerate(("q25", "q50", "q75"))],
        low.cast("double").alias("whisker_low"),
        high.cast("double").alias("whisker_high"),
        outliers.alias("n_outliers"),
    )


def counted_tokens(df: DataFrame, text: str, out: str = "tokens") -> DataFrame:
    """Add the word tokens with stop words removed."""
    return df.withColumn(out, without_stopwords(word_tokens(F.col(text)), COUNTER_STOPWORDS))


def _most_frequent(terms: DataFrame, k: int) -> DataFrame:
    counts = terms.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "term").limit(k)


def top_words(df: DataFrame, text: str = "clean_review", k: int = 25) -> DataFrame:
    """``(term, n)``: the ``k`` most frequent words, equal counts alphabetically."""
    return _most_frequent(element_rows(counted_tokens(df, text), F.col("tokens"), "term"), k)


def top_ngrams(df: DataFrame, text: str = "clean_review", low: int = 2, high: int = 3, k: int = 20) -> DataFrame:
    """As ``top_words`` for n-grams over the words left after stop words are gone.

    N-grams are mostly rare, so only those that can be among the first are shuffled
    (``heavy_hitters``). The words are written once, as they are read for every summary and count.
    """
    tokens = stage(counted_tokens(df, text).select("tokens"), "tokens")
    return most_frequent(tokens, F.col("tokens"), k, low=low, high=high)


def class_term_freq(df: DataFrame, text: str = "clean_review", label: str = "sentiment", k: int = 150) -> DataFrame:
    """``(label, term, n, weight)``: each label's ``k`` most frequent words, weighted against its first.

    A label's terms are ranked in buckets first (``top_per_group``).
    """
    labelled = df.where(F.col(label).isNotNull())
    tokens = element_rows(counted_tokens(labelled, text), F.col("tokens"), "term", label)
    counts = tokens.groupBy(label, "term").agg(F.count(F.lit(1)).alias("n"))
    top = top_per_group(counts, [label], [F.desc("n"), F.col("term")], "term", k)
    weight = F.col("n") / F.max("n").over(W.partitionBy(label))
    return top.select(label, "term", "n", round_half_up(weight, 6).alias("weight"))


def split_inspection(df: DataFrame, label: str = "sentiment", split: str = "split") -> DataFrame:
    """``(split, label, n, n_split, share)``."""
    sizes = df.groupBy(split, label).agg(F.count(F.lit(1)).alias("n"))
    in_split = W.partitionBy(split)
    labelled = F.sum(F.when(F.col(label).isNotNull(), F.col("n"))).over(in_split)
    sized = sizes.withColumn("n_split", F.sum("n").over(in_split)).withColumn("labelled", labelled)
    share = round_half_up(F.col("n") / F.col("labelled"), 3)
    return sized.where(F.col(label).isNotNull()).select(split, label, "n", "n_split", share.alias("share"))
