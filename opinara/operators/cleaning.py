"""Cleaning a table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from opinara.config import CleaningConfig
from opinara.functions.text import clean_expr, wants_lemmas
from opinara.functions.wordlists import CLEANER_STOPWORDS
from opinara.operators.lemmas import lemma_table, lemmatize, lemmatize_in_place, numbered, recurring_forms, row_frequencies


class LexiconTooLarge(ValueError):
    """The lexicon does not fit a projection; clean bounded batches instead."""


def clean_table(
    df: DataFrame,
    config: CleaningConfig,
    text_column: str = "review",
    output_column: str = "clean_review",
    lexicon: DataFrame | None = None,
    exceptions: DataFrame | None = None,
) -> DataFrame:
    """Add the cleaned text.

    With lemmas on, ``lexicon(form)`` lists known forms; without one, the terms found in two or
    more rows of the cleaned table are used. Rows need no id; repeated and null ids are kept.
    A stream needs a lexicon, which travels to its rows and decides every word in place.
    """
    if wants_lemmas(config) and not df.isStreaming:
        return lemmas_of_words(cleaned_words(df, config, text_column, output_column), output_column, lexicon, exceptions)
    df = df.withColumn(output_column, clean_expr(F.col(text_column).cast("string"), config))
    if wants_lemmas(config):
        if lexicon is None or exceptions is not None:
            raise ValueError("a stream takes its lemmas from a lexicon alone")
        lemmas_in_place = lemmatize_in_place(df, output_column, lexicon)
        if lemmas_in_place is None:
            raise LexiconTooLarge("the lexicon is too large for a stream's rows")
        return lemmas_in_place
    return df


def cleaned_words(df: DataFrame, config: CleaningConfig, text_column: str, output_column: str) -> DataFrame:
    """The rows with the text cleaned up to the lemma step, written once, as ``lemmas_of_words`` takes them."""
    return numbered(df.withColumn(output_column, clean_expr(F.col(text_column).cast("string"), config)), "words")


def lemmas_of_words(
    rows: DataFrame, column: str, lexicon: DataFrame | None = None, exceptions: DataFrame | None = None
) -> DataFrame:
    """The lemma step of ``clean_table`` over ``cleaned_words``.

    One pass counts the rows of every word, of which the lexicon (unless given) and the terms that may
    change are parts; another one puts lemmas in place.
    """
    by_rule = exceptions is None
    terms = row_frequencies(rows, column, by_rule and lexicon is not None)
    if lexicon is None:
        lexicon = recurring_forms(terms)
    return lemmatize(rows, column, lemma_table(terms, lexicon, exceptions), by_rule, joined=True)


def empty_after_clean(df: DataFrame, column: str = "clean_review") -> DataFrame:
    blank = F.count_if(F.trim(F.col(column)) == "")
    return df.agg(F.count(F.lit(1)).alias("n_rows"), blank.alias("n_empty"))


def stopword_antijoin(words: DataFrame, stopwords=CLEANER_STOPWORDS) -> DataFrame:
    """Rows of a long table whose ``term`` is not on the list."""
    stop = words.sparkSession.createDataFrame([(w,) for w in stopwords], "term string")
    return words.join(F.broadcast(stop), "term", "left_anti")
