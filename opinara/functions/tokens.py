"""Tokens and n-grams as array Columns."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

from opinara.config import FeatureConfig
from opinara.functions.rows import slices
from opinara.functions.text import WORD_CLASS, split_words

TOKEN_PATTERN = rf"[a-z{WORD_CLASS}]{{2,}}"

#: Sizes of the character n-grams.
CHAR_NGRAM_RANGE = (3, 5)

#: Words whose character n-grams are made at a time.
SLICE_WORDS = 1 << 17


def word_tokens(text: Column) -> Column:
    """Lower-cased runs of two or more word characters."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN_PATTERN), F.lit(0))


def _shingles(tokens: Column, size: int) -> Column:
    """All runs of ``size`` neighbouring tokens.

    Whole shifted arrays are zipped together, so no lambda looks up another row's column and the
    token expression is evaluated once.
    """
    count = F.greatest(F.size(tokens) - (size - 1), F.lit(0))
    grams = F.slice(tokens, F.lit(1), count)
    for offset in range(1, size):
        grams = F.zip_with(
            grams,
            F.slice(tokens, F.lit(offset + 1), count),
            lambda left, right: F.concat(left, F.lit(" "), right),
        )
    return grams


def word_ngrams(tokens: Column, low: int, high: int) -> Column:
    parts = [tokens if size == 1 else _shingles(tokens, size) for size in range(low, high + 1)]
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def _windows(words: pa.Array, low: int, high: int) -> tuple[pa.Array, np.ndarray]:
    """The windows of padded words, word by word, short ones first; and how many each word has.

    All words lie in one run of bytes, in which a window is a stretch between two characters.
    """
    padded = pc.binary_join_element_wise("", words, "", " ")
    chars = pc.utf8_length(padded).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.frombuffer("".join(padded.to_pylist()).encode(), np.uint8)
    # Where each character begins, and where the last one ends.
    begin = np.append(np.flatnonzero((text & 0xC0) != 0x80), len(text))
    first = np.cumsum(chars) - chars
    of_size = [np.maximum(0, chars - size + 1) for size in range(low, high + 1)]
    per_word = np.sum(of_size, axis=0)
    place = np.cumsum(per_word) - per_word
    starts, ends = np.empty((2, int(per_word.sum())), np.int64)
    for size, n in zip(range(low, high + 1), of_size):
        step = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
        at, char = np.repeat(place, n) + step, np.repeat(first, n) + step
        starts[at], ends[at] = begin[char], begin[char + size]
        place = place + n
    lengths = ends - starts
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    data = text[np.repeat(starts - offsets[:-1], lengths) + np.arange(offsets[-1])]
    buffers = [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(data)]
    return pa.Array.from_buffers(pa.string(), len(lengths), buffers), per_word


def placed_windows(words: pa.Array, low: int, high: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Windows of the different words, the place there of every word's windows, and how many each has."""
    coded = words.dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False)
    known, sizes = _windows(coded.dictionary.cast(pa.string()), low, high)
    of_word = sizes[codes]
    # Each word's place in the list of windows, counted on for as many windows as it has.
    ends = np.cumsum(of_word)
    places = np.repeat((np.cumsum(sizes) - sizes)[codes] - (ends - of_word), of_word) + np.arange(of_word.sum())
    return known, places, of_word


def _word_windows(lists: pa.Array, low: int, high: int) -> pa.Array:
    """The windows of a batch's words."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    known, places, of_word = placed_windows(lists.flatten(), low, high)
    ends = np.concatenate([[0], np.cumsum(of_word)])
    offsets = ends[np.concatenate([[0], np.cumsum(lengths)])].astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), known.take(pa.array(places)), mask=lists.is_null())


def char_wb_ngrams(text: Column, low: int = 3, high: int = 5) -> Column:
    """Character n-grams of every word padded with one space on each side.

    A word shorter than the n-gram appears once, whole. ``low`` is at most 3, the length of the
    shortest padded word.
    """

    return _char_windows(char_words(text), low, high)


def char_words(text: Column) -> Column:
    """The words that character n-grams are cut from."""
    return split_words(F.lower(text))


def _char_windows(words: Column, low: int, high: int) -> Column:
    @F.arrow_udf(returnType="array<string>")
    def windows(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for lists in batches:
            for part in slices(lists, SLICE_WORDS):
                yield _word_windows(part, low, high)

    return windows(words)


def without_stopwords(tokens: Column, stopwords) -> Column:
    return F.filter(tokens, lambda token: ~token.isin(list(stopwords)))


def _word_analyzer(config: FeatureConfig):
    low, high = config.ngram_range
    return None if (low, high) == (1, 1) else lambda tokens: word_ngrams(tokens, low, high)


#: Strategy name -> (tokenizer over text, terms over its result or None if tokens are the terms)
ANALYZERS = {
    "tfidf": (word_tokens, _word_analyzer),
    "count": (word_tokens, _word_analyzer),
    "tfidf_char": (char_words, lambda config: lambda words: _char_windows(words, *CHAR_NGRAM_RANGE)),
}


def _analyzer(config: FeatureConfig):
    if config.strategy not in ANALYZERS:
        raise ValueError(
            f"Unknown feature strategy {config.strategy!r}; choose one of {sorted(ANALYZERS)}"
        )
    return ANALYZERS[config.strategy]


def with_tokens(df, text: str, config: FeatureConfig, out: str = "tokens"):
    """Add the array of tokens that the configured strategy makes terms of."""
    return df.withColumn(out, _analyzer(config)[0](F.col(text)))


def terms_of_tokens(df, tokens: str, config: FeatureConfig):
    """Put the terms in place of the tokens."""
    terms = _analyzer(config)[1](config)
    return df if terms is None else df.withColumn(tokens, terms(F.col(tokens)))


def with_terms(df, text: str, config: FeatureConfig, out: str = "terms"):
    """Add the array of terms the configured strategy counts.

    Tokens get a column of their own: several n-gram sizes read it, and the optimizer keeps a
    costly expression that is read more than once in its own projection.
    """
    return terms_of_tokens(with_tokens(df, text, config, out), out, config)
