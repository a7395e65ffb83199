"""Counts and vectors of term lists, a slice of an Arrow batch at a time.

Terms become numbers once a slice, and whatever is counted is counted on the numbers. A slice holds
a bounded number of terms (a single longer list is a slice of its own), so a worker needs memory for
a batch and a slice, whatever the size of the table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, functions as F

from opinara.config import FeatureConfig
from opinara.functions.rows import SLICE_TERMS, slices
from opinara.functions.tokens import CHAR_NGRAM_RANGE, SLICE_WORDS, placed_windows

#: A table of all pairs of a slice's rows and terms is counted in place up to so many cells a term.
CELLS_PER_TERM = 16


def row_counts(rows: np.ndarray, codes: np.ndarray, n_rows: int, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs of a row and a code that occur, in order, and how often each does."""
    keys = rows * n_codes + codes
    if n_rows * n_codes <= CELLS_PER_TERM * len(keys):
        cells = np.bincount(keys, minlength=n_rows * n_codes)
        found = np.flatnonzero(cells)
        times = cells[found]
    else:
        found, times = np.unique(keys, return_counts=True)
    return found // max(1, n_codes), found % max(1, n_codes), times


Coder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray, pa.Array]]


def _coded(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """Of every element its row and its number, and the different elements by number."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    rows = np.repeat(np.arange(len(lists), dtype=np.int64), lengths)
    coded = lists.flatten().dictionary_encode(null_encoding="encode")
    return rows, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary.cast(pa.string())


def _coded_ngrams(low: int, high: int) -> Coder:
    """As ``_coded`` for runs of ``low`` to ``high`` neighbouring tokens; each different run is
    written once."""

    def code(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        rows, tokens, words = _coded(lists)
        grams, texts, begin = tokens, words, rows
        parts = [(begin, grams, texts)] if low == 1 else []
        for size in range(2, high + 1):
            # A run goes on where the token after it is of the same row.
            n = max(0, len(tokens) - size + 1)
            on = np.flatnonzero(rows[:n] == rows[size - 1 :])
            whole = np.full(len(tokens), -1, np.int64)
            whole[np.flatnonzero(rows[: len(tokens) - size + 2] == rows[size - 2 :])] = grams
            grams, pairs = pd.factorize(whole[on] * max(1, len(words)) + tokens[on + size - 1])
            head, tail = pairs // max(1, len(words)), pairs % max(1, len(words))
            texts = pc.binary_join_element_wise(texts.take(pa.array(head)), words.take(pa.array(tail)), " ")
            if size >= low:
                parts.append((rows[on], grams, texts))
        shift = np.cumsum([0] + [len(texts) for _, _, texts in parts])
        return (
            np.concatenate([rows for rows, _, _ in parts]),
            np.concatenate([codes + by for (_, codes, _), by in zip(parts, shift)]).astype(np.int64),
            pa.concat_arrays([texts for _, _, texts in parts]),
        )

    return code


def _coded_windows(low: int, high: int) -> Coder:
    """As ``_coded`` for the character n-grams of words."""

    def code(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        known, places, of_word = placed_windows(lists.flatten(), low, high)
        rows = np.repeat(np.repeat(np.arange(len(lists), dtype=np.int64), lengths), of_word)
        coded = known.dictionary_encode()
        return rows, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)[places], coded.dictionary

    return code


def _coder(config: FeatureConfig | None) -> tuple[Coder, int]:
    """What makes terms of the tokens of ``config`` (terms as they are without), and the tokens of a slice."""
    if config is None:
        return _coded, SLICE_TERMS
    if config.strategy == "tfidf_char":
        return _coded_windows(*CHAR_NGRAM_RANGE), SLICE_WORDS
    return (_coded if tuple(config.ngram_range) == (1, 1) else _coded_ngrams(*config.ngram_range)), SLICE_TERMS


def counted_terms(config: FeatureConfig | None = None):
    """``(term, df, cf)``, a row per term of a slice: of one column of term lists, or of the tokens
    of ``config``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, most = _coder(config)
        for batch in batches:
            for part in slices(batch.column(0), most):
                rows, codes, terms = code(part)
                if not len(codes):
                    continue
                _, met, times = row_counts(rows, codes, len(part), len(terms))
                df = np.bincount(met, minlength=len(terms))
                cf = np.bincount(met, weights=times, minlength=len(terms)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([terms, pa.array(df), pa.array(cf)], ["term", "df", "cf"])

    return run


def _vector_batch(lists: pa.Array, code: Coder, known: pa.Array, idf: np.ndarray, counts_only: bool, sublinear: bool) -> pa.Array:
    rows, codes, terms = code(lists)
    # Only the different terms are looked up.
    place = pc.fill_null(pc.index_in(terms, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)[codes]
    hit = place >= 0
    row, term, times = row_counts(rows[hit], place[hit], len(lists), len(known))
    weights = times.astype(np.float64)
    if not counts_only:
        if sublinear:
            weights = 1.0 + np.log(weights)
        weights = weights * idf[term]
        norms = np.sqrt(np.bincount(row, weights=weights * weights, minlength=len(lists)))
        weights = np.divide(weights, norms[row], out=weights, where=norms[row] > 0)
    ends = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=len(lists)))]).astype(np.int32)
    columns = {
        "type": pa.array(np.zeros(len(lists), np.int8)),
        "size": pa.array(np.full(len(lists), len(known), np.int32)),
        "indices": pa.ListArray.from_arrays(pa.array(ends), pa.array(term.astype(np.int32))),
        "values": pa.ListArray.from_arrays(pa.array(ends), pa.array(weights)),
    }
    return pa.StructArray.from_arrays(list(columns.values()), list(columns))


def vectors(config: FeatureConfig, vocabulary: tuple[str, ...], idf: tuple[float, ...]) -> Callable[[Column], Column]:
    """Token lists to sparse vectors over ``vocabulary``: counts, or unit vectors of counts, damped if
    so configured, times ``idf``. A list without known terms, or none, becomes an empty vector."""

    @F.arrow_udf(returnType=VectorUDT())
    def vector(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        known, factors = pa.array(vocabulary, pa.string()), np.array(idf)
        code, most = _coder(config)
        for lists in batches:
            for part in slices(lists, most):
                yield _vector_batch(part, code, known, factors, config.strategy == "count", config.sublinear_tf)

    return vector
