"""The most frequent terms without shuffling every distinct one.

First a summary: every task keeps a fixed number of counters over the hashes of its terms
(Misra-Gries); with more hashes than counters, the largest count that has to go is taken off all.
Summaries are added and cut again the same way, in a tree, and what was ever taken off is summed up,
so every hash's true count is between its counter and its counter plus that sum; one without a
counter has at most the sum. Then the terms that have a counter are counted exactly. If the k-th of
these counts is above the sum, no other term can be among the first k, whatever its name. If it is
not, more counters are tried, and in the end all terms are counted.

Runs of neighbouring elements are hashed and found as numbers, a slice of an Arrow batch at a time;
only those that are counted are written out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from opinara.functions.rows import element_rows, slices
from opinara.functions.tokens import word_ngrams

#: Counters of a summary, and the most that are tried before all terms are counted.
COUNTERS = 16_384
MOST_COUNTERS = 262_144
#: Summaries that meet in one task.
FAN_IN = 32

_SUMMARY = "part int, taken long, hashes array<long>, counts array<long>"


def reduced(hashes: np.ndarray, counts: np.ndarray, counters: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Counts by hash, at most ``counters`` of them, and what was taken off each to get there."""
    if not len(hashes):
        return hashes, counts, 0
    order = np.argsort(hashes)
    hashes = hashes[order]
    starts = np.flatnonzero(np.concatenate([[True], hashes[1:] != hashes[:-1]]))
    found, totals = hashes[starts], np.add.reduceat(counts[order], starts)
    if len(found) <= counters:
        return found, totals, 0
    taken = int(np.partition(totals, -counters - 1)[-counters - 1])
    left = totals > taken
    return found[left], totals[left] - taken, taken


def _summary(part: int, taken: int, hashes: np.ndarray, counts: np.ndarray) -> dict:
    return {
        "part": pa.array([part], pa.int32()), "taken": pa.array([taken], pa.int64()),
        "hashes": pa.array([hashes], pa.list_(pa.int64())), "counts": pa.array([counts], pa.list_(pa.int64())),
    }


def run_hashes(lists: pa.Array, low: int, high: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of each size from ``low`` to ``high`` where runs of so many elements begin, and their hashes,
    made of the hashes in ``lists``."""
    lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    single = lists.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    # How many elements of its row come after each one.
    after = np.repeat(np.cumsum(lengths), lengths) - np.arange(len(single)) - 1
    places, hashes, made = np.arange(len(single)), single, []
    for size in range(1, high + 1):
        if size > 1:
            on = after[places] >= size - 1
            places = places[on]
            hashes = hashes[on] * np.uint64(0x9E3779B97F4A7C15) + single[places + (size - 1)]
            hashes ^= hashes >> np.uint64(29)
        if size >= low:
            made.append((places, hashes.view(np.int64)))
    return made


def _of_task(counters: int, low: int, high: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        hashes = counts = np.empty(0, np.int64)
        taken = 0
        for batch in batches:
            for part in slices(batch.column(0)):
                found = np.concatenate([h for _, h in run_hashes(part, low, high)])
                new, times = np.unique(found, return_counts=True)
                hashes, counts, off = reduced(np.concatenate([hashes, new]), np.concatenate([counts, times]), counters)
                taken += off
        if len(hashes) or taken:
            made = _summary(TaskContext.get().partitionId(), taken, hashes, counts)
            yield pa.RecordBatch.from_pydict(made)

    return run


def _counted_runs(hashes: list[int], low: int, high: int):
    """``(term, n)`` of a slice's runs with one of ``hashes``."""
    known = np.sort(np.array(hashes, np.int64))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not len(known):
            return
        for batch in batches:
            start = 0
            for part in slices(batch.column(0)):
                elements = batch.column(1).slice(start, len(part)).flatten()
                start += len(part)
                for size, (places, found) in enumerate(run_hashes(part, low, high), low):
                    hit = places[known[np.minimum(np.searchsorted(known, found), len(known) - 1)] == found]
                    words = [elements.take(pa.array(hit + i)).cast(pa.string()) for i in range(size)]
                    # A run with a null in it is null, and counts for nothing.
                    runs = pc.binary_join_element_wise(*words, " ") if size > 1 else words[0]
                    counts = runs.drop_null().value_counts()
                    yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], ["term", "n"])

    return run


def _added(counters: int):
    def run(summaries: pa.Table) -> pa.Table:
        hashes = counts = np.empty(0, np.int64)
        taken = 0
        for at in range(len(summaries)):
            joined = [
                np.concatenate([a, summaries[c][at].values.to_numpy(zero_copy_only=False)])
                for a, c in ((hashes, "hashes"), (counts, "counts"))
            ]
            hashes, counts, off = reduced(*joined, counters)
            taken += off + summaries["taken"][at].as_py()
        return pa.table(_summary(summaries["part"][0].as_py(), taken, hashes, counts))

    return run


def _hashed(terms: Column) -> Column:
    return F.transform(terms, lambda t: F.xxhash64(t)).alias("hashes")


def summary(
    rows: DataFrame, terms: Column, counters: int = COUNTERS, low: int = 1, high: int = 1
) -> tuple[list[int], int]:
    """Hashes that have a counter, and the most that any other hash can count."""
    level = rows.select(_hashed(terms)).mapInArrow(_of_task(counters, low, high), _SUMMARY)
    for group in (F.floor(F.col("part") / FAN_IN), F.lit(0)):
        level = level.withColumn("part", group.cast("int")).groupBy("part").applyInArrow(_added(counters), _SUMMARY)
    found = level.select("hashes", "taken").first()
    return (list(found.hashes), found.taken) if found else ([], 0)


def most_frequent(
    rows: DataFrame, terms: Column, k: int, counters: int = COUNTERS, most: int = MOST_COUNTERS,
    low: int = 1, high: int = 1,
) -> DataFrame:
    """``(term, n)``: the ``k`` most frequent elements of an array column, equal counts by name; or of
    its runs of ``low`` to ``high`` neighbouring elements, joined by spaces.

    Exact. Null arrays and elements count for nothing; with fewer than ``k`` terms, all are given.
    ``rows`` is read twice or more and should be a written table.
    """
    while counters <= most:
        hashes, bound = summary(rows, terms, counters, low, high)
        found = rows.select(_hashed(terms), terms.alias("terms")).mapInArrow(_counted_runs(hashes, low, high), "term string, n long")
        first = _first(found.groupBy("term").agg(F.sum("n").alias("n")), k)
        schema, first = first.schema, first.collect()
        # Without a bound every hash has a counter.
        if bound == 0 or (len(first) == k and first[-1].n > bound):
            return rows.sparkSession.createDataFrame(first, schema)
        counters *= 4
    every = element_rows(rows, terms if high == 1 else word_ngrams(terms, low, high), "term")
    return _first(every.groupBy("term").agg(F.count(F.lit(1)).alias("n")), k)


def _first(counts: DataFrame, k: int) -> DataFrame:
    return counts.orderBy(F.desc("n"), "term").limit(k)
