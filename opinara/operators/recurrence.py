"""Which terms are met in two documents, before any term is shuffled.

A corpus has far more terms than a vocabulary, and most are met once. Every task counts the hashes
of its documents' distinct terms in one table of cells, up to two; tables are merged by adding, in
a tree of groups. A term of two documents has a cell that counts two, whatever else fell into it,
so terms whose cell counts less can go where they stand: their counts were never needed. What
remains is counted exactly as before.

The cells that count two are a bitmap of a fixed size, which travels as a constant of the plan and
is probed in the row.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

#: Cells: two to this power (6 at least). The bitmap takes an eighth of it in bytes, a task's table all of it.
CELL_BITS = 24
#: Cells of a segment, the unit of merging, and tables of the first level of the tree.
SEGMENT_BITS = 18
FAN_IN = 64
#: Beyond this share of full cells the bitmap lets too much through to be worth a pass.
USEFUL = 0.6

_SEGMENTS = "part int, segment int, once binary, twice binary"


def _cell(term: Column, bits: int) -> Column:
    return F.xxhash64(term).bitwiseAND((1 << bits) - 1)


def _counted(bits: int, segment_bits: int):
    """A task's table, as bitmaps of the cells met once and of those met twice or more."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        counts = np.zeros(1 << bits, np.uint8)
        met = False
        for batch in batches:
            cells = pa.chunked_array([batch.column(0)]).combine_chunks().flatten().to_numpy(zero_copy_only=False)
            if len(cells):
                met = True
                found, times = np.unique(cells, return_counts=True)
                counts[found] = np.minimum(2, counts[found] + np.minimum(times, 2).astype(np.uint8))
        if not met:
            return
        part = TaskContext.get().partitionId()
        for number, cells in enumerate(counts.reshape(-1, 1 << segment_bits)):
            if cells.any():
                columns = [[part], [number], [np.packbits(cells > 0).tobytes()], [np.packbits(cells > 1).tobytes()]]
                types = (pa.int32(), pa.int32(), pa.binary(), pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], ["part", "segment", "once", "twice"])

    return run


def _merged(batches: pa.Table) -> pa.Table:
    """Tables of a segment added up: twice in one of them, or once in two."""
    once = twice = None
    for a, b in zip(batches["once"], batches["twice"]):
        a, b = np.frombuffer(a.as_buffer(), np.uint8), np.frombuffer(b.as_buffer(), np.uint8)
        twice = b if once is None else twice | b | (once & a)
        once = a if once is None else once | a
    first = batches.slice(0, 1)
    return pa.table(
        {
            "part": pa.array([first["part"][0].as_py()], pa.int32()), "segment": pa.array([first["segment"][0].as_py()], pa.int32()),
            "once": pa.array([once.tobytes()], pa.binary()), "twice": pa.array([twice.tobytes()], pa.binary()),
        }
    )


def recurring(docs: DataFrame, terms: str = "terms", bits: int = CELL_BITS) -> np.ndarray:
    """The cells that distinct terms of two documents, or two terms, fell into, as 64-bit words.

    The one thing that comes to the driver: ``2 ** bits`` bits.
    """
    segment_bits = min(bits, SEGMENT_BITS)
    hashed = docs.select(F.transform(F.array_distinct(terms), lambda t: _cell(t, bits)).alias("cells"))
    level = hashed.mapInArrow(_counted(bits, segment_bits), _SEGMENTS)
    for group in (F.floor(F.col("part") / FAN_IN), F.lit(0)):
        level = level.withColumn("part", group.cast("int")).groupBy("part", "segment").applyInArrow(_merged, _SEGMENTS)
    full = np.zeros((1 << (bits - segment_bits), (1 << segment_bits) // 8), np.uint8)
    for row in level.select("segment", "twice").collect():
        full[row.segment] = np.frombuffer(row.twice, np.uint8)
    # packbits puts a byte's first cell into its highest bit, words count from the lowest.
    flags = np.unpackbits(full.reshape(-1))
    return np.packbits(flags, bitorder="little").view("<i8")


def without_single_terms(docs: DataFrame, terms: str = "terms", bits: int = CELL_BITS) -> DataFrame:
    """``docs`` without terms that no second document can have; all others keep every occurrence.

    Terms of one document stay where they share a cell, so this decides nothing: it spares a
    count by term most of its rows. Null lists stay null. A corpus with so many terms that most
    cells are full is returned as it is.
    """
    words = recurring(docs, terms, bits)
    full = np.bitwise_count(words.view(np.uint64)).sum() / (1 << bits)
    if full > USEFUL:
        return docs
    table = F.from_json(F.lit(json.dumps(words.tolist())), "array<bigint>")

    def met_again(term: Column) -> Column:
        cell = _cell(term, bits)
        return F.getbit(F.get(table, F.shiftright(cell, 6).cast("int")), cell.bitwiseAND(63).cast("int")) == 1

    return docs.withColumn(terms, F.filter(terms, met_again))
