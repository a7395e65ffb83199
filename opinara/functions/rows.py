"""Arrays to rows, and arrays of an Arrow batch."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

#: Elements of a slice.
SLICE_TERMS = 1 << 19


def element_rows(df: DataFrame, array: Column, name: str, *keep: str | Column) -> DataFrame:
    """``(*keep, name)``: one row per element.

    For a plain explode the optimizer adds a filter on the array's size and moves it down to the
    scan, which evaluates the expression that builds the array two more times. An outer explode
    with the filter behind it does not.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def struct_rows(df: DataFrame, array: Column, *keep: str | Column, required: str) -> DataFrame:
    """As ``element_rows`` for an array of structs, a column per field; ``required`` is never null."""
    return df.select(*keep, F.inline_outer(array)).where(F.col(required).isNotNull())


def slices(lists: pa.Array, most: int = SLICE_TERMS) -> Iterator[pa.Array]:
    """``lists`` in runs of rows of about ``most`` elements."""
    ends = np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start, before = 0, 0
    while start < len(lists):
        stop = max(start + 1, int(np.searchsorted(ends, before + most, "right")))
        yield lists.slice(start, stop - start)
        start, before = stop, int(ends[stop - 1])
