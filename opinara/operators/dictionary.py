"""Dictionaries probed inside a row.

A dictionary within a size bound becomes one array of small maps, a word's map at the place that
its hash gives. The array is a constant of the plan, which every task gets once, so a row looks a
word up in constant time, in the JVM, inside any expression, and nothing of the row is exchanged or
copied. Streams can use it like tables.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

#: Entries, and characters of them, that may travel to every task.
MOST_ENTRIES = 100_000
MOST_CHARS = 4_000_000
#: Entries of a small map, on average.
PER_MAP = 2

Lookup = Callable[[Column], Column]


def fits(entries: DataFrame, key: str, value: str, most: int = MOST_ENTRIES, chars: int = MOST_CHARS) -> bool:
    """Whether a table of entries is within the bound; reads no further than one entry beyond it."""
    size = entries.limit(most + 1).agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.char_length(key) + F.char_length(value)), F.lit(0)).alias("chars")
    ).first()
    return size.n <= most and size.chars <= chars


def dictionary(entries: DataFrame, key: str, value: str, most: int = MOST_ENTRIES, chars: int = MOST_CHARS) -> Lookup | None:
    """``word -> value, or null`` for a table of unique keys; None if it is beyond the bound.

    Keys are never null. ``entries`` is read twice and should be a written table.
    """
    if not fits(entries, key, value, most, chars):
        return None
    rows = entries.select(key, value, F.xxhash64(key)).collect()
    kind = dict(entries.dtypes)[value]
    if not rows:
        return lambda word: F.lit(None).cast(kind)
    places = max(1, len(rows) // PER_MAP)
    maps: list[dict] = [{} for _ in range(places)]
    for k, v, code in rows:
        maps[code % places][k] = v
    # The optimizer folds this into a constant; as text it crosses to the JVM in one piece.
    table = F.from_json(F.lit(json.dumps(maps)), f"array<map<string,{kind}>>")

    def lookup(word: Column) -> Column:
        return F.try_element_at(F.get(table, F.pmod(F.xxhash64(word), F.lit(places)).cast("int")), word)

    return lookup
