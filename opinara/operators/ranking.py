"""The first rows of every group, whatever the size of a group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F


def top_per_group(
    rows: DataFrame, by: Sequence[str], order: Sequence[Column], salt: str, k: int, buckets: int = 64
) -> DataFrame:
    """The ``k`` first rows of each group by ``order``, which has to be unique within it.

    A group is dealt into buckets by ``salt``; each bucket is ranked on its own and lets ``k`` rows
    on, so the task that ranks a group sees ``buckets * k`` rows at most, for any ``k``, and a group
    that is most of the table is sorted in pieces.
    """
    place, bucket = "__place", "__bucket"
    dealt = rows.withColumn(bucket, F.pmod(F.xxhash64(salt), F.lit(buckets)))
    for keys in ([*by, bucket], list(by)):
        ranks = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
        dealt = dealt.withColumn(place, ranks).where(F.col(place) <= k).drop(place)
    return dealt.drop(bucket)
