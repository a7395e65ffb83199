"""Exact deduplication against a minimal perfect hash of the digests seen before.

The distinct digests of the history are dealt into shards of a bounded size by their hash. A shard
is a minimal perfect hash: levels of bitmaps in which a digest owns the bit that no other digest of
its level hits, the rest going on to the next level; the rank of its bit is its slot. A slot holds
the whole digest, the row that stays (the winner) and the number of copies. A lookup computes the
slot and compares the bytes of the digest, so a digest that was never seen is never taken for one
that was. Digests outside the history are grouped among themselves.

Copies are aggregated before they are shuffled, so a text that makes up a third of the table is one
row per task, and shards are even because digests are.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.llm.common import KEY, digest, documents, with_key, without_key
from opinara.staging import stage

#: Digests of a shard, on average.
SHARD_DIGESTS = 16_384
#: Bits of a level per digest that it is offered.
GAMMA = 2

_SEEDS = np.random.default_rng(20).integers(1, 2**63, size=(64, 4), dtype=np.uint64) | np.uint64(1)

INDEX_SCHEMA = "shard long, sizes array<long>, bits binary, digests binary, winners array<long>, winner_ids array<long>, copies array<long>"
GROUP_SCHEMA = "digest binary, keep_key long, keep_id long, group_size long, seen boolean"


def _words(digests: np.ndarray) -> np.ndarray:
    """``n`` digests of 32 bytes as an ``n x 4`` table of unsigned numbers."""
    return np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 4)


def _hash(words: np.ndarray, level: int, size: int) -> np.ndarray:
    mixed = (words * _SEEDS[level % len(_SEEDS)]).sum(axis=1, dtype=np.uint64) + np.uint64(level)
    mixed ^= mixed >> np.uint64(32)
    return (mixed % np.uint64(size)).astype(np.int64)


def build_levels(words: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels, and the bits of all levels one after another."""
    sizes, levels, rest, level = [], [], words, 0
    while len(rest):
        size = GAMMA * len(rest) + 1
        at = _hash(rest, level, size)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        levels.append(alone)
        rest = rest[~alone[at]]
        level += 1
    return sizes, np.concatenate(levels) if levels else np.zeros(0, bool)


def find_slots(words: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of every digest; -1 where no level has it, which shows that it is no member."""
    ranks = np.cumsum(bits) - 1
    slots = np.full(len(words), -1, dtype=np.int64)
    open_rows, start = np.arange(len(words)), 0
    for level, size in enumerate(sizes):
        at = _hash(words[open_rows], level, size) + start
        hit = bits[at]
        slots[open_rows[hit]] = ranks[at[hit]]
        open_rows = open_rows[~hit]
        start += size
    return slots


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    words = _words(rows["digest"].to_numpy())
    sizes, bits = build_levels(words)
    order = np.empty(len(rows), dtype=np.int64)
    order[find_slots(words, sizes, bits)] = np.arange(len(rows))
    column = lambda name: rows[name].astype("Int64").iloc[order].tolist()
    plain = lambda name: [None if v is pd.NA else v for v in column(name)]
    return pd.DataFrame(
        {
            "shard": [key[0]],
            "sizes": [sizes],
            "bits": [np.packbits(bits).tobytes()],
            "digests": [words[order].tobytes()],
            "winners": [plain("winner")],
            "winner_ids": [plain("winner_id")],
            "copies": [plain("copies")],
        }
    )


def _look_up(key: tuple, rows: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
    """Every group of the shard, its history and its new rows taken together."""
    if shard.empty:
        keep = rows.rename(columns={"winner": "keep_key", "winner_id": "keep_id", "copies": "group_size"})
        return keep.assign(seen=False)[["digest", "keep_key", "keep_id", "group_size", "seen"]]
    index = shard.iloc[0]
    sizes = [int(s) for s in index["sizes"]]
    bits = np.unpackbits(np.frombuffer(index["bits"], np.uint8), count=sum(sizes)).astype(bool)
    slots_words = np.frombuffer(index["digests"], "<u8").reshape(-1, 4)
    winners = np.array(index["winners"], dtype=np.int64)
    ids = pd.array(list(index["winner_ids"]), dtype="Int64")
    copies = np.array(index["copies"], dtype=np.int64)
    seen = np.zeros(len(winners), bool)
    fresh = rows.iloc[:0]
    if len(rows):
        words = _words(rows["digest"].to_numpy())
        slots = find_slots(words, sizes, bits)
        member = slots >= 0
        member[member] = (slots_words[slots[member]] == words[member]).all(axis=1)
        at, hits = slots[member], rows[member]
        later = hits["winner"].to_numpy() > winners[at]
        winners[at[later]] = hits["winner"].to_numpy()[later]
        ids[at[later]] = hits["winner_id"].astype("Int64").array[later]
        copies[at] += hits["copies"].to_numpy()
        seen[at] = True
        fresh = rows[~member]
    data = slots_words.tobytes()
    known = pd.DataFrame(
        {
            "digest": [data[i : i + 32] for i in range(0, len(data), 32)],
            "keep_key": winners,
            "keep_id": ids,
            "group_size": copies,
            "seen": seen,
        }
    )
    return pd.concat([known, _look_up(key, fresh, shard.iloc[:0])]) if len(fresh) else known


def distinct_digests(rows: DataFrame) -> DataFrame:
    """``(digest, winner, winner_id, copies)`` of ``(digest, __key, doc_id)``; the largest key wins."""
    best = F.max(F.struct(KEY, "doc_id"))
    return rows.groupBy("digest").agg(best.alias("best"), F.count("*").alias("copies")).select(
        "digest", F.col(f"best.{KEY}").alias("winner"), F.col("best.doc_id").alias("winner_id"), "copies"
    )


def _sharded(rows: DataFrame, shards: int) -> DataFrame:
    return rows.withColumn("shard", F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("long"))


def build_index(history: DataFrame, shards: int) -> DataFrame:
    """A minimal perfect hash per shard over the distinct digests of ``history``, written once."""
    known = _sharded(distinct_digests(history), shards)
    return stage(known.groupBy("shard").applyInPandas(_build_shard, INDEX_SCHEMA), "digest-index")


def groups(index: DataFrame, arrivals: DataFrame, shards: int) -> DataFrame:
    """``(digest, keep_key, keep_id, group_size, seen)``: every distinct text of history and arrivals.

    ``seen`` is true where an arrival was found in the index.
    """
    new = _sharded(distinct_digests(arrivals), shards)
    return new.groupBy("shard").cogroup(index.groupBy("shard")).applyInPandas(_look_up, GROUP_SCHEMA)


def exact_dedup(docs: DataFrame, is_history: F.Column | None = None) -> DataFrame:
    """A row per row of ``docs``: ``__key, doc_id, keep_id, group_size, kept, text_sha256``.

    ``is_history`` tells the rows of the index from those looked up in it; without it, ids below
    the middle of their range are the history. Of equal texts the row with the largest id stays.
    A null text is an empty one. Rows with a repeated or null id are ordered by a digest of the
    row (null ids first) and stay rows of their own, so exactly one of a group is kept. Texts of any length are
    told apart by their digest, which covers them whole. An empty table gives no rows; other columns
    are ignored.
    """
    keyed = with_key(docs)
    if is_history is None:
        # Two numbers of the whole table.
        low, high = keyed.agg(F.min(KEY), F.max(KEY)).first()
        is_history = F.col(KEY) < ((low + high + 1) // 2 if low is not None else 0)
    rows = stage(keyed.select(KEY, "doc_id", digest().alias("digest"), is_history.alias("old")), "digests")
    shards = max(1, -(-rows.count() // SHARD_DIGESTS))
    index = build_index(rows.where("old"), shards)
    found = stage(groups(index, rows.where("not old"), shards), "digest-groups")
    return rows.join(found, "digest").select(
        KEY,
        "doc_id",
        "keep_id",
        "group_size",
        (F.col(KEY) == F.col("keep_key")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(documents(spark, sf_dir)).drop(KEY)


def keep_first_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of equal texts, the row with the largest id stays.

    Null and empty texts, repeated rows and null ids follow the operator's rule; all columns are
    kept, whatever their names, and an empty table gives an empty one.
    """
    keyed = with_key(docs)
    kept = exact_dedup(keyed).where("kept").select(KEY)
    return without_key(keyed.join(kept, KEY, "left_semi"), docs)


OP10_SQL = """
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
"""
