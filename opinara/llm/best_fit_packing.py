"""Packing documents into sequences of a fixed length, improved by swaps.

Documents longer than a sequence are cut into whole pieces, which fill sequences of their own; what
remains of each document, at most one shorter piece, is packed. The short pieces are dealt by hash
into groups of a bounded size, and a task packs a group: best fit in descending order, then a local
search that empties the least filled sequences by moving documents, exchanging one for one, two for
one or one for two with other sequences, as long as the sum of squared fills grows.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.llm.common import KEY, documents, with_key
from opinara.llm.tokens import encoder_for, vocabulary_path
from opinara.staging import stage


@dataclass(frozen=True)
class PackConfig:
    vocabulary: str
    end_id: int = 2
    length: int = 1024
    #: Short pieces that one task packs, on average.
    group_pieces: int = 32_768


PIECE_SCHEMA = "key long, doc_id long, piece int, start long, length long, ids_crc32 long"


def _pieces(config: PackConfig):
    schema = pa.schema(
        [("key", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoder_for(config.vocabulary, config.end_id)
        for batch in batches:
            out: list[list[int]] = [[] for _ in schema]
            keys, ids, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for key, doc_id, tokens in zip(keys, ids, encoder.encode(texts)):
                first = len(tokens) % config.length or config.length
                cuts = [0, *range(first, len(tokens) + 1, config.length)]
                for piece, (start, end) in enumerate(zip(cuts, cuts[1:])):
                    crc = zlib.crc32(tokens[start:end].astype("<u4").tobytes())
                    for column, value in zip(out, (key, doc_id, piece, start, end - start, crc)):
                        column.append(value)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(out, schema.types)], schema=schema)

    return run


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Sequences as lists of item numbers: longest first, each into the fullest that takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps = 0  # bit g is set if a sequence has g free places
    for item in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[item])
        fitting = gaps >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            at = by_gap[gap].pop()
            if not by_gap[gap]:
                gaps ^= 1 << gap
            bins[at].append(item)
        else:
            gap, at = capacity, len(bins)
            bins.append([item])
        left = gap - size
        by_gap[left].append(at)
        if left:
            gaps |= 1 << left
    return bins


class SwapSearch:
    """Sequences with room, and what each could give: single documents and pairs of documents.

    Offers are kept by their size, each list in the order of its sequences' room, so an exchange
    looks at one list for every size and not at every offer.
    """

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.bins, self.lengths, self.capacity = bins, lengths, capacity
        self.fill = np.array([lengths[b].sum() for b in bins], np.int64)
        #: Offers of at most one document, and pairs: (room, sequence, offer) by size, and the widest room.
        self.offers: list[list[list[tuple]]] = [[[] for _ in range(capacity + 1)] for _ in range(2)]
        self.widest = np.full((2, capacity + 1), -1, np.int64)
        self.listed: dict[int, list[tuple[int, int, tuple]]] = {}
        for at in range(len(bins)):
            self._refresh(at)

    def _offers_of(self, at: int) -> list[tuple[int, ...]]:
        """Nothing, a document of each size, and a pair of documents of each two sizes, equal ones too."""
        by_size: dict[int, list[int]] = {}
        for i in self.bins[at]:
            by_size.setdefault(int(self.lengths[i]), []).append(i)
        firsts = [same[-1] for same in by_size.values()]
        pairs = [(a, b) for n, a in enumerate(firsts) for b in firsts[:n]]
        twins = [(same[-1], same[-2]) for same in by_size.values() if len(same) > 1]
        return [(), *((i,) for i in firsts), *pairs, *twins]

    def _refresh(self, at: int) -> None:
        """List all offers of a changed sequence in place of its old ones."""
        for kind, size, entry in self.listed.pop(at, ()):
            same = self.offers[kind][size]
            del same[bisect_left(same, entry)]
            self.widest[kind, size] = same[-1][0] if same else -1
        room = self.capacity - int(self.fill[at])
        if not 0 < room < self.capacity:
            return
        listed = self.listed[at] = []
        for offer in self._offers_of(at):
            kind, size = int(len(offer) == 2), sum(int(self.lengths[i]) for i in offer)
            entry = (room, at, offer)
            insort(self.offers[kind][size], entry)
            self.widest[kind, size] = self.offers[kind][size][-1][0]
            listed.append((kind, size, entry))

    def _exchange(self, donor: int, out: tuple[int, ...]) -> bool:
        """Give ``out`` for the smallest offer of a sequence that then is no fuller than allowed."""
        given = sum(int(self.lengths[i]) for i in out)
        spare = self.capacity - int(self.fill[donor])
        widest = self.widest[0, :given] if len(out) == 2 else self.widest[:, :given].max(axis=0)
        for size in np.flatnonzero(widest >= given - np.arange(given)).tolist():
            gain, best = given - size, None
            for kind in range(1 if len(out) == 2 else 2):
                same = self.offers[kind][size]
                for n in range(bisect_left(same, (gain,)), len(same)):
                    # The other sequence ends up fuller than this one was, or squares would not grow.
                    if same[n][0] >= spare + gain:
                        break
                    if same[n][1] != donor:
                        best = same[n] if best is None else min(best, same[n])
                        break
            if best is not None:
                _, other, back = best
                self.bins[donor] = [i for i in self.bins[donor] if i not in out] + list(back)
                self.bins[other] = [i for i in self.bins[other] if i not in back] + list(out)
                self.fill[donor] -= gain
                self.fill[other] += gain
                self._refresh(donor)
                self._refresh(other)
                return True
        return False

    def empty(self, donor: int) -> bool:
        """Exchange until the sequence is empty or nothing helps."""
        while self.bins[donor]:
            offers = sorted((o for o in self._offers_of(donor) if o), key=lambda o: -int(self.lengths[list(o)].sum()))
            if not any(self._exchange(donor, offer) for offer in offers):
                return False
        return True

    def run(self) -> list[list[int]]:
        """Try every sequence with room, the least filled first, unless no fewer sequences can hold all."""
        tried = np.zeros(len(self.bins), bool)
        floor = -(-int(self.lengths.sum()) // self.capacity)
        while np.count_nonzero(self.fill) > floor:
            fill = np.where(tried | (self.fill == 0), self.capacity, self.fill)
            donor = int(fill.argmin())
            if fill[donor] == self.capacity:
                break
            tried[donor] = True
            self.empty(donor)
        return [b for b in self.bins if b]


def pack(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return SwapSearch(best_fit(lengths, capacity), lengths, capacity).run()


def _pack_group(config: PackConfig):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("uid", ignore_index=True)
        lengths = rows["length"].to_numpy()
        sequence, offset = np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        for number, items in enumerate(pack(lengths, config.length)):
            sequence[items] = (int(key[0]) << 32) + number
            offset[items] = np.cumsum(lengths[items]) - lengths[items]
        return rows.drop(columns=["group"]).assign(sequence_id=sequence, offset=offset)

    return run


def pack_documents(docs: DataFrame, config: PackConfig) -> DataFrame:
    """A row per piece: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``.

    A null or empty text is one piece, its end id. A document is cut only if it is longer than a
    sequence, however long; its first piece then is the shorter one. Pieces of equal length are
    interchangeable, so which of them lies where may differ from run to run. Repeated rows are
    packed as often as they come, null ids too. An empty table gives no rows; other columns are
    ignored.
    """
    keyed = with_key(docs).select(F.col(KEY).alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    cut = keyed.mapInArrow(_pieces(config), PIECE_SCHEMA)
    pieces = stage(cut.withColumn("uid", F.monotonically_increasing_id()), "pieces")
    whole = pieces.where(F.col("length") == config.length)
    short = pieces.where(F.col("length") < config.length)
    groups = max(1, -(-short.count() // config.group_pieces))
    dealt = short.withColumn("group", F.pmod(F.xxhash64("uid"), F.lit(groups)))
    schema = f"{PIECE_SCHEMA}, uid long, sequence_id long, offset long"
    packed = dealt.groupBy("group").applyInPandas(_pack_group(config), schema)
    alone = whole.withColumn("sequence_id", -F.col("uid") - 1).withColumn("offset", F.lit(0).cast("long"))
    return packed.unionByName(alone).drop("key", "uid")


def default_config() -> PackConfig:
    return PackConfig(vocabulary_path())


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir), default_config())


def pack_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: where every piece of every remaining document lies.

    Null and empty texts are an end id each; repeated rows are packed as often as they come. An empty
    table gives no rows.
    """
    return pack_documents(docs, default_config())
