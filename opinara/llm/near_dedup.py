"""MinHash near-duplicates with odd sketches.

Every distinct shingle set gets MinHash samples, grouped into bands, and an odd sketch: a bitmap in
which each (sample number, sample) flips one bit. The bits in which two sketches differ tell how
many samples differ, so the population count of their XOR estimates a high similarity from 64 bytes
a document. Sets that share a band are candidates; those whose sketches are too far apart are let
go (at ``SIGMAS`` standard deviations below the threshold); the rest are confirmed on full sets.

A band's bucket may hold most of the table, so its pairs are never listed. Members are first
compared with the bucket's least row, which joins a family of near copies into one component.
Buckets that still hold several components are cut into blocks, and pairs of blocks look for close
sketches across components only: in the first bucket that two members share, and no further once
a pair that is surely similar has joined their components.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.llm.common import KEY, documents, with_key, without_key
from opinara.llm.components import components
from opinara.llm.shingles import WordCodes, codes_of, mixed, shingle_hashes, words_of
from opinara.staging import stage

SIGMAS = 5
#: Members of a bucket that meet in one block.
BLOCK = 512


@dataclass(frozen=True)
class NearConfig:
    """A pair at the threshold misses every band with probability (1 - 0.8 ** 6) ** 40 = 5e-6."""

    width: int = 4
    percent: int = 80
    bands: int = 40
    rows: int = 6
    sketch_words: int = 8

    @property
    def samples(self) -> int:
        return self.bands * self.rows

    @property
    def most_bits(self) -> int:
        """Differing bits up to which a pair is confirmed on full sets."""
        bits, alike = 64 * self.sketch_words, self.percent / 100
        differ = self.samples * (1 - alike) + SIGMAS * math.sqrt(self.samples * alike * (1 - alike))
        expected = bits / 2 * (1 - (1 - 2 / bits) ** (2 * differ))
        return math.ceil(expected + SIGMAS * math.sqrt(expected) / 2)


def set_of(text: str | None, codes: WordCodes, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    return np.unique(shingle_hashes(codes_of(words_of(text), codes), width))


def set_sketch(hashes: np.ndarray) -> bytes:
    """Parities of a whole set: four bits a shingle at least, a power of two of them."""
    bits = 1 << max(6, int(4 * len(hashes) - 1).bit_length())
    at = (hashes & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()


def surely(a: bytes, b: bytes, sizes: int, percent: int) -> int:
    """1 if two set sketches are surely of similar sets, -1 if surely not, else 0.

    ``sizes`` is the sum of the sizes of the sets. The wider sketch is folded onto the narrower.
    Every bit in which the sketches differ needs a shingle that one set lacks, so more such bits
    than a similar pair has shingles apart rule it out for certain; only a yes is an estimate.
    """
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) > len(y):
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    while len(y) > len(x):
        y = y[: len(y) // 2] ^ y[len(y) // 2 :]
    bits, odd = 64 * len(x), int(np.bitwise_count(x ^ y).sum())
    if odd * (100 + percent) > sizes * (100 - percent):
        return -1
    most = sizes * (100 - percent) / (100 + percent)
    slack = 2 + (SIGMAS + 1) * math.sqrt(1 + 2 * most * most / bits)
    if 2 * odd >= bits:
        return 0
    differ = math.log(1 - 2 * odd / bits) / math.log(1 - 2 / bits)
    return 1 if differ < most - slack else -1 if differ > most + slack else 0


class Sketcher:
    def __init__(self, config: NearConfig):
        self.config = config
        draw = np.random.default_rng(5)
        self.factor = draw.integers(0, 2**32, config.samples, dtype=np.uint32) | np.uint32(1)
        self.shift = draw.integers(0, 2**32, config.samples, dtype=np.uint32)
        self.salt = draw.integers(0, 2**63, config.samples, dtype=np.uint64)

    def samples(self, hashes: np.ndarray) -> np.ndarray:
        low = (hashes >> np.uint64(32)).astype(np.uint32)
        best = np.full(self.config.samples, 2**32 - 1, np.uint32)
        for start in range(0, len(low), 1024):
            part = self.factor[:, None] * low[None, start : start + 1024] + self.shift[:, None]
            np.minimum(best, part.min(axis=1), out=best)
        return best

    def bands(self, samples: np.ndarray) -> np.ndarray:
        rows = mixed(samples.astype(np.uint64) + self.salt).reshape(self.config.bands, self.config.rows)
        return mixed(rows.sum(axis=1, dtype=np.uint64) + np.arange(self.config.bands, dtype=np.uint64)).view(np.int64)

    def sketch(self, samples: np.ndarray) -> np.ndarray:
        bits = 64 * self.config.sketch_words
        at = (mixed(samples.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + self.salt) % np.uint64(bits)).astype(np.int64)
        odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
        return np.packbits(odd).view(np.int64)


def _features(config: NearConfig):
    schema = pa.schema(
        [
            ("key", pa.int64()),
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("set_digest", pa.binary()),
            ("bands", pa.list_(pa.int64())),
            ("sketch", pa.list_(pa.int64())),
            ("whole", pa.binary()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sketcher, codes = Sketcher(config), WordCodes()
        for batch in batches:
            sizes, digests, bands, sketches, wholes = [], [], [], [], []
            for text in batch.column(2):
                hashes = set_of(text.as_py(), codes, config.width)
                sizes.append(len(hashes))
                if len(hashes):
                    samples = sketcher.samples(hashes)
                    digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                    bands.append(sketcher.bands(samples))
                    sketches.append(sketcher.sketch(samples))
                    wholes.append(set_sketch(hashes))
                else:
                    digests.append(None)
                    bands.append(None)
                    sketches.append(None)
                    wholes.append(None)
            columns = [batch.column(0), batch.column(1), sizes, digests, bands, sketches, wholes]
            yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)

    return run


def features(docs: DataFrame, config: NearConfig) -> DataFrame:
    """``(key, doc_id, n_shingles, set_digest, bands, sketch, whole)`` of every row, written once."""
    schema = (
        "key long, doc_id long, n_shingles long, set_digest binary, bands array<long>, sketch array<long>, whole binary"
    )
    rows = docs.select(F.col(KEY).alias("key"), F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stage(rows.mapInArrow(_features(config), schema), "near-features")


def differing_bits(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x)


def _sets(config: NearConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            sets = [set_of(t.as_py(), codes, config.width).tobytes() for t in batch.column(1)]
            yield pa.record_batch([batch.column(0), pa.array(sets, pa.binary())], names=["key", "hashes"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for a, b in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(a.as_py(), np.uint64), np.frombuffer(b.as_py(), np.uint64)
                if 100 * min(len(x), len(y)) < percent * max(len(x), len(y)):
                    keep.append(False)
                    continue
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            wholes, others, sizes = (batch.column(i).to_pylist() for i in (2, 3, 4))
            keep = [surely(x, y, n, percent) >= 0 for x, y, n in zip(wholes, others, sizes)]
            yield pa.record_batch(batch.columns[:2], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


class Linker:
    """Confirms candidate pairs on full sets, which are written for the rows that need them."""

    def __init__(self, docs: DataFrame, reps: DataFrame, config: NearConfig):
        self.docs = docs.select(F.col(KEY).alias("key"), F.col("text").cast("string"))
        self.reps = reps
        self.config = config

    def close(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose sizes and sketches allow the similarity."""
        side = lambda n, what: self.reps.select(F.col("key").alias(n), F.col(what).alias(f"s{n}"), F.col("n_shingles").alias(f"n{n}"))
        sized = (100 * F.least("na", "nb")) >= self.config.percent * F.greatest("na", "nb")
        near = differing_bits(F.col("sa"), F.col("sb")) <= self.config.most_bits
        few = pairs.join(side("a", "sketch"), "a").join(side("b", "sketch"), "b").where(sized & near).select("a", "b")
        full = few.join(side("a", "whole"), "a").join(side("b", "whole"), "b")
        full = full.select("a", "b", "sa", "sb", (F.col("na") + F.col("nb")).alias("sizes"))
        return full.mapInArrow(_likely(self.config.percent), "a long, b long")

    def confirmed(self, pairs: DataFrame) -> DataFrame:
        """The links among ``pairs``, which is a written table."""
        ends = pairs.select(F.explode(F.array("a", "b")).alias("key")).distinct()
        wanted = self.docs.join(ends, "key", "left_semi")
        sets = stage(wanted.mapInArrow(_sets(self.config), "key long, hashes binary"), "near-sets")
        side = lambda n: sets.select(F.col("key").alias(n), F.col("hashes").alias(f"h{n}"))
        full = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "ha", "hb")
        return stage(full.mapInArrow(_confirm(self.config.percent), "a long, b long"), "near-links")


def _across(most_bits: int, percent: int):
    """Similar pairs of different components in a pair of blocks of a bucket."""

    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        bucket, one, two = key
        left, right = rows[rows["block"] == one], rows[rows["block"] == two]
        found: list[tuple[int, int]] = []
        if left.empty or right.empty:
            return pd.DataFrame(found, columns=["a", "b"], dtype="int64")
        joined: dict[int, int] = {}

        def top(comp: int) -> int:
            while comp in joined:
                comp = joined[comp]
            return comp

        sketches, bands = np.stack(right["sketch"].to_numpy()).view(np.uint64), np.stack(right["bands"].to_numpy())
        keys, comps, sizes, wholes = (right[c].to_numpy() for c in ("key", "comp", "n_shingles", "whole"))
        for row in left.itertuples():
            far = np.bitwise_count(sketches ^ np.asarray(row.sketch).view(np.uint64)).sum(axis=1)
            sized = 100 * np.minimum(row.n_shingles, sizes) >= percent * np.maximum(row.n_shingles, sizes)
            hit = np.flatnonzero((far <= most_bits) & sized & (comps != row.comp) & ((keys > row.key) | (one != two)))
            # A pair belongs to the first bucket that its members share.
            here = int(np.flatnonzero(np.asarray(row.bands) == bucket)[0])
            hit = hit[(bands[hit] == row.bands).argmax(axis=1) == here]
            for i in hit.tolist():
                a, b = top(row.comp), top(int(comps[i]))
                if a == b:
                    continue
                sure = surely(row.whole, wholes[i], row.n_shingles + int(sizes[i]), percent)
                if sure >= 0:
                    found.append((min(row.key, int(keys[i])), max(row.key, int(keys[i]))))
                if sure > 0:
                    joined[max(a, b)] = min(a, b)
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return run


def residual_pairs(members: DataFrame, labels: DataFrame, reps: DataFrame, config: NearConfig) -> DataFrame:
    """Close pairs between components within the buckets of three or more that hold several."""
    comp = F.coalesce("v", "key").alias("comp")
    rows = members.where("size > 2").join(labels, F.col("key") == F.col("u"), "left").select("bucket", "size", "key", comp)
    mixed_up = rows.groupBy("bucket").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high")
    blocks = F.ceil(F.col("size") / BLOCK).cast("int")
    placed = (
        rows.join(mixed_up.select("bucket"), "bucket", "left_semi")
        .join(reps.select("key", "sketch", "n_shingles", "bands", "whole"), "key")
        .withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "bucket", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"),
            "block", "key", "comp", "sketch", "n_shingles", "bands", "whole",
        )
    )
    pairs = placed.groupBy("bucket", "one", "two").applyInPandas(_across(config.most_bits, config.percent), "a long, b long")
    return pairs.distinct()


def near_components(docs: DataFrame, config: NearConfig = NearConfig()) -> DataFrame:
    """A row per row of ``docs``: ``__key, doc_id, n_shingles, component_id, kept``.

    Documents link if 100 * |intersection| >= percent * |union| of their distinct shingles (words
    split at ASCII white space, A-Z lower-cased). A null text, or one without words, has an empty
    set and links with nothing; with fewer words than a shingle, the whole sequence is one.
    Repeated rows and null ids stay rows of their own (null ids first): the first of a component
    is kept. Texts of any length are compared by all their shingles. An empty table gives no rows;
    other columns are ignored.
    """
    docs = with_key(docs)
    rows = features(docs, config)
    classes = rows.where("n_shingles > 0").groupBy("set_digest").agg(F.min("key").alias("rep"))
    classes = stage(classes, "near-classes")
    reps = stage(
        rows.join(classes.select(F.col("rep").alias("key")), "key", "left_semi").select("key", "n_shingles", "bands", "sketch", "whole"),
        "near-reps",
    )
    banded = reps.select("key", F.explode("bands").alias("bucket"))
    shared = banded.groupBy("bucket").agg(F.min("key").alias("center"), F.count("*").alias("size")).where("size > 1")
    members = stage(banded.join(shared, "bucket"), "near-members")
    linker = Linker(docs, reps, config)
    star = members.where("key <> center").select(F.col("center").alias("a"), F.col("key").alias("b")).distinct()
    star = stage(star, "near-stars")
    links = linker.confirmed(stage(linker.close(star), "near-pairs"))
    labels = components(links)
    others = residual_pairs(members, labels, reps, config).join(star, ["a", "b"], "left_anti")
    others = stage(others, "near-pairs")
    if not others.isEmpty():
        labels = components(links.union(linker.confirmed(others)))
    # Labels are least rows of components, and a class's representative is its least row.
    names = rows.select(F.col("key").alias("v"), F.col("doc_id").alias("least_id"))
    labelled = labels.join(names, "v").select(F.col("u").alias("rep"), "v", "least_id")
    tops = classes.join(labelled, "rep", "left").join(
        rows.select(F.col("key").alias("rep"), F.col("doc_id").alias("rep_id")), "rep"
    )
    tops = tops.select(
        "set_digest",
        F.coalesce("v", "rep").alias("top"),
        F.when(F.col("v").isNotNull(), F.col("least_id")).otherwise(F.col("rep_id")).alias("component_id"),
    )
    return rows.select("key", "doc_id", "n_shingles", "set_digest").join(tops, "set_digest", "left").select(
        F.col("key").alias(KEY),
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
        (F.coalesce("top", "key") == F.col("key")).alias("kept"),
    )


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_components(documents(spark, sf_dir)).drop(KEY)


def keep_one_of_each_family(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of near copies, the document with the smallest id stays.

    Null and empty texts, repeated rows and null ids follow the operator's rule; all columns are
    kept, whatever their names, and an empty table gives an empty one.
    """
    keyed = with_key(docs)
    kept = near_components(keyed).where("kept").select(KEY)
    return without_key(keyed.join(kept, KEY, "left_semi"), docs)
