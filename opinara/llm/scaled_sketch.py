"""Document fingerprints that keep every shingle hash below a fixed fraction of the hash range.

What a sketch keeps of a shingle depends on the shingle alone, so the sketch of a union is the union
of the sketches, and the share of a small document's sketch that lies in a large one's estimates
how much of the small document the large one contains, however unequal they are. A text none of
whose hashes lies below the bound keeps its smallest one instead, which a union can drop or keep by
the same rule; so every text with a word has a sketch.

Shingles are runs of five words (the whole sequence if shorter), A-Z lower-cased. Hashes have 48
bits and are written as 12 hexadecimal digits each, in ascending order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from opinara.llm.common import KEY, documents, shuffle_width, with_key
from opinara.llm.shingles import WordCodes, codes_of, shingle_hashes, words_of
from opinara.staging import stage

HASH_BITS = 48


@dataclass(frozen=True)
class SketchConfig:
    #: Words of a shingle.
    width: int = 5
    #: One of so many hashes is kept.
    scale: int = 8

    @property
    def bound(self) -> int:
        return (1 << HASH_BITS) // self.scale


def thresholded(hashes: np.ndarray, config: SketchConfig) -> np.ndarray:
    """Distinct hashes below the bound, ascending; the smallest one if there is none."""
    kept = np.unique(hashes[hashes < np.uint64(config.bound)])
    return kept if len(kept) or not len(hashes) else hashes.min(keepdims=True)


#: Words whose shingles are hashed at once.
BLOCK_WORDS = 200_000


def sketch(text: str | None, codes: WordCodes, config: SketchConfig = SketchConfig()) -> np.ndarray:
    """The sketch of a text; empty without words. Long texts are hashed block by block."""
    words = words_of(text)
    parts = []
    for start in range(0, len(words), BLOCK_WORDS):
        # Shingles that begin in the block; the last block's start is never short of a whole one.
        block = words[start : start + BLOCK_WORDS + config.width - 1]
        if start and len(block) < config.width:
            break
        hashes = shingle_hashes(codes_of(block, codes), config.width) >> np.uint64(64 - HASH_BITS)
        parts.append(thresholded(hashes, config))
    return merged(parts, config)


def merged(sketches: Iterable[np.ndarray], config: SketchConfig = SketchConfig()) -> np.ndarray:
    """The sketch of the union of what ``sketches`` were made of."""
    parts = list(sketches)
    return thresholded(np.concatenate(parts), config) if parts else np.empty(0, np.uint64)


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the hashes of either sketch that both have; two empty sketches are alike."""
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return shared / (len(a) + len(b) - shared) if len(a) or len(b) else 1.0


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """Share of the hashes of ``a`` that ``b`` has; an empty sketch is contained in any."""
    return len(np.intersect1d(a, b, assume_unique=True)) / len(a) if len(a) else 1.0


def packed(hashes: np.ndarray) -> bytes:
    """Six bytes a hash."""
    return hashes.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def written(hashes: np.ndarray) -> str:
    """Twelve digits a hash."""
    return packed(hashes).hex()


def read(fingerprint: str) -> np.ndarray:
    data = np.frombuffer(bytes.fromhex(fingerprint), np.uint8).reshape(-1, HASH_BITS // 8)
    return np.pad(data, ((0, 0), (2, 0))).view(">u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, config: SketchConfig = SketchConfig()) -> DataFrame:
    """``doc_id, fingerprint`` of every row of ``docs``; equal texts have equal fingerprints.

    A null text is an empty one; texts without words have an empty fingerprint. Repeated rows keep a
    row each, null ids too; texts of any length are read whole. An empty table gives no rows; other
    columns are ignored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            texts = batch.column("text")
            made = pa.array([written(sketch(t.as_py(), codes, config)) for t in texts], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), made], ["doc_id", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last half replaced by the beginning of ``following``."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


_MEASURES = {
    "n_chars": pa.int64(),
    "edited_sha256": pa.binary(),
    "fingerprint": pa.binary(),
    "edited_fingerprint": pa.binary(),
    "near_edited": pa.float64(),
    "near_next": pa.float64(),
    "contained_edited": pa.float64(),
    "contained_next": pa.float64(),
}
_MEASURE_COLUMNS = (
    "n_chars long, edited_sha256 binary, fingerprint binary, edited_fingerprint binary,"
    " near_edited double, near_next double, contained_edited double, contained_next double"
)


def _compared(text: str, own: np.ndarray, following: str, after: np.ndarray, codes: WordCodes, config: SketchConfig) -> tuple:
    new = edited(text, following)
    made = own if new == text else sketch(new, codes, config)
    return (
        len(text), hashlib.sha256(new.encode("utf-8", "surrogatepass")).digest(), packed(own), packed(made),
        likeness(own, made), likeness(own, after), containment(own, made), containment(own, after),
    )


_PLACED = ["doc_id", "part", *_MEASURES, "first_text", "last_text"]
#: Rows that a task hands on at once.
_HANDED_ON = 500


def _neighbours(config: SketchConfig):
    """Compares each row of a sorted partition with the one after it, one row held back.

    The first row's text and the last one's are handed on: the last has its neighbour elsewhere.
    """
    types = [pa.int64(), pa.int32(), *_MEASURES.values(), pa.string(), pa.string()]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], _PLACED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes, held, out = WordCodes(), None, []
        for batch in batches:
            for doc_id, part, text in zip(batch.column("doc_id"), batch.column("part"), batch.column("text")):
                text = text.as_py() or ""
                own = sketch(text, codes, config)
                first = text if held is None else None
                if held is not None:
                    at, in_part, before, sketched, opening = held
                    out.append((at, in_part, *_compared(before, sketched, text, own, codes, config), opening, None))
                held = doc_id.as_py(), part.as_py(), text, own, first
                if len(out) >= _HANDED_ON:
                    yield batch_of(out)
                    out = []
        if held is not None:
            at, in_part, before, _, opening = held
            out.append((at, in_part, *[None] * len(_MEASURES), opening, before))
        if out:
            yield batch_of(out)

    return run


def _closing(config: SketchConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = WordCodes()
        for batch in batches:
            rows = []
            for text, following in zip(batch.column("last_text"), batch.column("next_text")):
                text, following = text.as_py(), following.as_py()
                rows.append(_compared(text, sketch(text, codes, config), following, sketch(following, codes, config), codes, config))
            columns = [pa.array(c, t) for c, t in zip(zip(*rows), _MEASURES.values())] if rows else [pa.array([], t) for t in _MEASURES.values()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *_MEASURES])

    return run


def sketch_neighbours(docs: DataFrame, config: SketchConfig = SketchConfig()) -> DataFrame:
    """Every document against its edited text and the next document, in descending order of ids.

    ``doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    contained_edited, contained_next``, a row per row of ``docs``. The edited text is the text with
    its last half replaced by the beginning of the next document's; after the last document comes
    the first, so a single one is its own neighbour. Likeness is estimated from fingerprints; two
    texts without words are alike, one without words is like no other.

    A null text is an empty one. Null ids come last; repeated ids are in descending order of a
    digest of the row, so reruns agree. Long texts are handled whole, one row held back at a time.
    An empty table gives no rows; other columns are ignored.

    Rows are sorted by range once; tasks stream over their range. The first and last row of each
    range, two a partition, are written with their texts and meet in a join on the range's number.
    """
    keyed = with_key(docs).select(KEY, F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = F.col(KEY).desc()
    placed = keyed.repartitionByRange(shuffle_width(docs), order).sortWithinPartitions(order)
    rows = placed.select("doc_id", F.spark_partition_id().alias("part"), "text")
    schema = f"doc_id long, part int, {_MEASURE_COLUMNS}, first_text string, last_text string"
    staged = stage(rows.mapInArrow(_neighbours(config), schema), "sketches")
    heads = staged.where("first_text is not null").select("part", F.col("first_text").alias("next_text"))
    # A number for each partition that has rows; the last is followed by the first.
    by_part = Window.orderBy("part")
    parts = heads.select("part").select("part", F.lead("part").over(by_part).alias("after"), F.min("part").over(Window.partitionBy()).alias("least"))
    after = parts.select("part", F.coalesce("after", "least").alias("next_part"))
    tails = staged.where("last_text is not null").select("doc_id", "part", "last_text").join(after, "part")
    pairs = tails.join(heads.withColumnRenamed("part", "next_part"), "next_part").select("doc_id", "last_text", "next_text")
    closed = pairs.mapInArrow(_closing(config), f"doc_id long, {_MEASURE_COLUMNS}")
    whole = staged.where("last_text is null").select(closed.columns).union(closed)
    # Bytes are half as long as digits on disk.
    return whole.withColumns({c: F.lower(F.hex(c)) for c, kind in _MEASURES.items() if kind == pa.binary()})


def op11_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketch_neighbours(documents(spark, sf_dir))
