"""Hard-negative mining by slot-decomposed selection.

An anchor's positives each open a window of scores: from a share of the positive's score to a
larger share of it. The windows overlap, but their upper limits cut the scores into disjoint slots.
One pass keeps the best ``k`` rows of every slot; merged from the lowest slot upwards, they give the
best ``k`` at or below every limit, and a window's rows are those of its limit that reach its lower
bound. So however many windows an anchor has, a score is compared with disjoint slots only.

Anchors and rows are dealt into blocks by label. A block of anchors meets a slice of blocks of rows
in one task, which keeps a running best ``k`` per slot (the combiner); the survivors of the slices
meet in a ranked window. The same kernel, with one open slot and the same label instead of another,
finds the positives.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from opinara.llm.common import KEY, id_is_key, ranked, with_key
from opinara.staging import stage


@dataclass(frozen=True)
class MiningConfig:
    positives: int = 5
    negatives: int = 3
    #: A negative's score is from ``low`` to ``high`` hundredths of the positive's.
    low: int = 50
    high: int = 95
    #: Components count in steps of one to so many.
    steps: int = 256
    #: Rows of a block of anchors and of a block of all rows; blocks of a slice.
    anchor_rows: int = 1024
    block_rows: int = 2048
    slice_blocks: int = 8
    #: Bytes that a block of rows may take; long vectors make shorter blocks.
    block_bytes: int = 4 << 20


#: A component's absolute value, in steps, goes up to this.
MOST = 1 << 24


def _quantised(vector: Column, steps: int, most: int) -> Column:
    scaled = F.transform(vector, lambda x: F.floor(F.lit(float(steps)) * x.cast("double")))
    return F.transform(scaled, lambda x: F.greatest(F.lit(-most), F.least(F.lit(most), x)).cast("int"))


def _usable(vector: Column) -> Column:
    """Whether a vector is there and all its components are finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    return vector.isNotNull() & finite


_BLOCK = "labels array<long>, keys array<long>, vectors binary, limits array<array<long>>, bounds array<array<long>>"


def _packed(dim: int):
    """The rows of a block as one row, by key; shorter vectors are filled up with zeros."""

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by(KEY)
        vectors = np.zeros((len(table), dim), np.int32)
        for at, vector in enumerate(table["vector"]):
            values = vector.values.to_numpy(zero_copy_only=False)
            vectors[at, : len(values)] = values
        columns = {
            "block": pa.array([table["block"][0].as_py()], pa.int64()),
            "labels": pa.array([table["label"].to_pylist()], pa.list_(pa.int64())),
            "keys": pa.array([table[KEY].to_pylist()], pa.list_(pa.int64())),
            "vectors": pa.array([vectors.tobytes()], pa.binary()),
            "limits": pa.array([table["limits"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
            "bounds": pa.array([table["bounds"].to_pylist()], pa.list_(pa.list_(pa.int64()))),
        }
        return pa.table(columns)

    return run


def _blocks(rows: DataFrame, size: int, dim: int, name: str) -> DataFrame:
    """``block`` and its rows; ``rows`` has ``rank, label, __key, vector, limits, bounds``."""
    numbered = rows.select(F.floor(F.col("rank") / size).alias("block"), "label", KEY, "vector", "limits", "bounds")
    return stage(numbered.groupBy("block").applyInArrow(_packed(dim), f"block long, {_BLOCK}"), name)


class Best:
    """The best ``k`` rows so far of every slot of every anchor: higher score, then smaller key.

    ``limits`` and ``bounds`` are anchors times slots: slots run downwards, each from its limit to
    the next one's, and what is below a slot's bound is in no window.
    """

    def __init__(self, limits: np.ndarray, bounds: np.ndarray, k: int):
        self.k, self.limits = k, limits
        below = np.concatenate([limits[:, 1:], np.full((len(limits), 1), np.iinfo(np.int64).min)], axis=1)
        self.floors = np.maximum(bounds, np.where(below == np.iinfo(np.int64).min, below, below + 1))
        empty = np.empty(0, np.int64)
        self.kept = [(empty, empty, empty)] * limits.shape[1]

    def add(self, scores: np.ndarray, allowed: np.ndarray, keys: np.ndarray) -> None:
        """``scores`` are anchors times rows; columns in ascending order of ``keys``."""
        for slot, held in enumerate(self.kept):
            floor = self.floors[:, slot : slot + 1]
            hit = (scores <= self.limits[:, slot : slot + 1]) & (scores >= floor) & allowed
            if hit.sum() > 4 * self.k * len(scores) and hit.shape[1] > self.k:
                # Only what the block's own k-th best lets through.
                masked = np.where(hit, scores, np.iinfo(np.int64).min)
                hit &= scores >= np.partition(masked, -self.k, axis=1)[:, -self.k, None]
            anchors, columns = np.nonzero(hit)
            if not len(anchors):
                continue
            joined = [np.concatenate(x) for x in zip(held, (anchors, scores[anchors, columns], keys[columns]))]
            order = np.lexsort((joined[2], -joined[1], joined[0]))
            anchors = joined[0][order]
            starts = np.flatnonzero(np.concatenate([[True], anchors[1:] != anchors[:-1]]))
            place = np.arange(len(anchors)) - np.repeat(starts, np.diff([*starts, len(anchors)]))
            best = order[place < self.k]
            self.kept[slot] = tuple(x[best] for x in joined)
            last = order[place == self.k - 1]
            # A row that ties with the k-th best may still have the smaller key.
            self.floors[joined[0][last], slot] = joined[1][last]


def _products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products: doubles as long as no sum can leave their whole numbers."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    kind = np.float64 if most < 1 << 53 else np.int64
    return (a.astype(kind) @ b.astype(kind).T).astype(np.int64)


def _select(k: int, same_label: bool, dim: int):
    """The best of a slice of blocks for every slot of a block of anchors."""

    def run(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        found = []
        if len(anchors) and len(rows):
            block = anchors.slice(0, 1).to_pylist()[0]
            labels, keys = np.array(block["labels"], np.int64), np.array(block["keys"], np.int64)
            vectors = np.frombuffer(block["vectors"], np.int32).reshape(len(keys), dim)
            slots = max(map(len, block["limits"]))
            none = np.iinfo(np.int64).min
            limits = np.array([x + [none] * (slots - len(x)) for x in block["limits"]], np.int64).reshape(-1, slots)
            bounds = np.array([x + [none] * (slots - len(x)) for x in block["bounds"]], np.int64).reshape(-1, slots)
            # A slot that an anchor lacks takes nothing.
            bounds = np.where(limits == none, none + 1, bounds)
            best = Best(limits, bounds, k)
            for at in range(len(rows)):
                other_keys = rows["keys"][at].values.to_numpy()
                other_labels = rows["labels"][at].values.to_numpy()
                same = labels[:, None] == other_labels
                allowed = same & (keys[:, None] != other_keys) if same_label else ~same
                if allowed.any():
                    others = np.frombuffer(rows["vectors"][at].as_buffer(), np.int32).reshape(len(other_keys), dim)
                    best.add(_products(vectors, others), allowed, other_keys)
            found = [(keys[a], np.full(len(a), slot, np.int32), s, k_) for slot, (a, s, k_) in enumerate(best.kept)]
        empty = (np.empty(0, np.int64), np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64))
        columns = [np.concatenate(x) for x in zip(empty, *found)]
        return pa.table(dict(zip(("anchor", "slot", "score", "other"), columns)))

    return run


def _best_of_slices(anchors: DataFrame, rows: DataFrame, k: int, same_label: bool, dim: int, config: MiningConfig) -> DataFrame:
    """``anchor, slot, score, other, place``: the best ``k`` of every slot over all rows.

    A block of ``rows`` meets the blocks of anchors from ``first_anchor`` to ``last_anchor``.
    """
    slices = F.floor(F.col("block") / config.slice_blocks)
    last_slice = rows.agg(F.max(slices)).first()[0]
    sides = rows.withColumn("slice", slices).withColumn("a", F.explode(F.sequence("first_anchor", "last_anchor")))
    blocks = anchors.withColumnRenamed("block", "a").withColumn("slice", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(last_slice).cast("long"))))
    scored = (
        blocks.groupBy("a", "slice")
        .cogroup(sides.select("a", "slice", "labels", "keys", "vectors").groupBy("a", "slice"))
        .applyInArrow(_select(k, same_label, dim), "anchor long, slot int, score long, other long")
    )
    best_first = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "other")
    return scored.withColumn("place", F.row_number().over(best_first)).where(F.col("place") <= k)


_FOUND = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


def mine_hard_negatives(rows: DataFrame, is_anchor: Column, config: MiningConfig = MiningConfig()) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``rows`` has ``vec_id, label`` (whole numbers) and ``embedding``; ``is_anchor`` tells the anchors
    by them. A component counts as the floor of 256 times itself, a score is an inner product. An
    anchor's positives are the best rows of its label but itself; a positive's negatives are the
    best rows of other labels with scores from 50 to 95 hundredths of the positive's, so a positive
    below 0 has none. Higher scores come first, ties by smaller id.

    Rows without a label or a vector, or with a component that is null or not finite, take no part.
    Shorter vectors count as filled up with zeros, empty ones score 0 with all. Components saturate
    at 2^24 steps, and earlier in vectors of over 327, so scores fit 64 bits. Repeated rows are rows
    of their own, with ties in the order of a digest of the row; a null id comes before all others.
    No anchors, an empty table or a single label give no rows; other columns are ignored.
    """
    spark = rows.sparkSession
    vector = F.col("embedding")
    valid = rows.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), "embedding", F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    valid = valid.where(F.col("label").isNotNull() & _usable(vector))
    dim = valid.agg(F.max(F.size(vector))).first()[0]
    if dim is None:
        return spark.createDataFrame([], _FOUND)
    dim = max(1, dim)
    most = min(MOST, math.isqrt((2**63 - 1) // (100 * dim)))
    keyed = with_key(valid, "vec_id")
    narrow = keyed.select(KEY, "vec_id", "label", _quantised(vector, config.steps, most).alias("vector"), "is_anchor")
    order = ["label", KEY]
    ordered = ranked(narrow, order, "mining-rows")
    size = max(1, min(config.block_rows, config.block_bytes // (4 * dim)))
    any_score = F.array(F.lit(2**63 - 1)), F.array(F.lit(-(2**63)))
    open_slot = {"limits": any_score[0], "bounds": any_score[1]}
    blocks = _blocks(ordered.withColumns(open_slot), size, dim, "mining-blocks")
    anchors = ranked(ordered.where("is_anchor").select(KEY, "label", "vector"), order, "mining-anchors")
    anchor_size = max(1, min(config.anchor_rows, config.block_bytes // (4 * dim)))
    last_anchor = anchors.agg(F.max(F.floor(F.col("rank") / anchor_size))).first()[0]
    if last_anchor is None:
        return spark.createDataFrame([], _FOUND)

    # Anchors are in the order of labels, so those of a block's labels are one run of blocks.
    of_label = anchors.groupBy("label").agg(
        F.min(F.floor(F.col("rank") / anchor_size)).alias("first_anchor"), F.max(F.floor(F.col("rank") / anchor_size)).alias("last_anchor")
    )
    labelled = blocks.select("block", F.explode(F.array_distinct("labels")).alias("label"))
    near = labelled.join(of_label, "label").groupBy("block").agg(F.min("first_anchor").alias("first_anchor"), F.max("last_anchor").alias("last_anchor"))
    opened = _blocks(anchors.withColumns(open_slot), anchor_size, dim, "mining-open")
    positives = _best_of_slices(opened, blocks.join(near, "block"), config.positives, True, dim, config)

    positives = positives.select(
        "anchor", "place", F.col("other").alias("positive"), F.col("score").alias("positive_score"),
        _floor_div(F.col("score") * config.high, 100).alias("upper"), (-_floor_div(-F.col("score") * config.low, 100)).alias("lower"),
    )
    windows = F.sort_array(F.collect_list(F.struct("place", "positive", "positive_score", "upper", "lower")))
    windowed = stage(positives.groupBy("anchor").agg(windows.alias("windows")), "mining-windows")
    limits = F.sort_array(F.array_distinct(F.transform("windows", lambda w: w["upper"])), asc=False)
    # A slot is in the windows whose limit is its own or above.
    least = F.transform("limits", lambda u: F.array_min(F.transform(F.filter("windows", lambda w: w["upper"] >= u), lambda w: w["lower"])))
    slotted = windowed.withColumn("limits", limits).withColumn("bounds", least)
    limited = anchors.join(slotted.select(F.col("anchor").alias(KEY), "limits", "bounds"), KEY)
    every = blocks.withColumns({"first_anchor": F.lit(0).cast("long"), "last_anchor": F.lit(last_anchor).cast("long")})
    per_slot = _best_of_slices(_blocks(limited, anchor_size, dim, "mining-slots"), every, config.negatives, False, dim, config)

    rows_of = F.collect_list(F.struct("slot", "place", F.col("other").alias("negative"), "score"))
    kept = per_slot.groupBy("anchor").agg(F.sort_array(rows_of).alias("kept"))
    joined = slotted.join(kept, "anchor")
    by_slot = F.transform(F.sequence(F.size("limits") - 1, F.lit(0)), lambda j: F.filter("kept", lambda c: c["slot"] == j))
    kind = "array<array<struct<slot:int,place:int,negative:bigint,score:bigint>>>"

    def merge(below: Column, slot: Column) -> Column:
        """Puts a slot on top of what the slots below it have given."""
        rest = F.when(F.size(below) > 0, below[0]).otherwise(F.filter(slot, lambda _: F.lit(False)))
        return F.concat(F.array(F.slice(F.concat(slot, rest), 1, config.negatives)), below)

    answers = F.aggregate(by_slot, F.array().cast(kind), merge)
    each = joined.select("anchor", "limits", answers.alias("answers"), F.explode("windows").alias("w"))
    own = F.element_at("answers", F.array_position("limits", F.col("w.upper")).cast("int"))
    reached = F.filter(own, lambda c: c["score"] >= F.col("w.lower"))
    found = each.select("anchor", "w.positive", "w.positive_score", F.posexplode(reached).alias("at", "c")).select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
        F.col("c.negative").alias("negative_id"), "positive_score", F.col("c.score").alias("negative_score"),
    )
    if id_is_key(keyed):
        return found
    names = keyed.select(F.col(KEY).alias("at"), "vec_id")
    for column in ("anchor_id", "positive_id", "negative_id"):
        found = found.join(names, F.col(column) == F.col("at")).withColumn(column, F.col("vec_id")).drop("at", "vec_id")
    return found.select([c.split()[0] for c in _FOUND.split(", ")])


def _floor_div(value: Column, by: int) -> Column:
    """Exact floor of a whole number's quotient, also below zero."""
    return F.call_function("div", value - F.pmod(value, F.lit(by)), F.lit(by))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


OP13_SQL = """
WITH vectors AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
           list_inner_product(a.q, b.q)::BIGINT AS score
    FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id
    WHERE a.vec_id % 50 = 0
), positives AS (
    SELECT anchor_id, other AS positive_id, score AS positive_score FROM scores WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5
)
SELECT p.anchor_id, p.positive_id,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other)::INTEGER AS rank,
       s.other AS negative_id, p.positive_score, s.score AS negative_score
FROM positives p JOIN scores s ON p.anchor_id = s.anchor_id AND NOT s.same
    AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
