"""Mixing sources to target weights by pivotal dependent rounding.

A source's target, divided by its size, is the number of copies that each of its documents should
have, whole copies and a fraction. Fractions become whole by the pivotal method: of two documents
with a fraction, one gives words to the other until one of them has none or all of its fraction,
with chances that leave every document's expectation as it was. Words are moved, not probabilities,
so the words of a source stay the same with every pair. A task does this for one bucket of a
source and is left with one document at most; these meet in a reduction tree of buckets, and only
the last one of a source is drawn alone, so a source misses its target by less than one document.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.llm.common import KEY, WORD, documents, quoted, ranked, whole_text, with_key
from opinara.staging import stage


@dataclass(frozen=True)
class MixConfig:
    #: Weights of the sources in their order, repeating.
    weights: tuple[int, ...] = (5, 2, 1)
    #: A target is at most so many times its source.
    most_copies: int = 3
    seed: int = 17
    #: Documents that one task pairs, on average.
    bucket_rows: int = 50_000
    #: Residuals that meet in one node of the tree.
    fan_in: int = 64


def sized(docs: DataFrame) -> DataFrame:
    """``__key, doc_id, source, size``: words of every row, written once."""
    words = F.regexp_count(whole_text(), F.lit(WORD)).cast("long")
    return stage(with_key(docs).select(KEY, "doc_id", F.col("source").cast("string"), words.alias("size")), "mix-sizes")


def source_targets(rows: DataFrame, config: MixConfig) -> DataFrame:
    """``source, n_docs, source_size, weight, target``; targets share the size of all rows.

    Each capped source gives its excess to the others by weight. The level (words per unit of
    weight) only rises, and a round takes one aggregate of the table of sources.
    """
    grouped = rows.groupBy("source").agg(F.count("*").alias("n_docs"), F.sum("size").alias("source_size"))
    ordered = ranked(grouped.withColumn("absent", F.col("source").isNull()), ["absent", "source"], "mix-sources")
    weight = F.element_at(F.array(*map(F.lit, config.weights)), (F.col("rank") % len(config.weights) + 1).cast("int"))
    cap = config.most_copies * F.col("source_size")
    sources = ordered.withColumn("weight", weight.cast("long")).withColumn("cap", cap.cast("double"))
    level, capped = 0.0, -1
    while True:
        full = F.col("cap") < F.lit(level) * F.col("weight")
        total, taken, weights, count = sources.agg(
            F.sum("source_size"),
            F.sum(F.when(full, F.col("cap")).otherwise(0.0)),
            F.sum(F.when(full, 0).otherwise(F.col("weight"))),
            F.sum(full.cast("int")),
        ).first()
        if count is None or count == capped or not weights:
            break
        level, capped = (total - taken) / weights, count
    target = F.least("cap", F.lit(level) * F.col("weight"))
    return stage(sources.select("source", "n_docs", "source_size", "weight", target.alias("target")), "mix-targets")


def pivot(sizes: np.ndarray, shares: np.ndarray, draw: np.random.Generator) -> np.ndarray:
    """Shares in (0, 1) made whole pair by pair; at most one stays between.

    The sum of ``sizes * shares`` is kept.
    """
    shares = shares.copy()
    chances = draw.random(len(shares))
    held = -1
    for i in range(len(shares)):
        if not 0 < shares[i] < 1:
            continue
        if held < 0:
            held = i
            continue
        a, b = held, i
        up = min(sizes[a] * (1 - shares[a]), sizes[b] * shares[b])
        down = min(sizes[b] * (1 - shares[b]), sizes[a] * shares[a])
        if chances[i] * (up + down) >= down:
            a, b, up = b, a, down
        full = sizes[a] * (1 - shares[a]) <= sizes[b] * shares[b]
        spent = sizes[b] * shares[b] <= sizes[a] * (1 - shares[a])
        shares[a] = 1.0 if full else shares[a] + up / sizes[a]
        shares[b] = 0.0 if spent else shares[b] - up / sizes[b]
        held = next((x for x in (a, b) if 0 < shares[x] < 1), -1)
    return shares


def _round(seed: int, level: int):
    def run(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(KEY, ignore_index=True)
        draw = np.random.default_rng([seed, level, int(rows[KEY].iloc[0]) & (2**63 - 1), len(rows)])
        rows["share"] = pivot(rows["size"].to_numpy(np.float64), rows["share"].to_numpy(np.float64), draw)
        return rows

    return run


_SCHEMA = f"{KEY} long, source string, size long, share double, bucket long"


def whole_shares(rows: DataFrame, config: MixConfig) -> DataFrame:
    """``__key, share`` with shares 0 or 1 of ``rows``, which have sizes above 0 and shares between."""
    level, open_rows, done = 0, rows, None
    while True:
        rounded = stage(open_rows.groupBy("source", "bucket").applyInPandas(_round(config.seed, level), _SCHEMA), "mix-round")
        closed = rounded.where("share <= 0 or share >= 1").select(KEY, "share")
        done = closed if done is None else done.union(closed)
        left = rounded.where("share > 0 and share < 1")
        if not left.where("bucket > 0").isEmpty():
            open_rows = left.withColumn("bucket", F.floor(F.col("bucket") / config.fan_in))
            level += 1
            continue
        # One row a source at most.
        alone = F.pmod(F.xxhash64(F.lit(config.seed), KEY), F.lit(1 << 30)) / float(1 << 30)
        last = left.select(KEY, F.when(alone < F.col("share"), 1.0).otherwise(0.0).alias("share"))
        return done.union(last)


def mix(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """A row per row of ``docs``: ``__key, doc_id, size, source_size, target, copies, taken``.

    Sources are in the order of their code points; rows without a source are one, the last. A null
    text has no words; rows without words get the whole part of their copies and change no sum.
    Repeated rows take part as rows of their own. Texts of any length count all their words. Draws
    depend on keys alone, so reruns agree, with repeated and null ids too. If no row has words, all
    targets are 0. An empty table gives no rows; other columns are ignored.
    """
    rows = sized(docs)
    targets = source_targets(rows, config).withColumnRenamed("source", "of")
    copies = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    joined = rows.join(targets, F.col("source").eqNullSafe(F.col("of"))).withColumn("q", copies)
    joined = joined.withColumn("whole", F.floor("q")).withColumn("share", F.col("q") - F.col("whole"))
    buckets = F.ceil(F.col("n_docs") / config.bucket_rows)
    bucket = F.pmod(F.xxhash64(KEY), buckets).cast("long").alias("bucket")
    open_rows = joined.where("size > 0 and share > 0").select(KEY, "source", "size", "share", bucket)
    shares = whole_shares(open_rows, config).withColumnRenamed("share", "extra")
    total = (F.col("whole") + F.coalesce(F.col("extra"), F.lit(0.0))).cast("long")
    return joined.join(shares, KEY, "left").select(
        KEY, "doc_id", "size", "source_size", "target", total.alias("copies"), (total * F.col("size")).alias("taken")
    )


def op4_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir)).drop(KEY, "copies")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: every document as often as the mix takes it, perhaps not at all.

    Null and empty texts, repeated rows and null ids follow the operator's rule; all columns are
    kept, whatever their names, and an empty table gives an empty one.
    """
    keyed = with_key(docs)
    taken = mix(keyed).where("copies > 0").select(KEY, F.array_repeat(F.lit(1), F.col("copies").cast("int")).alias("times"))
    rows = keyed.select(KEY, F.struct(*[F.col(c) for c in quoted(keyed.columns) if c != f"`{KEY}`"]).alias("row"))
    return rows.join(taken, KEY).select("row", F.explode("times")).select("row.*").toDF(*docs.columns)
