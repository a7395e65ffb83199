"""Shards along a Hilbert curve over metadata.

Source, language and size are quantised to cells, and rows are ordered by the place of their cell
on a Hilbert curve, which keeps neighbours in every dimension close. The order is cut into runs of
equal numbers of rows, so a shard covers a small box and files are skipped by the minima and maxima
of several columns at once. Rows are range-partitioned by the curve and numbered per partition;
equal texts of a cell lie side by side, and the id breaks ties, so a cell that holds a third of all
rows is cut like any other.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.llm.common import KEY, documents, free_name, quoted, ranked, whole_text, with_key
from opinara.staging import stage


@dataclass(frozen=True)
class ShardConfig:
    shards: int = 16
    #: Bits of a dimension's cells.
    bits: int = 8


def hilbert_index(cells: np.ndarray, bits: int) -> np.ndarray:
    """Places on the Hilbert curve of ``n x d`` cells of ``bits`` bits (Skilling's transform)."""
    x = [cells[:, i].astype(np.int64) for i in range(cells.shape[1])]
    top = 1 << (bits - 1)
    q = top
    while q > 1:
        p = q - 1
        for i in range(len(x)):
            high = (x[i] & q) != 0
            swap = np.where(high, 0, (x[0] ^ x[i]) & p)
            x[0] = np.where(high, x[0] ^ p, x[0] ^ swap)
            if i:
                x[i] ^= swap
        q >>= 1
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros_like(x[0])
    q = top
    while q > 1:
        turn = np.where((x[-1] & q) != 0, turn ^ (q - 1), turn)
        q >>= 1
    index = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for column in x:
            index = (index << 1) | (((column ^ turn) >> bit) & 1)
    return index


def _curve(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)], axis=1)
            yield pa.record_batch([*batch.columns[3:], pa.array(hilbert_index(cells, bits))], names=[*batch.schema.names[3:], "curve"])

    return run


def cells_of(rows: DataFrame, column: str, bits: int) -> DataFrame:
    """``(value, cell)``: the distinct values in order (null first) dealt evenly into cells."""
    values = rows.select(F.col(column).alias("value")).distinct()
    ordered = ranked(values, ["value"], "shard-values")
    count = max(1, ordered.count())
    cell = F.floor(F.col("rank") * (1 << bits) / count)
    return stage(ordered.select("value", F.least(cell, F.lit((1 << bits) - 1)).cast("long").alias("cell")), "shard-cells")


def size_cell(size: Column, bits: int) -> Column:
    """Eighths of an octave."""
    return F.least(F.floor(F.log2(size.cast("double")) * 8), F.lit((1 << bits) - 1)).cast("long")


def assign_shards(docs: DataFrame, config: ShardConfig = ShardConfig()) -> DataFrame:
    """A row per row of ``docs``: key, id, size, checksum, ``law, shard, slot, grown_shard, curve``.

    The law is ``rows``: shards differ by one row at most. A null text has no bytes, and null
    sources and languages are values of their own, the first. Ties along the curve are in the order
    of checksum and id; repeated rows lie side by side. Equal texts of one source and language are a
    run, which this law may split where a shard ends; those of other sources or languages lie
    elsewhere. An empty table gives no rows; other columns are ignored.
    """
    text = whole_text()
    rows = with_key(docs).select(
        KEY,
        "doc_id",
        F.col("source").cast("string").alias("source"),
        F.col("lang").cast("string").alias("lang"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )
    rows = stage(rows, "shard-rows")
    for column in ("source", "lang"):
        cells = cells_of(rows, column, config.bits).select(F.col("value").alias(f"{column}_value"), F.col("cell").alias(f"{column}_cell"))
        rows = rows.join(cells, F.col(column).eqNullSafe(F.col(f"{column}_value")))
    placed = rows.select("source_cell", "lang_cell", size_cell(F.col("size"), config.bits).alias("size_cell"), KEY, "doc_id", "size", "text_crc32")
    curved = placed.mapInArrow(_curve(config.bits), f"{KEY} long, doc_id long, size long, text_crc32 long, curve long")
    ordered = ranked(curved, ["curve", "text_crc32", KEY], "shard-order")
    count = max(1, ordered.count())
    shard = F.expr(f"(rank * {config.shards}) div {count}")
    first = F.expr(f"(shard * {count} + {config.shards - 1}) div {config.shards}")
    return ordered.withColumn("shard", shard).select(
        KEY,
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("shard").cast("int").alias("shard"),
        (F.col("rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        "curve",
    )


def write_shards(docs: DataFrame, folder: str, config: ShardConfig = ShardConfig()) -> None:
    """Write the rows of ``docs``, all columns, into a folder per shard, in the order of the curve.

    The folders' column is ``shard_number``, with underscores after it if ``docs`` has such a column.
    """
    keyed = with_key(docs)
    places = assign_shards(keyed, config).select(KEY, "shard", "slot")
    rows = keyed.select(KEY, F.struct(*[F.col(c) for c in quoted(keyed.columns) if c != f"`{KEY}`"]).alias("row"))
    ordered = rows.join(places, KEY).repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    folder_column = free_name("shard_number", docs.columns)
    named = ordered.select("row.*", "shard").toDF(*docs.columns, folder_column)
    named.write.partitionBy(folder_column).parquet(folder)


def op3_hilbert_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return assign_shards(documents(spark, sf_dir)).drop(KEY)
