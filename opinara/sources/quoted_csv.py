"""Quoted CSV files read in many tasks each.

A newline ends a record only outside quotes, and whether a byte range starts inside quotes depends on
all before it. Lines are therefore read in blocks, by the text source. Each line maps the state
before it (outside or inside a quoted cell) to the state after it; a first pass composes these maps
over a block, a running composition over a file's blocks gives the state in which each starts, and a
second pass puts lines together to records. Records that reach over blocks meet by the block that
opened them. No text is exchanged but such ends of blocks, up to ``BROADCAST_BLOCKS`` blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from opinara.staging import stage

#: Blocks whose states may be broadcast, about 100 bytes each; of more, lines are joined by block.
BROADCAST_BLOCKS = 100_000

#: Cells are quoted with ", which is doubled inside; a quote within an unquoted cell is a character.
CSV_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}

_QUOTED = r'"(?:[^"]|"")*+"'
_REST = rf'(?:(?:{_QUOTED}[^,]*+|(?!")[^,]*+),)*+"(?:[^"]|"")*+$'
_CLOSING = r'^(?:[^"]|"")*+"[^,]*+'
OPENS = f"(?s)^{_REST}"
REOPENS = f"(?s){_CLOSING},{_REST}"
CLOSES = f"(?s){_CLOSING}"

WHOLE, OPENING, INNER, CLOSING = 0, 1, 2, 3


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, line)`` in reading order within a task; a block's lines are neighbours."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return lines.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.col("value").alias("line"),
    )


def ends_inside(line: Column) -> tuple[Column, Column]:
    """Whether a line ends inside quotes if it starts outside, and if it starts inside."""
    closes = line.rlike(CLOSES)
    return line.rlike(OPENS), ~closes | line.rlike(REOPENS)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(file, block, after_out, after_in, left)`` per block: the states after it from either state
    before it, and whether it is ever outside if it starts inside."""
    found: dict[tuple[str, int], list] = {}
    for batch in batches:
        for file, block, out, inside in zip(*(c.to_pylist() for c in batch.columns)):
            state = found.setdefault((file, block), [False, True, False])
            state[0] = inside if state[0] else out
            state[1] = inside if state[1] else out
            state[2] |= not state[1]
    rows = [(file, block, *state) for (file, block), state in found.items()]
    columns = list(zip(*rows)) if rows else [[]] * 5
    types = [pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.bool_()]
    yield pa.record_batch(
        [pa.array(c, t) for c, t in zip(columns, types)], names=["file", "block", "after_out", "after_in", "left"]
    )


def block_states(lines: DataFrame) -> DataFrame:
    """``(file, block, inside, opener)``: whether a block starts inside quotes, and the block in
    which the record open at its start began. A row a block; windows run over the blocks of a file."""
    marked = lines.select("file", "block", *ends_inside(F.col("line")))
    blocks = marked.mapInArrow(_composed, "file string, block long, after_out boolean, after_in boolean, left boolean")
    before = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, -1)
    up_to = W.partitionBy("file").orderBy("block").rowsBetween(W.unboundedPreceding, 0)
    # A block's map is constant, leaves the state, or turns it: the last constant and the number of
    # turns after it give the state.
    constant = F.col("after_out") == F.col("after_in")
    turns = F.when(~constant & F.col("after_out"), 1).otherwise(0)
    counted = blocks.withColumn("turns", F.sum(turns).over(up_to))
    last = F.last(F.when(constant, F.col("after_out").cast("int")), True).over(before)
    since = F.coalesce(F.max("turns").over(before), F.lit(0)) - F.coalesce(
        F.last(F.when(constant, F.col("turns")), True).over(before), F.lit(0)
    )
    stated = counted.withColumn("inside", (F.coalesce(last, F.lit(0)) + since) % 2 == 1)
    after = F.when(F.col("inside"), F.col("after_in")).otherwise(F.col("after_out"))
    opens = after & (~F.col("inside") | F.col("left"))
    return stated.withColumn("opener", F.last(F.when(opens, F.col("block")), True).over(before)).select(
        "file", "block", "inside", "opener"
    )


_PARTS = pa.schema(
    [("file", pa.string()), ("block", pa.int64()), ("opener", pa.int64()), ("ordinal", pa.int64()),
     ("part", pa.int32()), ("text", pa.string())]
)


def _assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each block, and the parts of records that reach over its ends."""
    at, opener, state, first, ordinal, held = None, None, False, False, 0, []

    def rest() -> list[tuple]:
        """What is left open at a block's end."""
        if not held:
            return []
        part, start = (INNER, opener) if first else (OPENING, at[1])
        return [(*at, start, -1 if first else ordinal, part, "\n".join(held))]

    for batch in batches:
        done = []
        for file, block, line, out, into, inside, began in zip(*(c.to_pylist() for c in batch.columns)):
            if (file, block) != at:
                done += rest()
                if inside is None:
                    raise ValueError(f"{file} was split otherwise before; keep spark.sql.files.* as they are while it is read")
                at, opener, state, first, ordinal, held = (file, block), began, inside, inside, 0, []
            held.append(line)
            state = into if state else out
            if state:
                continue
            text = "\n".join(held).removesuffix("\r")
            held = []
            if first:
                done.append((*at, opener, -1, CLOSING, text))
                first = False
            elif text:
                done.append((*at, block, ordinal, WHOLE, text))
                ordinal += 1
        if done:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*done), _PARTS)], schema=_PARTS)
    if left := rest():
        yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*left), _PARTS)], schema=_PARTS)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, block, ordinal, text)``: every record, named by the block that it starts in and its
    number there. Empty lines between records are left out."""
    lines = _lines(spark, path)
    states = stage(block_states(lines), "csv-blocks")
    few = states.count() <= BROADCAST_BLOCKS
    marked = lines.select("*", *(c.alias(n) for c, n in zip(ends_inside(F.col("line")), ("out", "into"))))
    if few:
        joined = marked.join(F.broadcast(states), ["file", "block"], "left")
    else:
        # The join exchanges lines by block, a scan partition at most, and their order is restored.
        numbered = marked.withColumn("row", F.monotonically_increasing_id()).repartition("file", "block")
        joined = numbered.join(states, ["file", "block"], "left").sortWithinPartitions("file", "block", "row")
    parts = joined.select("file", "block", "line", "out", "into", "inside", "opener").mapInArrow(
        _assembled, "file string, block long, opener long, ordinal long, part int, text string"
    )
    # Parts of one record: as many as blocks that it reaches over.
    pieces = F.sort_array(F.collect_list(F.struct("block", "text")))
    joint = parts.where(F.col("part") != WHOLE).groupBy("file", F.col("opener").alias("block")).agg(
        F.max("ordinal").alias("ordinal"), F.array_join(F.transform(pieces, lambda p: p["text"]), "\n").alias("text")
    )
    return parts.where(F.col("part") == WHOLE).select("file", "block", "ordinal", "text").unionByName(joint)


def largest_file(spark: SparkSession, path: str) -> int:
    """Bytes of the largest file; the files are listed, not read."""
    return spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] or 0


def read_quoted_csv(spark: SparkSession, path: str, position: str | None = None) -> DataFrame:
    """The rows of ``multiLine`` CSV files with a header, all columns as text, many tasks a file.

    ``position`` names a column for the reading order ``(file, block, row)``. Line ends inside cells
    are kept. Files are scanned twice. A file without rows but its header gives none.
    """
    names = spark.read.options(header=True, **CSV_OPTIONS).csv(path).columns
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in names)
    rows = records(spark, path).where("not (block = 0 and ordinal = 0)")
    place = F.struct("file", "block", F.col("ordinal").alias("row"))
    parsed = rows.select(place.alias("place"), F.from_csv("text", schema, CSV_OPTIONS).alias("row"))
    columns = [F.col("row").getField(name).alias(name) for name in names]
    return parsed.select(*columns, *([F.col("place").alias(position)] if position else []))
