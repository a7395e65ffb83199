"""What the operators share: row keys, word rules, ranks over a whole table, repeated keys."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from opinara.staging import stage

#: ASCII white space separates words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
ASCII_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

KEY = "__key"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def quoted(names: list[str]) -> list[str]:
    """Names as references, whatever characters they hold."""
    return [f"`{name}`" for name in names]


def whole_text(text: str | Column = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit(""))


def digest(text: str | Column = "text") -> Column:
    """SHA-256 of the UTF-8 text as 32 bytes."""
    return F.unhex(F.sha2(whole_text(text).cast("binary"), 256))


def encoded(text: str | None) -> bytes:
    return (text or "").encode("utf-8", "surrogatepass")


def packed_texts(texts: DataFrame, least: int = 0) -> DataFrame:
    """``key, bytes, packed`` of ``key, text``, to be shuffled: texts of ``least`` bytes or more, compressed one by one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = pa.Codec("zstd", compression_level=1)
        for batch in batches:
            keys, sizes, packed = [], [], []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                data = encoded(text.as_py())
                if len(data) >= least:
                    keys.append(key)
                    sizes.append(len(data))
                    packed.append(codec.compress(data, asbytes=True))
            columns = [pa.array(keys, pa.int64()), pa.array(sizes, pa.int64()), pa.array(packed, pa.binary())]
            yield pa.record_batch(columns, names=["key", "bytes", "packed"])

    return texts.select("key", "text").mapInArrow(run, "key long, bytes long, packed binary")


def unpacked(packed: bytes, size: int) -> bytes:
    """The bytes of a text from ``packed_texts``."""
    return pa.Codec("zstd").decompress(packed, size, asbytes=True)


def lower_ascii(column: Column) -> Column:
    return F.translate(column, ASCII_UPPER, ASCII_UPPER.lower())


def ids_are_keys(df: DataFrame, id_col: str = "doc_id") -> bool:
    """Whether every id is there and none comes twice; reads the ids only."""
    repeated = df.groupBy(F.col(f"`{id_col}`").alias("id")).count().where("id is null or count > 1")
    return repeated.isEmpty()


#: Marks the key column that ``with_key`` made in this process, and whether it is the id or a place.
_MADE_OF = f"opinara.row_key.{uuid.uuid4().hex}"


def _key_made_of(df: DataFrame) -> str | None:
    return next((f.metadata.get(_MADE_OF) for f in df.schema.fields if f.name == KEY), None)


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores until no column of ``taken`` has it."""
    used = {other.lower() for other in taken}
    while name.lower() in used:
        name += "_"
    return name


def id_is_key(keyed: DataFrame) -> bool:
    """Whether the key of a frame from ``with_key`` is the id itself."""
    return _key_made_of(keyed) == "id"


def with_key(df: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``df`` with a unique, non-null ``__key`` in front that orders rows as ``id_col`` does.

    The id itself where ids are unique. Otherwise the rows are written once and numbered in the
    order of id (null first) and of a digest of the whole row, so repeated rows and null ids keep a
    row each, and reruns number them alike. A frame that has its key already is returned as it is;
    a column of that name from elsewhere is set aside under another (see ``without_key``).
    """
    if _key_made_of(df):
        return df
    aside = free_name(KEY, df.columns)
    names = [aside if name.lower() == KEY else name for name in df.columns]
    df = df.toDF(*names)
    if dict(df.dtypes)[id_col] in ("bigint", "int", "smallint", "tinyint") and ids_are_keys(df, id_col):
        return df.select(F.col(f"`{id_col}`").cast("bigint").alias(KEY, metadata={_MADE_OF: "id"}), *quoted(names))
    # Rows that are equal in every column are interchangeable, so they may be dealt at random.
    whole = F.sha2(F.to_json(F.struct(*quoted(names)), {"ignoreNullFields": "false"}).cast("binary"), 256)
    rows = df.select(F.col(f"`{id_col}`").alias("id"), whole.alias("whole"), F.struct(*quoted(names)).alias("row"))
    places = ranked(rows, ["id", "whole"], "keyed", spread=True)
    return places.select(F.col("rank").alias(KEY, metadata={_MADE_OF: "place"}), "row.*")


def without_key(keyed: DataFrame, like: DataFrame) -> DataFrame:
    """Rows of ``with_key(like)`` with the columns of ``like`` again."""
    return keyed.drop(KEY).toDF(*like.columns)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def ranked(df: DataFrame, order: list[str], name: str, spread: bool = False) -> DataFrame:
    """``df`` with ``rank`` (from 0) in the order of ``order``, written once.

    Rows are range-partitioned and numbered within partitions; the sizes of the partitions, a row
    each, give the offsets. ``order`` has to be unique, or equal rows have to be interchangeable;
    with ``spread``, many equal rows are dealt over several partitions.
    """
    dealt = [*order, F.rand(7)] if spread else order
    placed = df.repartitionByRange(shuffle_width(df), *dealt).sortWithinPartitions(*order)
    staged = stage(placed.withColumn("__at", F.monotonically_increasing_id()), name)
    part, place = F.shiftright("__at", 33).alias("__part"), F.expr("__at & 8589934591").alias("__place")
    rows = staged.select("*", part, place)
    # A row per partition of the shuffle: as many as spark.sql.shuffle.partitions at most.
    sizes = {r["__part"]: r["n"] for r in rows.groupBy("__part").agg(F.count("*").alias("n")).collect()}
    offsets, before = [], 0
    for key in sorted(sizes):
        offsets.append((key, before))
        before += sizes[key]
    table = df.sparkSession.createDataFrame(offsets, "__part bigint, __before bigint")
    return (
        rows.join(F.broadcast(table), "__part")
        .withColumn("rank", F.col("__before") + F.col("__place"))
        .drop("__at", "__part", "__place", "__before")
    )
