"""Token ids in Arrow files of fixed-size lists.

Each task writes the documents of one range of ids as one Arrow file: record batches of sequences of
equal length, ids in a fixed-size list and a mask of eight positions a byte, set where the
sequence holds an id. A sequence's place in a file is a product, so any run of ids is read from a
memory-mapped file without decoding or copying more than itself. An index table tells each
document's file, its start in the file and its number of ids.

A task writes under a name of its own attempt, and the index names the files of the attempts that
count, so a lost executor leaves at most a file that nobody reads.
"""

from __future__ import annotations

import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.llm.common import KEY, documents, with_key
from opinara.llm.tokens import encoder_for, vocabulary_path
from opinara.staging import stage, staging_path


@dataclass(frozen=True)
class TokenFileConfig:
    vocabulary: str
    end_id: int = 2
    #: Ids of a sequence, a multiple of eight.
    length: int = 1024
    #: Sequences of a record batch.
    batch: int = 256
    #: Bytes of an id in the files: 2 for vocabularies of up to 65,536 ids.
    id_bytes: int = 2


INDEX_SCHEMA = "part int, file string, doc_id long, first long, n_tokens long"


def open_folder(folder: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's address, and its path there."""
    if "://" in folder or folder.startswith("file:"):
        return pafs.FileSystem.from_uri(folder)
    return pafs.LocalFileSystem(), folder


def file_schema(config: TokenFileConfig) -> pa.Schema:
    ids = {2: pa.uint16(), 4: pa.uint32()}[config.id_bytes]
    return pa.schema([("ids", pa.list_(ids, config.length)), ("mask", pa.list_(pa.uint8(), config.length // 8))])


class SequenceWriter:
    """Appends ids; writes a record batch whenever enough sequences are full."""

    def __init__(self, sink: pa.NativeFile, config: TokenFileConfig):
        self.config, self.schema = config, file_schema(config)
        self.writer = pa.ipc.new_file(sink, self.schema)
        self.kind = np.dtype(f"<u{config.id_bytes}")
        self.waiting: list[np.ndarray] = []
        self.held, self.written = 0, 0

    def append(self, ids: np.ndarray) -> int:
        """The place of the first of ``ids`` in the file."""
        at = self.written + self.held
        if len(ids) and int(ids.max()) >= 1 << (8 * self.config.id_bytes):
            raise ValueError(f"an id does not fit into {self.config.id_bytes} bytes")
        self.waiting.append(ids.astype(self.kind))
        self.held += len(ids)
        if self.held >= self.config.batch * self.config.length:
            self._write(self.held - self.held % (self.config.batch * self.config.length))
        return at

    def _write(self, count: int) -> None:
        ids = np.concatenate(self.waiting)
        full = -(-count // self.config.length) * self.config.length
        rows = np.zeros(full, self.kind)
        rows[:count] = ids[:count]
        mask = np.packbits(np.arange(full) < count)
        for start in range(0, full, self.config.batch * self.config.length):
            end = min(full, start + self.config.batch * self.config.length)
            lists = [
                pa.FixedSizeListArray.from_arrays(pa.array(rows[start:end]), self.config.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask[start // 8 : end // 8]), self.config.length // 8),
            ]
            self.writer.write_batch(pa.record_batch(lists, schema=self.schema))
        self.waiting = [ids[count:]]
        self.held -= count
        self.written += count

    def close(self) -> None:
        if self.held:
            self._write(self.held)
        self.writer.close()


class SequenceFile:
    """Random access to a file: whole sequences and masks without a copy, runs of ids by place."""

    def __init__(self, folder: str, name: str):
        system, path = open_folder(folder)
        full = f"{path}/{name}"
        local = isinstance(system, pafs.LocalFileSystem)
        self.source = pa.memory_map(full) if local else system.open_input_file(full)
        self.reader = pa.ipc.open_file(self.source)
        self.length = self.reader.schema.field("ids").type.list_size
        self.batch = self.reader.get_batch(0).num_rows if self.reader.num_record_batches else 1

    def sequences(self, batch: int) -> np.ndarray:
        """Sequences of a record batch, a view of the file."""
        column = self.reader.get_batch(batch).column(0)
        return column.flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length)

    def mask(self, batch: int) -> np.ndarray:
        column = self.reader.get_batch(batch).column(1)
        return column.flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length // 8)

    def ids(self, first: int, count: int) -> np.ndarray:
        size = self.batch * self.length
        parts = []
        for batch in range(first // size, -(-(first + count) // size) if count else 0):
            flat = self.sequences(batch).reshape(-1)
            parts.append(flat[max(0, first - batch * size) : first + count - batch * size])
        return np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def close(self) -> None:
        self.source.close()


def _write(folder: str, config: TokenFileConfig):
    schema = pa.schema([("part", pa.int32()), ("file", pa.string()), ("doc_id", pa.int64()), ("first", pa.int64()), ("n_tokens", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        part = task.partitionId()
        name = f"part-{part:06d}-{task.taskAttemptId()}-{uuid.uuid4().hex}.arrow"
        encoder, system, path = encoder_for(config.vocabulary, config.end_id), *open_folder(folder)
        system.create_dir(path, recursive=True)
        with system.open_output_stream(f"{path}/{name}") as sink:
            writer = SequenceWriter(sink, config)
            for batch in batches:
                first, sizes = [], []
                for ids in encoder.encode(batch.column(1).to_pylist()):
                    first.append(writer.append(ids))
                    sizes.append(len(ids))
                n = batch.num_rows
                columns = [[part] * n, [name] * n, batch.column(0), first, sizes]
                yield pa.record_batch([c if isinstance(c, pa.Array) else pa.array(c, t) for c, t in zip(columns, schema.types)], schema=schema)
            writer.close()

    return run


def write_tokens(docs: DataFrame, folder: str, config: TokenFileConfig) -> DataFrame:
    """Write the files in ascending order of ids; the index, written once.

    Files follow each other by ``part``. A null or empty text is its end id alone; null ids come
    first, repeated ids in the order of a digest of the row. A text may be longer than a record
    batch and runs on in the next. Other columns are ignored; an empty table gives an empty index.
    """
    keyed = with_key(docs).select(KEY, F.col("doc_id").cast("long"), F.col("text").cast("string"))
    ordered = keyed.repartitionByRange(KEY).sortWithinPartitions(KEY).select("doc_id", "text")
    return stage(ordered.mapInArrow(_write(folder, config), INDEX_SCHEMA), "token-index")


def with_starts(index: DataFrame) -> DataFrame:
    """``index`` with ``start``: the ids of all documents before."""
    # A row per file, as many as the range partitioning has partitions.
    sizes = {r["part"]: r["n"] for r in index.groupBy("part").agg(F.max(F.col("first") + F.col("n_tokens")).alias("n")).collect()}
    rows, before = [], 0
    for part in sorted(sizes):
        rows.append((part, before))
        before += sizes[part]
    table = index.sparkSession.createDataFrame(rows, "part int, before long")
    return index.join(F.broadcast(table), "part").withColumn("start", F.col("before") + F.col("first"))


def _read(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, file = None, None
        for batch in batches:
            sums = []
            files, first, sizes = (batch.column(i).to_pylist() for i in (2, 3, 4))
            for wanted, at, size in zip(files, first, sizes):
                if wanted != name:
                    if file is not None:
                        file.close()
                    name, file = wanted, SequenceFile(folder, wanted)
                sums.append(zlib.crc32(file.ids(at, size).astype("<u4").tobytes()))
            yield pa.record_batch(
                [batch.column(0), batch.column(1), batch.column(4), pa.array(sums, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"],
            )
        if file is not None:
            file.close()

    return run


def read_back(index: DataFrame, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` from the files."""
    rows = with_starts(index).select("doc_id", "start", "file", "first", "n_tokens")
    return rows.mapInArrow(_read(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = staging_path(spark, "token-files")
    index = write_tokens(documents(spark, sf_dir), folder, TokenFileConfig(vocabulary_path()))
    return read_back(index, folder)
