"""Tables written part-way through a job.

A staged table cuts lineage and survives the loss of executors, and its real size is known to
the optimizer, which then picks broadcast or shuffle joins from it.
"""

from __future__ import annotations

import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, functions as F

#: Rows of a control table (cut points, class sizes) that may travel through the driver.
PINNED_ROWS = 10_000

_LOCAL_ROOTS: dict[str, str] = {}

#: Spark's switch for dropping the shuffle files of a query when it ends.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_LOCK = threading.Lock()

#: Sessions that are staging: how many threads are at it, and the switch as it was found.
_DROPPING: dict[SparkSession, tuple[int, str | None]] = {}


@contextmanager
def dropped_shuffles(spark: SparkSession) -> Iterator[None]:
    """Queries begun inside leave no shuffle files, which else stay until the driver collects its garbage."""
    with _LOCK:
        threads, before = _DROPPING.get(spark) or (0, spark.conf.get(DROP_SHUFFLES, None))
        _DROPPING[spark] = threads + 1, before
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        yield
    finally:
        with _LOCK:
            threads, before = _DROPPING.pop(spark)
            if threads > 1:
                _DROPPING[spark] = threads - 1, before
            elif before is None:
                spark.conf.unset(DROP_SHUFFLES)
            else:
                spark.conf.set(DROP_SHUFFLES, before)


def shared_folder(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``; local sessions get their own if it is unset."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    if context.applicationId not in _LOCAL_ROOTS:
        _LOCAL_ROOTS[context.applicationId] = tempfile.mkdtemp(prefix="opinara-")
    return _LOCAL_ROOTS[context.applicationId]


def staging_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/opinara/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, partition_by: str | None = None, codec: str | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back; the shuffle files of the way there go.

    ``codec`` compresses the files of a large table otherwise than the session does.
    """
    spark = df.sparkSession
    path = staging_path(spark, name)
    writer = df.write.option("compression", codec) if codec else df.write
    if partition_by:
        writer = writer.partitionBy(partition_by)
    # What is staged is read from its files from now on.
    with dropped_shuffles(spark):
        writer.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    return back.select([f"`{name}`" for name in df.columns])


def pin(df: DataFrame, name: str) -> DataFrame:
    """Compute a small control table once.

    Up to ``PINNED_ROWS`` rows come back as a broadcast local table. A larger one is staged and
    joined however the optimizer decides from its size.
    """
    rows = df.limit(PINNED_ROWS + 1).collect()
    if len(rows) <= PINNED_ROWS:
        return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema))
    return stage(df, name)
