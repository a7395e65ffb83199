"""The split table on disk."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from opinara.sources.reviews import read_table

SPLITS = ("train", "val", "test")


def write_splits(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Write one folder per split. CSV quotes as ``read_table`` expects."""
    writer = df.write.mode("overwrite").partitionBy("split")
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)


def load_splits(spark: SparkSession, path: str, name: str | None = None, fmt: str = "parquet") -> DataFrame:
    """All splits, or one of them by partition pruning. CSV ids that are all numbers become numbers."""
    if fmt == "csv":
        df = read_table(spark, path, "csv")
        if "id" in df.columns and df.where(F.col("id").isNotNull() & F.col("id").try_cast("bigint").isNull()).isEmpty():
            df = df.withColumn("id", F.col("id").cast("bigint"))
    else:
        df = spark.read.format(fmt).load(path)
    if name is None:
        return df
    if name not in SPLITS:
        raise ValueError(f"Unknown split {name!r}; choose one of {list(SPLITS)}")
    return df.where(F.col("split") == name)
