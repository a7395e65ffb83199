"""Result sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame


def write_result(df: DataFrame, path: str, fmt: str = "json") -> None:
    """Write a result as JSON, CSV (with header) or Parquet."""
    writer = df.write.mode("overwrite")
    if fmt == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
    writer.format(fmt).save(path)
