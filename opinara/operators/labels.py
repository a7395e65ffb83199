"""Label codes and class weights."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, functions as F

from opinara.config import LABEL_CODES


def encode_label(name: Column) -> Column:
    """Label name -> code as double; null for an unknown name."""
    pairs = chain.from_iterable((F.lit(k), F.lit(float(v))) for k, v in LABEL_CODES.items())
    return F.create_map(*pairs)[name]


def decode_label(code: Column) -> Column:
    pairs = chain.from_iterable((F.lit(v), F.lit(k)) for k, v in LABEL_CODES.items())
    return F.create_map(*pairs)[code.cast("int")]


def check_labels(df: DataFrame, name: str = "sentiment") -> None:
    """Raise if a label is not one of the known names."""
    bad = df.where(encode_label(F.col(name)).isNull()).select(name).limit(1).collect()
    if bad:
        raise ValueError(f"unknown label {bad[0][0]!r}; known labels are {sorted(LABEL_CODES)}")


def class_weights(df: DataFrame, label: str = "label") -> DataFrame:
    """Balanced weights: rows / (classes * rows of the class). Rows without a label are left out."""
    sizes = df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    totals = sizes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("classes"))
    return sizes.crossJoin(totals).select(
        label, "n", (F.col("rows") / (F.col("classes") * F.col("n"))).alias("weight")
    )


def with_class_weights(df: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Add the balanced weight of each row; labels are the two known codes."""
    rows = class_weights(df, label).limit(len(LABEL_CODES) + 1).collect()
    found = {row[label]: row["weight"] for row in rows}
    strange = sorted(set(found) - set(map(float, LABEL_CODES.values())))
    if strange:
        raise ValueError(f"unknown label code {strange[0]!r}; known codes are {sorted(LABEL_CODES.values())}")
    weight = F.lit(None).cast("double")
    for code, value in found.items():
        weight = F.when(F.col(label) == code, F.lit(value)).otherwise(weight)
    return df.withColumn(out, weight)
