"""Exact stratified samples and splits.

Rows of a class are ordered by a digest of their id and the seed. Samples and splits are
contiguous ranges of that order, so they need only the *cut points* between ranges: finding those
reads ids and labels alone, and applying them is a filter. Texts are never shuffled or ranked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from opinara.staging import pin

#: Hex digits per refinement step (4096 prefixes per class).
PREFIX_DIGITS = 3

#: Rows of one class that a single task may rank.
ROWS_TO_RANK = 1_000_000


def order_key(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit(f":{seed}")))


def class_sizes(df: DataFrame, label: str) -> DataFrame:
    labelled = df.where(F.col(label).isNotNull())
    return labelled.groupBy(F.col(label).alias("label")).agg(F.count(F.lit(1)).alias("n"))


def measured(df: DataFrame, label: str) -> tuple[DataFrame, int, int]:
    """Class sizes, all rows, and the refinement rounds the largest class needs."""
    sizes = pin(class_sizes(df, label), "sizes")
    rows, largest = sizes.agg(F.sum("n"), F.max("n")).first()
    return sizes, rows or 0, refinements(largest or 0)


def apportion(sizes: DataFrame, size_col: str, draws: Column, out: str) -> DataFrame:
    """Share ``draws`` rows among classes in proportion to ``size_col``, largest remainders first.

    ``sizes`` has one row per class; equal remainders go by label.
    """
    every = W.partitionBy(F.lit(1))
    ideal = F.col(size_col) / F.sum(size_col).over(every) * draws
    df = sizes.withColumn("ideal", ideal).withColumn("whole", F.floor("ideal"))
    by_rest = every.orderBy(F.desc(F.col("ideal") - F.col("whole")), "label")
    left = draws - F.sum("whole").over(every)
    extra = (F.row_number().over(by_rest) <= left).cast("bigint")
    return df.withColumn(out, F.col("whole") + extra).drop("ideal", "whole")


def refinements(largest_class: int) -> int:
    """Rounds of prefix counts after which few enough rows share a prefix."""
    rounds = 0
    while largest_class > ROWS_TO_RANK:
        largest_class //= 16**PREFIX_DIGITS
        rounds += 1
    return rounds


def cut_points(keyed: DataFrame, quotas: DataFrame, rounds: int) -> DataFrame:
    """Key and id of the ``rank``-th row of each class.

    ``keyed`` is ``(label, key, id)``; ``quotas`` is ``(label, cut, rank)`` with few rows. Every
    round counts rows per key prefix and keeps the one prefix that holds the cut, a 4096th of the
    rows; only rows that share it are ranked.
    """
    found = quotas.where("rank > 0").select("label", "cut", "rank")
    shared: list[str] = []
    for step in range(rounds):
        found = pin(found, "cuts")
        name = f"prefix{step}"
        prefix = F.substring("key", 1 + step * PREFIX_DIGITS, PREFIX_DIGITS).alias(name)
        keyed = keyed.select("*", prefix)
        joined = keyed.join(found, ["label", *shared])
        counts = joined.groupBy("label", *shared, "cut", "rank", name).agg(F.count(F.lit(1)).alias("n"))
        upto = F.sum("n").over(W.partitionBy("label", "cut").orderBy(name))
        inside = (F.col("upto") - F.col("n") < F.col("rank")) & (F.col("rank") <= F.col("upto"))
        shared = [*shared, name]
        found = counts.withColumn("upto", upto).where(inside).select(
            "label", *shared, "cut", (F.col("rank") - (F.col("upto") - F.col("n"))).alias("rank")
        )
    joined = keyed.join(pin(found, "cuts"), ["label", *shared])
    place = F.row_number().over(W.partitionBy("label", "cut").orderBy("key", "id"))
    ranked = joined.withColumn("place", place).where("place = rank")
    return ranked.select("label", "cut", F.col("key").alias("cut_key"), F.col("id").alias("cut_id"))


def assign_ranges(
    df: DataFrame, quotas: DataFrame, cuts: tuple[str, ...], label: str, id_col: str, seed: int, rounds: int
) -> tuple[DataFrame, Column]:
    """``(df with its cut points, range name)``: the first of ``cuts`` that reaches the row.

    ``quotas`` is ``(label, cut, rank)``; the ranks of one class grow in the order of ``cuts``.
    Rows beyond the last cut, and rows without a label, get null.
    """
    key = order_key(id_col, seed)
    keyed = df.select(F.col(label).alias("label"), key.alias("key"), F.col(id_col).alias("id"))
    point = F.struct("cut_key", "cut_id")
    ladder = cut_points(keyed, quotas, rounds).groupBy(F.col("label").alias("__label")).agg(
        *[F.max(F.when(F.col("cut") == name, point)).alias(f"__{name}") for name in cuts]
    )
    joined = df.join(pin(ladder, "ladder"), df[label] == F.col("__label"), "left")
    here = F.struct(key.alias("cut_key"), F.col(id_col).alias("cut_id"))
    name = F.lit(None).cast("string")
    for cut in reversed(cuts):
        name = F.when(here <= F.col(f"__{cut}"), F.lit(cut)).otherwise(name)
    return joined, name


def stratified_subset(
    df: DataFrame, n: int | None, label: str = "sentiment", id_col: str = "id", seed: int = 42, exact: bool = True
) -> DataFrame:
    """About ``n`` rows with every class in proportion; all rows if ``n`` is null or not smaller.

    Each class gives ``round(n / rows * class rows)`` rows, halves to even. ``exact=False`` draws
    each row independently in one pass instead, so sizes are approximate.
    """
    sizes, rows, rounds = measured(df, label)
    if n is None or n >= rows:
        return df
    share = n / rows
    if not exact:
        return df.where(F.col(label).isNotNull()).sample(fraction=share, seed=seed)
    quotas = sizes.select(
        "label", F.lit("kept").alias("cut"), F.rint(F.lit(share) * F.col("n")).cast("bigint").alias("rank")
    )
    joined, kept = assign_ranges(df, quotas, ("kept",), label, id_col, seed, rounds)
    return joined.where(kept.isNotNull()).select(df.columns)


def split_quotas(sizes: DataFrame, rows: int, test: float, val: float) -> DataFrame:
    """Cumulative ``(label, cut, rank)``: test rows first, then val; train is the rest.

    ``val`` is a share of all rows. Held-out sizes are rounded up, and classes share the rows that
    stay by largest remainder.
    """
    rest = rows - math.ceil(test * rows)
    train = rest - math.ceil(val / (1 - test) * rest)
    quotas = apportion(sizes, "n", F.lit(rest), "rest")
    quotas = apportion(quotas, "rest", F.lit(train), "train")
    return quotas.select(
        "label",
        F.stack(
            F.lit(2),
            F.lit("test"), F.col("n") - F.col("rest"),
            F.lit("val"), F.col("n") - F.col("train"),
        ).alias("cut", "rank"),
    )


def stratified_split(
    df: DataFrame, test: float = 0.15, val: float = 0.15, label: str = "sentiment", id_col: str = "id", seed: int = 42
) -> DataFrame:
    """Add ``split``: train, val or test, every class in proportion; null for rows without a label."""
    sizes, rows, rounds = measured(df, label)
    quotas = split_quotas(sizes, rows, test, val)
    joined, held_out = assign_ranges(df, quotas, ("test", "val"), label, id_col, seed, rounds)
    split = F.when(F.col(label).isNotNull(), F.coalesce(held_out, F.lit("train")))
    return joined.select(*df.columns, split.alias("split"))


def stratified_folds(df: DataFrame, folds: int, label: str = "label", id_col: str = "id", seed: int = 42) -> DataFrame:
    """Add ``fold`` (0-based), every class spread evenly over the folds; null for rows without a label."""
    sizes, _, rounds = measured(df, label)
    names = tuple(str(i) for i in range(folds - 1))
    steps = [(F.lit(i), F.ceil(F.col("n") * (int(i) + 1) / folds)) for i in names]
    quotas = sizes.select("label", F.stack(F.lit(len(steps)), *[c for s in steps for c in s]).alias("cut", "rank"))
    joined, fold = assign_ranges(df, quotas, names, label, id_col, seed, rounds)
    number = F.when(F.col(label).isNotNull(), F.coalesce(fold, F.lit(str(folds - 1))).cast("int"))
    return joined.select(*df.columns, number.alias("fold"))


def sample_reviews(
    df: DataFrame, k: int = 5, label: str = "sentiment", text: str = "review", id_col: str = "id",
    seed: int = 42, snippet_chars: int = 300,
) -> DataFrame:
    """``k`` reproducible random rows: label and the beginning of the text, for display."""
    picked = df.orderBy(order_key(id_col, seed), id_col).limit(k)
    return picked.select(id_col, label, F.substring(text, 1, snippet_chars).alias("review_snippet"))
