"""The training-data pipeline: quality rules, exact dedup, near dedup, mixing, packing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinara.llm.best_fit_packing import pack_stage
from opinara.llm.common import documents
from opinara.llm.exact_dedup import keep_first_copies
from opinara.llm.near_dedup import keep_one_of_each_family
from opinara.llm.quality_rules import keep_good_documents
from opinara.llm.source_mixing import mix_sources
from opinara.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

STAGES: list[tuple[str, Stage]] = [
    ("quality_rules", keep_good_documents),
    ("exact_dedup", keep_first_copies),
    ("near_dedup", keep_one_of_each_family),
    ("source_mixing", mix_sources),
    ("best_fit_packing", pack_stage),
]

#: Packing has many equally good results, which SQL cannot single out.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every stage on what the one before it kept; each result is written and read again."""
    docs = documents(spark, sf_dir)
    for name, apply in STAGES:
        docs = stage(apply(spark, docs, sf_dir), name)
    return docs
