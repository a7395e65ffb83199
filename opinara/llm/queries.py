"""The operators as queries over whole tables, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from opinara.llm.best_fit_packing import op2_best_fit_packing
from opinara.llm.chained_passages import op8_chained_passages
from opinara.llm.exact_dedup import OP10_SQL, op10_exact_dedup
from opinara.llm.fill_in_middle import OP12_SQL, op12_fill_in_middle
from opinara.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from opinara.llm.hilbert_sharding import op3_hilbert_sharding
from opinara.llm.host_reputation import OP6_SQL, op6_host_reputation
from opinara.llm.near_dedup import op5_near_dedup
from opinara.llm.quality_rules import OP9_SQL, op9_quality_rules
from opinara.llm.scaled_sketch import op11_scaled_sketch
from opinara.llm.source_mixing import op4_source_mixing
from opinara.llm.suffix_dedup import op1_suffix_dedup
from opinara.llm.token_files import op7_token_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_hilbert_sharding": op3_hilbert_sharding,
    "op4_source_mixing": op4_source_mixing,
    "op5_near_dedup": op5_near_dedup,
    "op6_host_reputation": op6_host_reputation,
    "op7_token_files": op7_token_files,
    "op8_chained_passages": op8_chained_passages,
    "op9_quality_rules": op9_quality_rules,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_scaled_sketch": op11_scaled_sketch,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op6_host_reputation": OP6_SQL,
    "op9_quality_rules": OP9_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op12_fill_in_middle": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
