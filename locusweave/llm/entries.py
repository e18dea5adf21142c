"""The corpus queries and their SQL, for the driver's entry module."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import exact_dedup, language_id, license_scan, line_dedup, mixing, near_dedup, packing, prefix_trie, quality, secret_scan, structure_repair, suffix_dedup, toxicity

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_license_scan": license_scan.op2_license_scan,
    "op3_secret_scan": secret_scan.op3_secret_scan,
    "op4_soft_mixing": mixing.op4_soft_mixing,
    "op5_near_dedup": near_dedup.op5_near_dedup,
    "op6_line_windows": line_dedup.op6_line_windows,
    "op7_divergence_rules": quality.op7_divergence_rules,
    "op8_cost_packing": packing.op8_cost_packing,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_language_id": language_id.op10_language_id,
    "op11_structure_repair": structure_repair.op11_structure_repair,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_suffix_dedup": suffix_dedup.op13_suffix_dedup,
}

ORACLES: dict[str, str] = {
    "op2_license_scan": license_scan.OP2_SQL,
    "op6_line_windows": line_dedup.OP6_SQL,
    "op9_exact_dedup": exact_dedup.OP9_SQL,
    "op11_structure_repair": structure_repair.OP11_SQL,
    "op12_prefix_trie": prefix_trie.OP12_SQL,
    "op13_suffix_dedup": suffix_dedup.OP13_SQL,
}
