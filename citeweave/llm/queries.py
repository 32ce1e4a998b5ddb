"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from citeweave.llm import decontamination, exact_dedup, jaccard_join, licenses, lm_scoring, mixing, oracles, quality, secrets, token_counts, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality_classifier": quality.op1_quality_classifier,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_mix_sources": mixing.op3_mix_sources,
        "op4_token_counts": token_counts.op4_token_counts,
        "op5_jaccard_join": jaccard_join.op5_jaccard_join,
        "op6_decontamination": decontamination.op6_decontamination,
        "op7_lm_scoring": lm_scoring.op7_lm_scoring,
        "op8_license_scan": licenses.op8_license_scan,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_secret_scan": secrets.op10_secret_scan,
        **oracles.QUERIES,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_exact_dedup": exact_dedup.ORACLE, **oracles.SQL}
