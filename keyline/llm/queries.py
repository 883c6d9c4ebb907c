"""The operators' queries and their DuckDB SQL; those without SQL are tested against a
brute-force version, a round trip or held-out accuracy in tests/llm."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from keyline.llm import (
    alignment,
    bloom_lm,
    decontamination,
    exact_dedup,
    jaccard_join,
    language_id,
    license_scan,
    mixing,
    pii,
    token_counts,
    toxicity,
    warc,
    whitening,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": language_id.op1_language_id,
    "op2_jaccard_join": jaccard_join.op2_jaccard_join,
    "op3_mix_sources": mixing.op3_mix_sources,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_exact_dedup": exact_dedup.op7_exact_dedup,
    "op8_decontamination": decontamination.op8_decontamination,
    "op9_warc": warc.op9_warc,
    "op10_pii": pii.op10_pii,
    "op11_whitening": whitening.op11_whitening,
    "op12_lm_scoring": bloom_lm.op12_lm_scoring,
    "op13_alignment": alignment.op13_alignment,
}

ORACLES: dict[str, str] = {
    "op3_mix_sources": mixing.ORACLE,
    "op4_license_scan": license_scan.ORACLE,
    "op7_exact_dedup": exact_dedup.ORACLE,
    "op9_warc": warc.ORACLE,
}
