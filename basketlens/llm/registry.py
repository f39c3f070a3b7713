"""The corpus queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from basketlens.llm import (
    conversations, decontaminate, interplay, licenses, lines, mixing, quality, recompression, simhash, sketches, suffixes, toxicity, vectors,
)


def queries() -> dict:
    return {
        "op1_substring_dedup": recompression.op1_substring_dedup,
        "op2_line_dedup": lines.op2_line_dedup,
        "op3_quality": quality.op3_quality,
        "op4_simhash_near_dedup": simhash.op4_simhash_near_dedup,
        "op5_decontamination": decontaminate.op5_decontamination,
        "op6_license_scan": licenses.op6_license_scan,
        "op7_embedding_near_dedup": vectors.op7_embedding_near_dedup,
        "op8_source_mix": mixing.op8_source_mix,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_suffix_dedup": suffixes.op10_suffix_dedup,
        "op11_filter_audit": interplay.op11_filter_audit,
        "op12_conversation_repair": conversations.op12_conversation_repair,
        "op13_fingerprints": sketches.op13_fingerprints,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": recompression.OP1_SQL, "op2_line_dedup": lines.OP2_SQL, "op6_license_scan": licenses.OP6_SQL, "op7_embedding_near_dedup": vectors.OP7_SQL,
        "op8_source_mix": mixing.OP8_SQL,
        "op10_suffix_dedup": suffixes.OP10_SQL,
        "op11_filter_audit": interplay.OP11_SQL,
        "op12_conversation_repair": conversations.OP12_SQL,
    }
