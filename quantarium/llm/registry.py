"""Queries and SQL of the operators here, for __spark_entry__.py."""

from __future__ import annotations

import corpus_pipeline
from quantarium.llm import checks, decontaminate, html_text, language, lm_scoring, near_duplicates, packing, prefix_trie, quality, quotation, spelling, suffix_dedup, token_prefix, toxicity

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_quotation": quotation.op2_quotation,
    "op3_quality": quality.op3_quality,
    "op4_language": language.op4_language,
    "op5_suffix_dedup": suffix_dedup.op5_suffix_dedup,
    "op6_near_duplicates": near_duplicates.op6_near_duplicates,
    "op7_html_text": html_text.op7_html_text,
    "op8_lm_scoring": lm_scoring.op8_lm_scoring,
    "op9_token_counts": token_prefix.op9_token_counts,
    "op10_decontamination": decontaminate.op10_decontamination,
    "op11_toxicity": toxicity.op11_toxicity,
    "op12_prefix_trie": prefix_trie.op12_prefix_trie,
    "op13_spelling": spelling.op13_spelling,
    "pipeline": corpus_pipeline.run,
}

ORACLE_SQL: dict[str, str] = {
    "op3_quality": checks.QUALITY,
    "op6_near_duplicates": checks.NEAR_DUPLICATES,
    "op10_decontamination": checks.DECONTAMINATION,
}
