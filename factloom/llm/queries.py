"""Registered queries of the training-data operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from factloom.llm import chat_format, decontaminate, exact_dedup, html_extract, language_id, lm_score, near_dedup, negatives, packing, quality, secrets, token_file, whitening

QUERIES = {
    "op1_near_dedup": near_dedup.op1,
    "op2_language_id": language_id.op2,
    "op3_exact_dedup": exact_dedup.op3,
    "op4_secret_scan": secrets.op4,
    "op5_quality_classifier": quality.op5,
    "op6_lm_scoring": lm_score.op6,
    "op7_decontamination": decontaminate.op7,
    "op8_packing": packing.op8,
    "op9_chat_formatting": chat_format.op9,
    "op10_html_extraction": html_extract.op10,
    "op11_hard_negatives": negatives.op11,
    "op12_token_files": token_file.op12,
    "op13_whitening": whitening.op13,
}

ORACLES = {
    "op1_near_dedup": near_dedup.ORACLE,
    "op3_exact_dedup": exact_dedup.ORACLE,
    "op9_chat_formatting": chat_format.ORACLE,
    "op11_hard_negatives": negatives.ORACLE,
}
