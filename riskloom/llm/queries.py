"""Queries of the operators and, where SQL can express them, the SQL that states the same result."""

from __future__ import annotations

from riskloom.llm import (
    curriculum,
    decontaminate,
    html_text,
    kmeans_tree,
    line_dedup,
    lm_score,
    periodic_runs,
    preference,
    quality,
    simhash,
    source_audit,
    syncmers,
    toxicity,
)

QUERIES = {
    "op1_syncmers": syncmers.op1_syncmers,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_html_text": html_text.op3_html_text,
    "op4_quality": quality.op4_quality,
    "op5_simhash": simhash.op5_simhash,
    "op6_preference": preference.op6_preference,
    "op7_curriculum": curriculum.op7_curriculum,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_lm_score": lm_score.op9_lm_score,
    "op10_line_dedup": line_dedup.op10_line_dedup,
    "op11_kmeans_tree": kmeans_tree.op11_kmeans_tree,
    "op12_source_audit": source_audit.op12_source_audit,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}
ORACLES = {
    "op6_preference": preference.OP6_SQL,
    "op7_curriculum": curriculum.OP7_SQL,
    "op8_decontaminate": decontaminate.OP8_SQL,
    "op10_line_dedup": line_dedup.OP10_SQL,
    "op12_source_audit": source_audit.OP12_SQL,
}
