"""One query per operator over its whole table, and SQL for those that SQL can express."""

from __future__ import annotations

from basketlab.llm import (
    decontaminate,
    interpolated_lm,
    jaccard_join,
    line_crf,
    line_dedup,
    packing,
    personal_data,
    perspectives,
    prefix_trie,
    quality_rules,
    token_counts,
    wavelet,
    whitening,
)

LLM_QUERIES = {
    "op1_wavelet": wavelet.query,
    "op2_perspectives": perspectives.query,
    "op3_decontaminate": decontaminate.query,
    "op4_line_dedup": line_dedup.query,
    "op5_packing": packing.query,
    "op6_line_crf": line_crf.query,
    "op7_personal_data": personal_data.query,
    "op8_interpolated_lm": interpolated_lm.query,
    "op9_quality_rules": quality_rules.query,
    "op10_jaccard_join": jaccard_join.query,
    "op11_prefix_trie": prefix_trie.query,
    "op12_whitening": whitening.query,
    "op13_token_counts": token_counts.query,
}

LLM_ORACLES = {
    "op2_perspectives": perspectives.ORACLE_SQL,
    "op3_decontaminate": decontaminate.ORACLE_SQL,
    "op9_quality_rules": quality_rules.ORACLE_SQL,
    "op10_jaccard_join": jaccard_join.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
}
