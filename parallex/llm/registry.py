"""Queries of the training-data operators and the SQL that checks them."""

from __future__ import annotations

from parallex.llm import (
    conversation_trie,
    decontaminate,
    html_extract,
    line_dedup,
    lm_scoring,
    merkle,
    mixing,
    packing,
    quality_rules,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
)

QUERIES = {
    "op1_substring_dedup": substring_dedup.op1_substring_dedup,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_sharding": sharding.op3_sharding,
    "op4_quality_rules": quality_rules.op4_quality_rules,
    "op5_mixing": mixing.op5_mixing,
    "op6_html_extract": html_extract.op6_html_extract,
    "op7_lm_scoring": lm_scoring.op7_lm_scoring,
    "op8_suffix_array_dedup": suffix_dedup.op8_suffix_array_dedup,
    "op9_simhash": simhash.op9_simhash,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_conversation_trie": conversation_trie.op11_conversation_trie,
    "op12_merkle_manifest": merkle.op12_merkle_manifest,
    "op13_packing": packing.op13_packing,
}
ORACLE = {
    "op1_substring_dedup": substring_dedup.ORACLE,
    "op8_suffix_array_dedup": suffix_dedup.ORACLE,
    "op2_line_dedup": line_dedup.ORACLE,
    "op4_quality_rules": quality_rules.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_conversation_trie": conversation_trie.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
}
