"""Registered queries of the text-corpus operators and their DuckDB oracles."""

from __future__ import annotations

from . import (chat, decontaminate, exact_dedup, fill_middle, importance, language, licenses, near_dedup, packing, substring_dedup,
               suffix_dedup, tokens, toxicity)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_suffix_dedup": suffix_dedup.op3_suffix_dedup,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_language": language.op5_language,
    "op6_near_dedup": near_dedup.op6_near_dedup,
    "op7_token_counts": tokens.op7_token_counts,
    "op8_chat": chat.op8_chat,
    "op9_packing": packing.op9_packing,
    "op10_decontaminate": decontaminate.op10_decontaminate,
    "op11_substring_dedup": substring_dedup.op11_substring_dedup,
    "op12_importance": importance.op12_importance,
    "op13_fill_middle": fill_middle.op13_fill_middle,
}

#: The other queries' results are learned, tokenised or packed; tests hold them against brute force or round trips.
ORACLES = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op4_license_scan": licenses.ORACLE,
    "op8_chat": chat.ORACLE,
    "op10_decontaminate": decontaminate.ORACLE,
    "op11_substring_dedup": substring_dedup.ORACLE,
    "op13_fill_middle": fill_middle.ORACLE,
}
