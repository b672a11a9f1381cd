"""Registered queries of the training-data operators and the SQL they must agree with."""

from __future__ import annotations

from textpulse.llm import (
    ann, chunks, conversations, langid, lexical, licenses, mixing, packing, quality, simhash, tokenfile, topk, toxicity)

QUERIES = {f.__name__: f for f in (
    topk.op1_exact_topk, simhash.op2_simhash_near_dedup, packing.op3_mixture_packing,
    tokenfile.op4_arrow_token_files, ann.op5_adaptive_ann,
    mixing.op6_mixture_raking, chunks.op7_substring_dedup, langid.op8_language_id, licenses.op9_license_scan, toxicity.op10_toxicity,
    conversations.op11_conversation_repair, quality.op12_quality_rules, lexical.op13_lexical_search,
)}
ORACLE_SQL = {
    "op1_exact_topk": topk.OP1_SQL, "op9_license_scan": licenses.OP9_SQL, "op11_conversation_repair": conversations.OP11_SQL,
    "op12_quality_rules": quality.OP12_SQL, "op13_lexical_search": lexical.OP13_SQL,
}
