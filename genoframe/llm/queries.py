"""The queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from . import bpe, chat, collocations, decontam, fingerprints, near_dup, pii, shards, substring, token_counts, toxicity, urls

QUERIES = {
    "op1_minhash_near_dedup": near_dup.query,
    "op2_weighted_fingerprints": fingerprints.query,
    "op3_toxicity": toxicity.query,
    "op4_bpe_round_trip": bpe.query,
    "op5_decontamination": decontam.query,
    "op6_substring_dedup": substring.query,
    "op7_token_rollup": token_counts.query,
    "op8_chat_round_trip": chat.query,
    "op9_url_filter": urls.query,
    "op10_hilbert_shards": shards.query,
    "op11_collocations": collocations.query,
    "op12_personal_data": pii.query,
}

#: None for op2, op3, op4, op10 and op12: samples, learned scores, token ids and curve cells are tested by brute force.
ORACLE_SQL = {
    "op1_minhash_near_dedup": near_dup.SQL,
    "op5_decontamination": decontam.SQL,
    "op6_substring_dedup": substring.SQL,
    "op7_token_rollup": token_counts.SQL,
    "op8_chat_round_trip": chat.SQL,
    "op9_url_filter": urls.SQL,
    "op11_collocations": collocations.SQL,
}
