"""Named queries of this package, and their SQL where SQL can express them."""

from __future__ import annotations

from pulseforge.llm import (
    balltree, fingerprint, hard_negatives, langid, main_text, mixing, neighbours, packing, ranked, repeats, similar, sql, token_counts, toxicity,
)

QUERIES = {
    "op1_token_length_histogram": token_counts.op1_token_length_histogram,
    "op2_language_id": langid.op2_language_id,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op7_ngram_jaccard_join": similar.op7_ngram_jaccard_join,
    "op8_substring_dedup": repeats.op8_substring_dedup,
    "op9_merkle_fingerprints": fingerprint.op9_merkle_fingerprints,
    "op10_graph_neighbours": neighbours.op10_graph_neighbours,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_main_text": main_text.op6_main_text,
    "op4_mix_sources": mixing.op4_mix_sources,
    "op11_ranked_search": ranked.op11_ranked_search,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_ball_tree_search": balltree.op13_ball_tree_search,
}

ORACLE = {
    "op4_mix_sources": sql.MIX,
    "op7_ngram_jaccard_join": sql.SIMILAR,
    "op8_substring_dedup": sql.REPEATS,
    "op9_merkle_fingerprints": sql.MERKLE,
    "op11_ranked_search": sql.RANKED,
    "op12_hard_negatives": sql.NEGATIVES,
    "op13_ball_tree_search": sql.HIGHEST,
}
