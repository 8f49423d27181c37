"""The queries of this package and, where SQL can express them, their SQL for DuckDB."""

from __future__ import annotations

from tidemart.llm import (
    alignment, exact_search, hmm, hosts, html, minhash, mixing, packing, permutations, quality, toxicity, vector_codes,
    wavelet,
)

QUERIES = {
    "op1_hidden_markov_scores": hmm.op1_hidden_markov_scores,
    "op2_toxicity_severity": toxicity.op2_toxicity_severity,
    "op3_best_fit_packing": packing.op3_best_fit_packing,
    "op4_quality_cotraining": quality.op4_quality_cotraining,
    "op5_host_reputation": hosts.op5_host_reputation,
    "op6_minhash_dedup": minhash.op6_minhash_dedup,
    "op7_dom_boosting": html.op7_dom_boosting,
    "op8_pivot_distance_topk": exact_search.op8_pivot_distance_topk,
    "op9_permutation_index": permutations.op9_permutation_index,
    "op10_source_mixing": mixing.op10_source_mixing,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_token_alignment": alignment.op12_token_alignment,
    "op13_wavelet_tokens": wavelet.op13_wavelet_tokens,
}

SQL = {
    "op5_host_reputation": hosts.SQL,
    "op8_pivot_distance_topk": exact_search.SQL,
    "op10_source_mixing": mixing.SQL,
    "op11_vector_codes": vector_codes.SQL,
}
