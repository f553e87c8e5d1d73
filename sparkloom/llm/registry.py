"""The queries of this package, by name."""

from __future__ import annotations

from . import anisotropic, cover_tree, hmm, html_text, jaccard, language, mixing, packing, pii, resharding

QUERIES = {
    "op10_hmm_scoring": hmm.op10_hmm_scoring,
    "op1_best_fit_packing": packing.op1_best_fit_packing,
    "op2_embedding_near_dedup": cover_tree.op2_embedding_near_dedup,
    "op3_personal_data": pii.op3_personal_data,
    "op4_nearest_neighbours": anisotropic.op4_nearest_neighbours,
    "op5_language_id": language.op5_language_id,
    "op6_ngram_jaccard": jaccard.op6_ngram_jaccard,
    "op7_resharding": resharding.op7_resharding,
    "op8_html_extraction": html_text.op8_html_extraction,
    "op9_entropy_mixing": mixing.op9_entropy_mixing,
}

ORACLES: dict[str, str] = {}
