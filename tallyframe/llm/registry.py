"""Queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chat, exact_dedup, fingerprints, jaccard, language, licences, line_dedup, packing, search, suffix_dedup, toxicity, whitening, word_bpe

QUERIES = {
    "op1_ngram_jaccard": jaccard.query,
    "op2_license_scan": licences.query,
    "op3_chat_format": chat.query,
    "op4_suffix_dedup": suffix_dedup.query,
    "op5_exact_dedup": exact_dedup.query,
    "op6_packing": packing.query,
    "op7_toxicity": toxicity.query,
    "op8_fingerprints": fingerprints.query,
    "op9_language_id": language.query,
    "op10_word_bpe": word_bpe.query,
    "op11_line_dedup": line_dedup.query,
    "op12_ranked_search": search.query,
    "op13_whitening": whitening.query,
    "op1_ngram_links": jaccard.links_query,
}
SQL = {
    "op1_ngram_jaccard": jaccard.SQL,
    "op2_license_scan": licences.SQL,
    "op3_chat_format": chat.SQL,
    "op4_suffix_dedup": suffix_dedup.SQL,
    "op5_exact_dedup": exact_dedup.SQL,
    "op11_line_dedup": line_dedup.SQL,
    "op12_ranked_search": search.SQL,
}
