"""Operators of a training-data pipeline. Nothing else in the library imports this package."""

from llm import (
    backoff_automaton,
    circulant_minhash,
    config_packing,
    edit_decontamination,
    folded_lexicon,
    hard_negatives,
    host_reputation,
    language_id,
    mincut_extraction,
    ngram_jaccard,
    quality_trees,
    spelling_variants,
    suffix_merge,
)

QUERIES = {
    "op1_language_id": language_id.op1_language_id,
    "op2_quality_trees": quality_trees.op2_quality_trees,
    "op3_circulant_minhash": circulant_minhash.op3_circulant_minhash,
    "op4_backoff_automaton": backoff_automaton.op4_backoff_automaton,
    "op5_mincut_extraction": mincut_extraction.op5_mincut_extraction,
    "op6_edit_decontamination": edit_decontamination.op6_edit_decontamination,
    "op7_host_reputation": host_reputation.op7_host_reputation,
    "op8_config_packing": config_packing.op8_config_packing,
    "op9_folded_lexicon": folded_lexicon.op9_folded_lexicon,
    "op10_suffix_merge": suffix_merge.op10_suffix_merge,
    "op11_ngram_jaccard": ngram_jaccard.op11_ngram_jaccard,
    "op12_spelling_variants": spelling_variants.op12_spelling_variants,
    "op13_hard_negatives": hard_negatives.op13_hard_negatives,
}
ORACLES = {"op7_host_reputation": host_reputation.ORACLE, "op13_hard_negatives": hard_negatives.ORACLE}
