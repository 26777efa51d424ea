"""The registered queries of the training-data operators."""

from __future__ import annotations

from plyspark.llm import ball_tree_search, exact_dedup, jaccard_join, lexical_search, mixing, packing, pii, quality_rules, quality_sites, substring_dedup, token_alignment, token_counts, toxicity

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_site_quality": quality_sites.op2_site_quality,
    "op3_quality_rules": quality_rules.op3_quality_rules,
    "op4_remove_repeats": substring_dedup.op4_remove_repeats,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_pii": pii.op6_pii,
    "op7_token_counts": token_counts.op7_token_counts,
    "op8_exact_dedup": exact_dedup.op8_exact_dedup,
    "op9_mix_sources": mixing.op9_mix_sources,
    "op10_pack_curve": packing.op10_pack_curve,
    "op11_token_alignment": token_alignment.op11_token_alignment,
    "op12_ball_tree_search": ball_tree_search.op12_ball_tree_search,
    "op13_lexical_search": lexical_search.op13_lexical_search,
}

ORACLE_SQL = {
    "op8_exact_dedup": exact_dedup.ORACLE_SQL,
    "op9_mix_sources": mixing.ORACLE_SQL,
    "op12_ball_tree_search": ball_tree_search.ORACLE_SQL,
    "op13_lexical_search": lexical_search.ORACLE_SQL,
}
