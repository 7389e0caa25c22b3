"""Registered queries of this package, and the DuckDB SQL of those that SQL can express."""

from salaria.llm import (best_position, exact_dedup, jaccard_join, language_id, learned_partitions, mixing, mtree, pieces,
                         pii, sharding, token_shards, toxicity, variants)

QUERIES = {
    "op1_source_mixing": mixing.op1_source_mixing,
    "op2_stratified_sharding": sharding.op2_stratified_sharding,
    "op3_toxicity": toxicity.op3_toxicity,
    "op4_language_id": language_id.op4_language_id,
    "op5_sentencepiece": pieces.op5_sentencepiece,
    "op6_exact_topk": mtree.op6_exact_topk,
    "op7_pii_spans": pii.op7_pii_spans,
    "op8_repair_token_shards": token_shards.op8_repair_token_shards,
    "op9_exact_dedup": exact_dedup.op9_exact_dedup,
    "op10_ngram_jaccard_join": jaccard_join.op10_ngram_jaccard_join,
    "op11_learned_partitions": learned_partitions.op11_learned_partitions,
    "op12_best_position_search": best_position.op12_best_position_search,
    "op13_spelling_variants": variants.op13_spelling_variants,
}

ORACLE_SQL = {"op6_exact_topk": mtree.ORACLE, "op9_exact_dedup": exact_dedup.ORACLE, "op12_best_position_search": best_position.ORACLE}
