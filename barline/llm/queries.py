"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from barline.llm import ann, divergence, embedding_dedup, hard_negatives, mixing, ngram_join, packing, pipeline, rans, secrets, sharding, substring_dedup, token_counts, toxicity

QUERIES = {
    "op1_token_output": rans.query,
    "op2_toxicity": toxicity.query,
    "op3_nearest_neighbours": ann.query,
    "op4_sharding": sharding.query,
    "op5_packing": packing.query,
    "op6_embedding_dedup": embedding_dedup.query,
    "op6_planted_copies": embedding_dedup.planted_query,
    "op7_substring_dedup": substring_dedup.query,
    "op8_mixing": mixing.query,
    "op9_ngram_join": ngram_join.query,
    "op10_secrets": secrets.query,
    "op11_divergence": divergence.query,
    "op12_hard_negatives": hard_negatives.query,
    "op13_token_counts": token_counts.query,
    "pipeline": pipeline.run,
}

SQL = {
    "op6_embedding_dedup": embedding_dedup.SQL,
    "op6_planted_copies": embedding_dedup.PLANTED_SQL,
    "op8_mixing": mixing.SQL,
    "op11_divergence": divergence.SQL,
    "op12_hard_negatives": hard_negatives.SQL,
}
