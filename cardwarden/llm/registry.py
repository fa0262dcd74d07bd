"""Queries of this package by name, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cardwarden.llm import cross_entropy, exact_dedup, jaccard_join, maxscore, merkle, mixing, packing, prefix_trie, quotations, secrets, sharding, token_files, toxicity


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quotation_linking": quotations.op1_quotation_linking,
        "op2_bayes_jaccard_join": jaccard_join.op2_bayes_jaccard_join,
        "op3_patricia_exact_dedup": exact_dedup.op3_patricia_exact_dedup,
        "op4_histogram_shards": sharding.op4_histogram_shards,
        "op5_maxscore_top_k": maxscore.op5_maxscore_top_k,
        "op6_recurrent_toxicity": toxicity.op6_recurrent_toxicity,
        "op7_cutting_stock_packing": packing.op7_cutting_stock_packing,
        "op8_fair_queue_mix": mixing.op8_fair_queue_mix,
        "op9_cross_entropy_difference": cross_entropy.op9_cross_entropy_difference,
        "op10_decoding_secret_scan": secrets.op10_decoding_secret_scan,
        "op11_merkle_climb": merkle.op11_merkle_climb,
        "op12_conversation_trie": prefix_trie.op12_conversation_trie,
        "op13_perfect_hash_tokens": token_files.op13_perfect_hash_tokens,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_patricia_exact_dedup": exact_dedup.ORACLE_SQL,
        "op5_maxscore_top_k": maxscore.ORACLE_SQL,
        "op8_fair_queue_mix": mixing.ORACLE_SQL,
        "op9_cross_entropy_difference": cross_entropy.ORACLE_SQL,
        "op11_merkle_climb": merkle.ORACLE_SQL,
        "op12_conversation_trie": prefix_trie.ORACLE_SQL,
    }
