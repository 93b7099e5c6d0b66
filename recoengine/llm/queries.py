"""Registered queries of this package and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from recoengine.llm import conversations, embeddings, html_text, language, minhash, mixing, packing, quality, resampling, sharding, substrings, suffixes, token_store

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    return {
        "op1_substring_dedup": substrings.op1_substring_dedup,
        "op2_embedding_dedup": embeddings.op2_embedding_dedup,
        "op3_pack": packing.op3_pack,
        "op4_mix_sources": mixing.op4_mix_sources,
        "op5_minhash_dedup": minhash.op5_minhash_dedup,
        "op6_token_store": token_store.op6_token_store,
        "op7_suffix_dedup": suffixes.op7_suffix_dedup,
        "op8_shard": sharding.op8_shard,
        "op9_language": language.op9_language,
        "op10_quality": quality.op10_quality,
        "op11_importance_resampling": resampling.op11_importance_resampling,
        "op12_conversation_repair": conversations.op12_conversation_repair,
        "op13_html_extraction": html_text.op13_html_extraction,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op1_substring_dedup": substrings.ORACLE,
        "op2_embedding_dedup": embeddings.ORACLE,
        "op4_mix_sources": mixing.ORACLE,
        "op5_minhash_dedup": minhash.ORACLE,
        "op11_importance_resampling": resampling.ORACLE,
    }
