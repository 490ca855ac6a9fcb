"""Registered queries of the training-data operators and their DuckDB counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, dedup_exact, dedup_near, dedup_vector, html, langid, packing, pii, secrets, tokenbin


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_pii": pii.op1_pii,
        "op2_token_files": tokenbin.op2_token_files,
        "op3_secrets": secrets.op3_secrets,
        "op4_exact_dedup": dedup_exact.op4_exact_dedup,
        "op5_html": html.op5_html,
        "op6_bpe": bpe.op6_bpe,
        "op7_packing": packing.op7_packing,
        "op8_minhash": dedup_near.op8_minhash,
        "op9_language": langid.op9_language,
        "op10_vector_join": dedup_vector.op10_vector_join,
    }


def oracle_sql() -> dict[str, str]:
    return {"op4_exact_dedup": dedup_exact.ORACLE, "op8_minhash": dedup_near.ORACLE, "op10_vector_join": dedup_vector.ORACLE}
