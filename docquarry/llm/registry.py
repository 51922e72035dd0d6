"""The queries of this package and the SQL that checks them, by name."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docquarry.llm import chat, decontaminate, embeddings, licenses, line_dedup, minhash, mixing, pii, quality, toxicity

MODULES = {
    "op1_minhash": minhash,
    "op2_quality": quality,
    "op3_embeddings": embeddings,
    "op4_licenses": licenses,
    "op5_pii": pii,
    "op6_mixing": mixing,
    "op7_decontaminate": decontaminate,
    "op8_toxicity": toxicity,
    "op9_line_dedup": line_dedup,
    "op10_chat": chat,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: module.query for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: module.SQL for name, module in MODULES.items() if module.SQL}
