"""The subpackage's queries and their SQL."""

from __future__ import annotations

import importlib

#: Query name and module. A module has query(spark, sf_dir), and SQL where SQL can say it.
OPERATORS = {
    "op1_line_dedup": "line_dedup",
    "op2_best_fit_packing": "packing",
    "op3_language_id": "language_id",
    "op4_toxicity": "toxicity",
    "op5_simhash_near_dedup": "simhash",
    "op6_warc": "warc",
    "op7_document_fingerprints": "syncmers",
    "op8_token_counts": "token_counts",
    "op9_byte_bpe": "byte_bpe",
    "op10_exact_dedup": "exact_dedup",
}


def _module(name: str):
    return importlib.import_module(f"fleethealth.llm.{OPERATORS[name]}")


def queries() -> dict:
    return {name: _module(name).query for name in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {name: sql for name in OPERATORS if (sql := getattr(_module(name), "SQL", None))}
