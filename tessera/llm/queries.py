"""The queries of this folder and the SQL that checks them, by name."""

from __future__ import annotations

import importlib

_MODULES = {
    "op1_mix_sources": "mixing",
    "op2_lm_score": "lm_scoring",
    "op3_decontaminate": "decontaminate",
    "op4_shard": "sharding",
    "op5_language_id": "language_id",
    "op6_near_dedup": "near_dedup",
    "op7_toxicity": "toxicity",
    "op8_html_text": "html_text",
    "op9_fingerprints": "fingerprints",
    "op10_line_dedup": "line_dedup",
}


# Read here, so that whoever imports this module learns at once if a part is missing.
_FOUND = {name: importlib.import_module(f"{__package__}.{m}") for name, m in _MODULES.items()}


def queries() -> dict:
    return {name: getattr(m, name) for name, m in _FOUND.items()}


def oracle_sql() -> dict:
    found = {name: getattr(m, "ORACLE_SQL", None) for name, m in _FOUND.items()}
    return {name: sql for name, sql in found.items() if sql}
