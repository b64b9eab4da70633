"""The numbered queries on the test tables and, where SQL can say the same, their checks."""

from __future__ import annotations

from importlib import import_module

MODULES = (
    "op1_mixing", "op2_toxicity", "op3_quality_rules", "op4_jaccard_join", "op5_quality_model", "op6_url_lists", "op7_bpe", "op8_pii", "op9_ann",
    "op10_substring_dedup", "op11_phrases", "op12_token_files", "op13_importance",
)


def queries() -> dict:
    found: dict = {}
    for name in MODULES:
        found.update(import_module(f"loglake.llm.queries.{name}").QUERIES)
    return found


def oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    for name in MODULES:
        found.update(getattr(import_module(f"loglake.llm.queries.{name}"), "ORACLES", {}))
    return found
