"""The registered queries of the operators and their DuckDB twins (where SQL can express one)."""
from __future__ import annotations

from . import bpe, decontaminate, licenses, maintext, neardup, phrases, quality, substring, suffix, toxicity, treebpe, turns, warc


def queries() -> dict:
    return {
        "op1_bpe_codec": bpe.query,
        "op2_substring_dedup": substring.query,
        "op3_warc_bundles": warc.query,
        "op4_toxicity": toxicity.query,
        "op5_main_text": maintext.query,
        "op6_quality_rules": quality.query,
        "op7_minhash_near_dedup": neardup.query,
        "op8_benchmark_decontamination": decontaminate.query,
        "op9_suffix_dedup": suffix.query,
        "op10_license_scans": licenses.query,
        "op11_phrases": phrases.query,
        "op12_turn_repair": turns.query,
        "op13_tree_bpe": treebpe.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_warc_bundles": warc.ORACLE,
        "op6_quality_rules": quality.ORACLE,
        "op8_benchmark_decontamination": decontaminate.ORACLE,
        "op10_license_scans": licenses.oracle(),
        "op11_phrases": phrases.ORACLE,
    }
