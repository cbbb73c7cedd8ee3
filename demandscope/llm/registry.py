"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import decontaminate, html_extract, licenses, mixing, pii, quality_classifier, quality_rules, simhash_dedup, token_counts, token_ids


def queries() -> dict:
    return {
        "op1_quality_rules": quality_rules.op1_quality_rules,
        "op2_pii": pii.op2_pii,
        "op3_token_ids": token_ids.op3_token_ids,
        "op4_html_extract": html_extract.op4_html_extract,
        "op5_token_counts": token_counts.op5_token_counts,
        "op6_license_scan": licenses.op6_license_scan,
        "op7_simhash_dedup": simhash_dedup.op7_simhash_dedup,
        "op8_mix_sources": mixing.op8_mix_sources,
        "op9_quality_classifier": quality_classifier.op9_quality_classifier,
        "op10_decontaminate": decontaminate.op10_decontaminate,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_quality_rules": quality_rules.SQL, "op8_mix_sources": mixing.SQL}
