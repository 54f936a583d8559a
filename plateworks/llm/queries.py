"""The queries of this subpackage, by name, and the SQL that gives the same rows where there is one."""

from __future__ import annotations

from . import alignment, bm25, host_rules, langid, license_scan, mixing, near_dup, packing, paragraphs, pii, resampling, secret_scan, token_files

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_pii_surrogates": pii.op2_pii_surrogates,
    "op3_paragraphs": paragraphs.op3_paragraphs,
    "op4_mixing": mixing.op4_mixing,
    "op5_language_id": langid.op5_language_id,
    "llm_language_pages": langid.language_pages,
    "op6_bm25": bm25.op6_bm25,
    "op7_token_files": token_files.op7_token_files,
    "op8_host_rules": host_rules.op8_host_rules,
    "llm_host_pages": host_rules.host_pages,
    "op9_near_dup": near_dup.op9_near_dup,
    "op10_secret_scan": secret_scan.op10_secret_scan,
    "op11_importance_resampling": resampling.op11_importance_resampling,
    "op12_license_scan": license_scan.op12_license_scan,
    "op13_token_alignment": alignment.op13_token_alignment,
}
ORACLE_SQL: dict[str, str] = {"op6_bm25": bm25.OP6_SQL, "op8_host_rules": host_rules.OP8_SQL, "llm_host_pages": host_rules.PAGES_SQL, "op11_importance_resampling": resampling.OP11_SQL}
