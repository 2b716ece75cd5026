"""Registered queries and oracle SQL of this subpackage."""

from __future__ import annotations

from pitchside.llm import decontaminate, filter_audit, lines, mixture, near_dup, packing, periodic_runs, quality, records, secrets, substrings, suffix_array, url_filter

QUERIES = {
    "op1_decontaminate": decontaminate.op1_decontaminate,
    "op2_substring_dedup": substrings.op2_substring_dedup,
    "op3_near_duplicates": near_dup.op3_near_duplicates,
    "op4_line_dedup": lines.op4_line_dedup,
    "op5_url_reputation": url_filter.op5_url_reputation,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_suffix_array": suffix_array.op7_suffix_array,
    "op8_binary_records": records.op8_binary_records,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op10_quality_rules": quality.op10_quality_rules,
    "op11_periodic_runs": periodic_runs.op11_periodic_runs,
    "op12_mixture": mixture.op12_mixture,
    "op13_filter_audit": filter_audit.op13_filter_audit,
}
ORACLES = {
    "op1_decontaminate": decontaminate.OP1_SQL,
    "op2_substring_dedup": substrings.OP2_SQL,
    "op4_line_dedup": lines.OP4_SQL,
    "op5_url_reputation": url_filter.OP5_SQL,
    "op10_quality_rules": quality.OP10_SQL,
    "op12_mixture": mixture.OP12_SQL,
    "op13_filter_audit": filter_audit.OP13_SQL,
}
