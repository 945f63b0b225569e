"""The queries of the corpus operators and their SQL."""

from __future__ import annotations

from . import decontamination, jaccard_join, license_scan, line_dedup, mixing, quality_crf, quality_rules, substring_dedup, suffix_dedup, token_output

QUERIES = {
    "op1_token_output": token_output.op1_token_output,
    "op2_substring_dedup": substring_dedup.op2_substring_dedup,
    "op3_decontamination": decontamination.op3_decontamination,
    "op4_license_scan": license_scan.op4_license_scan,
    "op5_line_dedup": line_dedup.op5_line_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_quality_crf": quality_crf.op7_quality_crf,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_quality_rules": quality_rules.op9_quality_rules,
    "op10_jaccard_join": jaccard_join.op10_jaccard_join,
}
SQL = {
    "op3_decontamination": decontamination.SQL,
    "op6_mixing": mixing.SQL,
    "op9_quality_rules": quality_rules.SQL,
}
