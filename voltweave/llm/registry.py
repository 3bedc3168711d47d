"""Queries of the operators of this subpackage, and their oracle SQL where SQL can express them."""

from . import ann, decontam, html_extract, license_scan, line_dedup, minhash, packing, quality, token_counts, toxicity

QUERIES = {
    "op1_minhash_dedup": minhash.op1_minhash_dedup,
    "op2_quality": quality.op2_quality,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_ann": ann.op4_ann,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_html_extract": html_extract.op6_html_extract,
    "op7_decontamination": decontam.op7_decontamination,
    "op8_license_scan": license_scan.op8_license_scan,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_packing": packing.op10_packing,
}
ORACLES = {"op7_decontamination": decontam.ORACLE, "op8_license_scan": license_scan.ORACLE, "op9_line_dedup": line_dedup.ORACLE}
