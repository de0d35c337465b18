"""Queries of the training-data operators, each over its whole table, and their SQL where SQL can express them."""

from __future__ import annotations

from motolake.llm import ann, html, jaccard, language, licenses, media, mixing, packing, suffix_dedup, toxicity

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_toxicity": toxicity.op2_toxicity,
    "op3_media": media.op3_media,
    "op4_language": language.op4_language,
    "op5_html": html.op5_html,
    "op6_licenses": licenses.op6_licenses,
    "op7_mixing": mixing.op7_mixing,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_jaccard": jaccard.op9_jaccard,
    "op10_ann": ann.op10_ann,
}

ORACLE_SQL = {
    "op6_licenses": licenses.oracle_sql(),
    "op7_mixing": mixing.ORACLE_SQL,
    "op8_suffix_dedup": suffix_dedup.ORACLE_SQL,
    "op9_jaccard": jaccard.ORACLE_SQL,
}
