"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from lexmill.llm import licenses, line_dedup, media, mixing, packing, quality, simhash, token_orc, toxicity, url_filter

QUERIES = {
    "op1_url_filter": url_filter.query,
    "op2_mpeg_audio": media.query,
    "op3_toxicity": toxicity.query,
    "op4_mixing": mixing.query,
    "op5_packing": packing.query,
    "op6_simhash": simhash.query,
    "op7_quality_rules": quality.query,
    "op8_token_orc": token_orc.query,
    "op9_licenses": licenses.query,
    "op10_line_dedup": line_dedup.query,
}

ORACLES = {
    "op1_url_filter": url_filter.oracle,
    "op4_mixing": mixing.oracle,
    "op7_quality_rules": quality.oracle,
    "op10_line_dedup": line_dedup.oracle,
}


def queries() -> dict:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {name: sql() for name, sql in ORACLES.items()}
