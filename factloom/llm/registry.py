"""The queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from . import chat, decontaminate, language, licenses, line_dedup, packing, quality, simhash, toxicity, warc

QUERIES = {
    "op1_warc_round_trip": warc.query,
    "op2_packing": packing.query,
    "op3_chat_quotation_linking": chat.query,
    "op4_simhash_near_dedup": simhash.query,
    "op5_decontamination": decontaminate.query,
    "op6_quality_rules": quality.query,
    "op7_license_scan": licenses.query,
    "op8_language_id": language.query,
    "op9_line_dedup": line_dedup.query,
    "op10_toxicity": toxicity.query,
}

ORACLES = {"op3_chat_quotation_linking": chat.ORACLE_SQL, "op7_license_scan": licenses.ORACLE_SQL}
