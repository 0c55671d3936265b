"""Registered queries of the operators, with oracle SQL where SQL can say it."""

from __future__ import annotations

from strata.llm import (
    align, chat, decontaminate, language, licenses, lm, merkle, mixing, nearest, neardup, oracles,
    repeats, secrets, tokenfile)

QUERIES = {
    "op1_minhash_groups": neardup.query,
    "op2_language_id": language.query,
    "op3_license_scan": licenses.query,
    "op4_nearest": nearest.query,
    "op5_secret_scan": secrets.query,
    "op6_repeated_passages": repeats.query,
    "op7_mix_sources": mixing.query,
    "op8_token_file": tokenfile.query,
    "op9_lm_score": lm.query,
    "op10_decontaminate": decontaminate.query,
    "op11_align_tokens": align.query,
    "op12_merkle_manifest": merkle.query,
    "op13_chat_windows": chat.query,
}

ORACLE = {
    "op1_minhash_groups": oracles.near_duplicates(),
    "op3_license_scan": licenses.ORACLE,
    "op5_secret_scan": oracles.secrets(),
    "op6_repeated_passages": oracles.repeats(),
    "op7_mix_sources": mixing.ORACLE,
    "op10_decontaminate": oracles.decontaminate(),
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_chat_windows": chat.ORACLE,
}
