"""The text queries and their SQL."""

from __future__ import annotations

import corpus_pipeline
from pricewright.llm import alignment, bpe, chat, exact, linededup, lm, mixing, packing, quality, runs, secrets, simhash, toxicity

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_quality_rules": quality.op2_quality_rules,
    "op3_exact_dedup": exact.op3_exact_dedup,
    "op4_secret_scan": secrets.op4_secret_scan,
    "op5_lm_score": lm.op5_lm_score,
    "op6_best_fit_packing": packing.op6_best_fit_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_chat_format": chat.op8_chat_format,
    "op9_mixing": mixing.op9_mixing,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op11_token_alignment": alignment.op11_token_alignment,
    "op12_byte_bpe": bpe.op12_byte_bpe,
    "op13_periodic_runs": runs.op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op2_quality_rules": quality.OP2_SQL,
    "op3_exact_dedup": exact.OP3_SQL,
    "op8_chat_format": chat.OP8_SQL,
    "op9_mixing": mixing.OP9_SQL,
}


def queries() -> dict:
    return QUERIES


def oracle_sql() -> dict[str, str]:
    return ORACLE
