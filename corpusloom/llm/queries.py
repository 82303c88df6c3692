"""The queries op1_ to op13_, each over its whole table with production parameters."""

from __future__ import annotations

from corpusloom.llm import bpe, chat, decontamination, divergence, features, jaccard, langid, maxent, media, mincut, mixing, quality, toxicity

QUERIES = {
    "op1_matroska": media.query,
    "op2_maxent": maxent.query,
    "op3_quality": quality.query,
    "op4_decontamination": decontamination.query,
    "op5_langid": langid.query,
    "op6_mincut": mincut.query,
    "op7_toxicity": toxicity.query,
    "op8_bpe": bpe.query,
    "op9_chat": chat.query,
    "op10_jaccard": jaccard.query,
    "op11_divergence": divergence.query,
    "op12_features": features.query,
    "op13_mixing": mixing.query,
}
ORACLES = {
    "op9_chat": chat.ORACLE_SQL,
    "op4_decontamination": decontamination.ORACLE_SQL,
    "op11_divergence": divergence.ORACLE_SQL,
    "op12_features": features.ORACLE_SQL,
}
