"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import op1_jaccard, op2_mix, op3_chat, op4_decontaminate, op5_tokens, op6_secrets, op7_quality, op8_url, op9_topk, op10_shard, op11_simhash, op12_resample, op13_search

QUERIES = {
    "op1_jaccard_join": op1_jaccard.op1_jaccard_join,
    "op2_mix": op2_mix.op2_mix,
    "op3_chat": op3_chat.op3_chat,
    "op4_decontaminate": op4_decontaminate.op4_decontaminate,
    "op5_tokens": op5_tokens.op5_tokens,
    "op6_secrets": op6_secrets.op6_secrets,
    "op7_quality": op7_quality.op7_quality,
    "op8_url_filter": op8_url.op8_url_filter,
    "op9_topk": op9_topk.op9_topk,
    "op10_shard": op10_shard.op10_shard,
    "op11_simhash": op11_simhash.op11_simhash,
    "op12_resample": op12_resample.op12_resample,
    "op13_search": op13_search.op13_search,
}

#: Where SQL can say it on whole tables.
ORACLE_SQL = {
    "op1_jaccard_join": op1_jaccard.ORACLE,
    "op2_mix": op2_mix.ORACLE,
    "op3_chat": op3_chat.ORACLE,
    "op4_decontaminate": op4_decontaminate.ORACLE,
    "op6_secrets": op6_secrets.ORACLE,
    "op8_url_filter": op8_url.ORACLE,
    "op9_topk": op9_topk.ORACLE,
    "op10_shard": op10_shard.ORACLE,
    "op11_simhash": op11_simhash.ORACLE,
    "op12_resample": op12_resample.ORACLE,
    "op13_search": op13_search.ORACLE,
}
