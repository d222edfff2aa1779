"""All queries of the corpus operators and their SQL."""

from __future__ import annotations

from capstream.llm import op1_topk, op2_decontaminate, op3_chat, op4_mixing, op5_simhash, op6_sharding, op7_repeats, op8_pii, op9_links, op10_toxicity

MODULES = (op1_topk, op2_decontaminate, op3_chat, op4_mixing, op5_simhash, op6_sharding, op7_repeats, op8_pii, op9_links, op10_toxicity)
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
ORACLE_SQL = {name: sql for module in MODULES for name, sql in module.ORACLE_SQL.items()}
