"""Queries of the text operators and their DuckDB twins, by name."""

from __future__ import annotations

from cabflow.llm import chat_format as op9
from cabflow.llm import decontaminate as op10
from cabflow.llm import hard_negatives as op12
from cabflow.llm import html_extract as op6
from cabflow.llm import importance as op11
from cabflow.llm import mix_sources as op5
from cabflow.llm import near_dedup as op8
from cabflow.llm import pii as op1
from cabflow.llm import quality_rules as op4
from cabflow.llm import secret_scan as op7
from cabflow.llm import substring_dedup as op13
from cabflow.llm import suffix_dedup as op2
from cabflow.llm import toxicity as op3

# name -> (query, twin or None where SQL cannot express the operator)
QUERIES = {
    "op1_pii": (op1.op1_pii, None),
    "op2_suffix_dedup": (op2.op2_suffix_dedup, None),
    "op3_toxicity": (op3.op3_toxicity, None),
    "op4_quality_rules": (op4.op4_quality_rules, None),
    "op5_mix_sources": (op5.op5_mix_sources, op5.OP5_SQL),
    "op6_html_extract": (op6.op6_html_extract, None),
    "op7_secret_scan": (op7.op7_secret_scan, None),
    "op8_near_dedup": (op8.op8_near_dedup, op8.OP8_SQL),
    "op9_chat_format": (op9.op9_chat_format, op9.OP9_SQL),
    "op10_decontaminate": (op10.op10_decontaminate, op10.OP10_SQL),
    "op11_importance": (op11.op11_importance, op11.OP11_SQL),
    "op12_hard_negatives": (op12.op12_hard_negatives, op12.OP12_SQL),
    "op13_substring_dedup": (op13.op13_substring_dedup, op13.OP13_SQL),
}
