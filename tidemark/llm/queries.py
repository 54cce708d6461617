"""Registered queries of the corpus operators, and their DuckDB SQL."""

from __future__ import annotations

from tidemark.llm.collocations import OP11_SQL, op11_collocations
from tidemark.llm.decontam import op2_decontamination, op2_sql
from tidemark.llm.factors import OP13_SQL, op13_substring_dedup
from tidemark.llm.infill import OP12_SQL, op12_infill
from tidemark.llm.langid import op9_language_id
from tidemark.llm.lines import OP8_SQL, op8_line_dedup
from tidemark.llm.nearcopy import op4_near_copies
from tidemark.llm.pieces import op5_sentencepiece
from tidemark.llm.sharding import OP7_SQL, op7_sharding
from tidemark.llm.suffixes import OP10_SQL, op10_repeated_passages
from tidemark.llm.template import op6_html_text
from tidemark.llm.tokencount import op3_token_counts
from tidemark.llm.topk import OP1_SQL, op1_topk_search

QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_decontamination": op2_decontamination,
    "op3_token_counts": op3_token_counts,
    "op4_near_copies": op4_near_copies,
    "op5_sentencepiece": op5_sentencepiece,
    "op6_html_text": op6_html_text,
    "op7_sharding": op7_sharding,
    "op8_line_dedup": op8_line_dedup,
    "op9_language_id": op9_language_id,
    "op10_repeated_passages": op10_repeated_passages,
    "op11_collocations": op11_collocations,
    "op12_infill": op12_infill,
    "op13_substring_dedup": op13_substring_dedup,
}

ORACLE = {
    "op1_topk_search": OP1_SQL,
    "op2_decontamination": op2_sql(),
    "op7_sharding": OP7_SQL,
    "op8_line_dedup": OP8_SQL,
    "op10_repeated_passages": OP10_SQL,
    "op11_collocations": OP11_SQL,
    "op12_infill": OP12_SQL,
    "op13_substring_dedup": OP13_SQL,
}
