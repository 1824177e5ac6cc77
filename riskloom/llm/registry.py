"""Queries of this subpackage and their DuckDB twins (where SQL expresses one)."""

from __future__ import annotations

from riskloom.llm.collocations import OP12_SQL, op12_collocations
from riskloom.llm.mixing import op6_temperature_mixing
from riskloom.llm.packing import op9_concat_and_cut
from riskloom.llm.quality_rules import op5_quality_rules
from riskloom.llm.sharding import op3_rendezvous
from riskloom.llm.simhash_dedup import op10_simhash
from riskloom.llm.substring_dedup import OP8_SQL, op8_substring_dedup
from riskloom.llm.suffix_tree_lm import op7_suffix_tree
from riskloom.llm.token_alignment import op13_token_alignment
from riskloom.llm.token_files import op1_token_files
from riskloom.llm.topk_search import op2_bm25_topk
from riskloom.llm.url_filter import op11_url_filter
from riskloom.llm.warc import OP4_SQL, op4_arc_to_warc

QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_bm25_topk": op2_bm25_topk,
    "op3_rendezvous": op3_rendezvous,
    "op4_arc_to_warc": op4_arc_to_warc,
    "op5_quality_rules": op5_quality_rules,
    "op6_temperature_mixing": op6_temperature_mixing,
    "op7_suffix_tree": op7_suffix_tree,
    "op8_substring_dedup": op8_substring_dedup,
    "op9_concat_and_cut": op9_concat_and_cut,
    "op10_simhash": op10_simhash,
    "op11_url_filter": op11_url_filter,
    "op12_collocations": op12_collocations,
    "op13_token_alignment": op13_token_alignment,
}

ORACLES = {
    "op4_arc_to_warc": OP4_SQL,
    "op8_substring_dedup": OP8_SQL,
    "op12_collocations": OP12_SQL,
}
