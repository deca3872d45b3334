"""The operators over the given tables, and the SQL that checks them where SQL can."""

from __future__ import annotations

from spinmart.llm.bpe import op2_bpe
from spinmart.llm.decontamination import op6_decontamination
from spinmart.llm.fill_in_middle import OP11_SQL, op11_fill_in_middle
from spinmart.llm.filter_audit import OP12_SQL, op12_filter_audit
from spinmart.llm.jaccard_join import op4_jaccard_join
from spinmart.llm.line_dedup import OP7_SQL, op7_line_dedup
from spinmart.llm.lm_scoring import op3_lm_scoring
from spinmart.llm.quality_classifier import op13_quality_classifier
from spinmart.llm.quality_rules import ABLATIONS_SQL, OP1_SQL, op1_quality_rules, quality_ablations
from spinmart.llm.sharding import op8_sharding
from spinmart.llm.substring_dedup import op10_substring_dedup
from spinmart.llm.url_filters import OP5_SQL, op5_url_filters
from spinmart.llm.warc import OP9_SQL, op9_warc_audit

LLM_QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_bpe": op2_bpe,
    "op3_lm_scoring": op3_lm_scoring,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_url_filters": op5_url_filters,
    "op6_decontamination": op6_decontamination,
    "op7_line_dedup": op7_line_dedup,
    "op8_sharding": op8_sharding,
    "op9_warc_audit": op9_warc_audit,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_filter_audit": op12_filter_audit,
    "op13_quality_classifier": op13_quality_classifier,
    "quality_ablations": quality_ablations,
}

LLM_SQL = {
    "op1_quality_rules": OP1_SQL,
    "op5_url_filters": OP5_SQL,
    "op7_line_dedup": OP7_SQL,
    "op9_warc_audit": OP9_SQL,
    "op11_fill_in_middle": OP11_SQL,
    "op12_filter_audit": OP12_SQL,
    "quality_ablations": ABLATIONS_SQL,
}
