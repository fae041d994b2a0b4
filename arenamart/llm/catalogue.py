"""Registered queries of the text operators, and the SQL for those that SQL can express."""

from __future__ import annotations

from arenamart.llm.decontaminate import OP4_SQL, op4_decontaminate
from arenamart.llm.html_extract import op10_html
from arenamart.llm.language import op1_language
from arenamart.llm.mixing import OP7_SQL, op7_mix
from arenamart.llm.near_dup import op2_near_dup
from arenamart.llm.personal_data import op13_personal_data
from arenamart.llm.quality_model import op6_quality
from arenamart.llm.quality_rules import op3_quality_rules
from arenamart.llm.sharding import op9_shard
from arenamart.llm.source_audit import OP12_SQL, op12_source_audit
from arenamart.llm.token_output import op8_tokens
from arenamart.llm.url_filter import OP5_SQL, op5_url_filter
from arenamart.llm.whitening import op11_whitening

QUERIES = {
    "op1_language": op1_language,
    "op2_near_dup": op2_near_dup,
    "op3_quality_rules": op3_quality_rules,
    "op4_decontaminate": op4_decontaminate,
    "op5_url_filter": op5_url_filter,
    "op6_quality": op6_quality,
    "op7_mix": op7_mix,
    "op8_tokens": op8_tokens,
    "op9_shard": op9_shard,
    "op10_html": op10_html,
    "op11_whitening": op11_whitening,
    "op12_source_audit": op12_source_audit,
    "op13_personal_data": op13_personal_data,
}
SQL = {
    "op4_decontaminate": OP4_SQL,
    "op5_url_filter": OP5_SQL,
    "op7_mix": OP7_SQL,
    "op12_source_audit": OP12_SQL,
}
