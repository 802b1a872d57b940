"""The queries of this subpackage and their SQL twins."""

from __future__ import annotations

from postlake.llm import bpe, decontaminate, filter_audit, line_dedup, lm, near_dup, packing, quality, secrets, spelling, token_files, topk, toxicity
from postlake.llm.common import Query

_MODULES = [secrets, lm, bpe, topk, near_dup, decontaminate, token_files, line_dedup, toxicity, quality, spelling, packing, filter_audit]
QUERIES: dict[str, Query] = {name: query for m in _MODULES for name, query in m.QUERIES.items()}
SQL: dict[str, str] = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
