"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.acceptance.registry import Query

LLM_QUERIES: dict[str, Query] = {}
LLM_ORACLES: dict[str, str] = {}


def llm_query(name: str, sql: str | None = None):
    def register(function: Query) -> Query:
        if name in LLM_QUERIES:
            raise ValueError(f"query {name} is registered twice")
        LLM_QUERIES[name] = function
        if sql is not None:
            LLM_ORACLES[name] = sql
        return function

    return register
