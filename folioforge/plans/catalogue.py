"""All queries of the record operators, by name: the Spark function and its DuckDB text or None."""

from __future__ import annotations

from folioforge.plans import accounting_queries, call_queries, chain_queries, check_queries, file_queries, job_queries, line_queries, markup_queries, name_queries, nested_queries, page_queries, record_queries, registry_queries, source_queries, state_queries, stream_queries, text_queries, view_queries

_MODULES = (accounting_queries, call_queries, chain_queries, check_queries, file_queries, job_queries, line_queries, markup_queries, name_queries, nested_queries, page_queries, record_queries, registry_queries, source_queries, state_queries, stream_queries, text_queries, view_queries)
QUERIES = {name: query for module in _MODULES for name, query in module.QUERIES.items()}
