"""Names of the engine's queries and their oracles."""

from __future__ import annotations

from . import extension_queries, feed_queries, graph_queries, resolve_queries, search_queries, temporal_queries, text_queries

PARTS = (graph_queries, temporal_queries, text_queries, resolve_queries, search_queries, feed_queries, extension_queries)
QUERIES = {name: f for part in PARTS for name, f in part.QUERIES.items()}
ORACLES = {name: sql for part in PARTS for name, sql in part.ORACLES.items()}
