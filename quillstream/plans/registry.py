"""All queries of the core, by name."""

from __future__ import annotations

from . import corpus_queries, health_queries, vector_queries

FLAGSHIP = "vector_topk"
QUERIES = {**corpus_queries.QUERIES, **health_queries.QUERIES, **vector_queries.QUERIES}
SQL = {**corpus_queries.SQL, **health_queries.SQL, **vector_queries.SQL}
