"""Composed plans and the registered queries with their SQL counterparts."""

from . import conversation_queries, generation_queries, relational_queries, source_queries, stream_queries, vector_queries
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "conversation_queries", "generation_queries", "relational_queries", "source_queries", "stream_queries", "vector_queries"]
