"""Registered queries, each next to the SQL it must agree with."""

from tagloom.plans.queries import (  # noqa: F401
    corpus_queries,
    metric_queries,
    predict_queries,
    prompt_queries,
    report_queries,
    split_queries,
    stream_queries,
)
from tagloom.plans.queries.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
