"""All registered queries."""

from . import (  # noqa: F401
    aggregate_queries,
    feature_queries,
    gain_queries,
    history_queries,
    model_queries,
    source_queries,
)
from .registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
