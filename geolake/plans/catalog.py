"""All registered queries."""

from . import document_queries, point_queries, search_queries, terrain_queries  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
