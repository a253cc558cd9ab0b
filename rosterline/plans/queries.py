"""All queries of the library, and their SQL."""

from . import checks, diffs, documents, expressions, histories, outputs, reports, runs, streams  # noqa: F401
from .registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
