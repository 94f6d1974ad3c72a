"""All registered queries."""

from . import scalar_queries  # noqa: F401, I001
from . import document_queries, source_queries, table_queries  # noqa: F401
from . import job_queries, scan_queries  # noqa: F401
from .registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
