"""All queries of the engine proper."""

from __future__ import annotations

from . import cohort_queries, edge_queries, element_queries, source_queries, text_queries, vector_queries  # noqa: F401  they register themselves
from .registry import ORACLES, QUERIES  # noqa: F401
