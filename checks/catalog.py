"""Every registered query."""

from checks import (  # noqa: F401
    q_batches,
    q_clean,
    q_enrich,
    q_flow,
    q_headers,
    q_io,
    q_kpi,
    q_structure,
    q_text,
    q_values,
)
from checks.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
