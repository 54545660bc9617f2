"""Named queries on the test tables, each with its SQL twin."""

from parcelflow.plans import (  # noqa: F401
    aggregates, cycle, documents, edges, enrichment, extraction, frontier, increments, scalars, streams,
)
from parcelflow.plans.registry import QUERIES, SQL

__all__ = ["QUERIES", "SQL"]
