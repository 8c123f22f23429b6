"""Importing this package registers every query."""

from quern.plans import (  # noqa: F401
    aggregates,
    curation,
    expressions,
    filters,
    graphs,
    joins,
    lint,
    matrices,
    profile,
    regression,
    sequences,
    sources,
    streams,
    workload,
)
from quern.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
