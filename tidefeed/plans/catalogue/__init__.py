"""Named queries over the test tables, each with the SQL that states its result where SQL can."""

from tidefeed.plans.catalogue import (
    aggregates,
    cleaning,
    formats,
    merges,
    rounds,
    routing,
    rows,
    validation,
)
from tidefeed.plans.catalogue.registry import ORACLES, QUERIES

__all__ = [
    "ORACLES",
    "QUERIES",
    "aggregates",
    "cleaning",
    "formats",
    "merges",
    "rounds",
    "routing",
    "rows",
    "validation",
]
