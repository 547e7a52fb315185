"""The registered queries, one per operator, each with its SQL twin where SQL can say it."""

from suite import (  # noqa: F401  (importing registers the cases)
    aggregates,
    documents,
    filters,
    joins,
    plans,
    projections,
    quality,
    scalars,
    scans,
    sets,
    transforms,
    windows,
)
from suite.registry import CASES, ORACLES

__all__ = ["CASES", "ORACLES"]
