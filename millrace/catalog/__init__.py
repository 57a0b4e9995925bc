"""Every operator as a query over the test tables, with the same question in SQL."""

from millrace.catalog import (  # noqa: F401  (importing registers the queries)
    aggregates,
    cleaning,
    evaluation,
    features,
    files,
    lookups,
    pages,
    profiles,
    projections,
    sampling,
    training,
)
from millrace.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
