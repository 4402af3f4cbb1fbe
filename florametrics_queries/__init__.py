"""Every operator applied to the driver's tables, each with the SQL that checks it."""

from florametrics_queries.registry import ORACLES, QUERIES
from florametrics_queries import (  # noqa: F401  (importing registers)
    aggregate, analyses, column, diversity, files, genome, join, loading, order, scalar,
)

__all__ = ["ORACLES", "QUERIES"]
