"""The registered queries, each with the SQL that must give the same rows."""

from queries import io, mapping, quality, reconciling
from queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "io", "mapping", "quality", "reconciling"]
