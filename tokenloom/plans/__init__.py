"""All registered queries and their check SQL."""

from .registry import ORACLES, QUERIES
from . import aggregates, files, joins, predicates, scores, sequences, strings, subwords, treequeries, windows  # noqa: F401  (importing registers the queries)

__all__ = ["ORACLES", "QUERIES"]
