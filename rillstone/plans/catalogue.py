"""All queries of the library's own operators and the SQL they are held against."""

from __future__ import annotations

from rillstone.plans import folds, groups, links, parsing, relations, sequences, streams, strings  # noqa: F401
from rillstone.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
