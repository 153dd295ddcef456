"""The query catalogue: each entry applies operators to the driver's tables and has its SQL beside it."""

from __future__ import annotations

from hexapla.plans import checking, filing, media, merging, reporting, scores, sequences, texts, voting  # noqa: F401  they register their queries
from hexapla.plans.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
