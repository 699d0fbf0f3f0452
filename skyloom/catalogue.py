"""The registered queries of the imagery operators and their SQL oracles."""

from __future__ import annotations

from skyloom.plans.oracle import ORACLE_SQL
from skyloom.plans.queries import QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
