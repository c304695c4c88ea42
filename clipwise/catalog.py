"""Queries over the driver's tables by name, with their DuckDB SQL."""

from __future__ import annotations

from clipwise.plans import extended, measures, reports, signals, sounds, texts, timelines, tracks  # noqa: F401  each registers its queries
from clipwise.plans.base import ORACLE_SQL, QUERIES

__all__ = ["ORACLE_SQL", "QUERIES"]
