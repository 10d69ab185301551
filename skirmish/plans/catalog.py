"""Imports every query module so the registry is complete."""

from __future__ import annotations

from skirmish.plans import q_features, q_ingest, q_relational, q_rules, q_sources, q_windows  # noqa: F401
from skirmish.plans.registry import ORACLE, QUERIES

__all__ = ["QUERIES", "ORACLE"]
