"""Registered queries, one per operator or job, each with the SQL of its expected result."""

from __future__ import annotations

import importlib

from marketlens.catalog.registry import ORACLES, QUERIES

for _name in ("sources", "sinks", "filters", "joins", "aggregates", "scalars", "state", "jobs", "streams"):
    importlib.import_module(f"marketlens.catalog.{_name}")

__all__ = ["ORACLES", "QUERIES"]
