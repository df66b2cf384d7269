"""All queries and oracles by name."""

from __future__ import annotations

from harness import checking, conforming, edges, staging, storing

MODULES = [conforming, storing, staging, checking, edges]

QUERIES = {name: function for module in MODULES for name, function in module.QUERIES.items()}
ORACLES = {name: sql for module in MODULES for name, sql in module.ORACLES.items()}
