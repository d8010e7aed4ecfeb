"""All queries and oracles of the core."""

from __future__ import annotations

from quern.operators import queries_gate, queries_hierarchy, queries_rows
from quern.streaming import queries_events

_MODULES = [queries_hierarchy, queries_rows, queries_gate, queries_events]

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}
