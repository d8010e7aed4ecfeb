"""All queries and oracles of the subpackage."""

from __future__ import annotations

from quern.llm import queries_p1, queries_p2, queries_p3, queries_p5, queries_p6, queries_p7, queries_p8, queries_p9

_MODULES = [queries_p1, queries_p2, queries_p3, queries_p5, queries_p6, queries_p7, queries_p8, queries_p9]

QUERIES = {k: f for m in _MODULES for k, f in m.QUERIES.items()}
ORACLES = {k: s for m in _MODULES for k, s in m.ORACLES.items()}
