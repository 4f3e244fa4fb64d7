"""Query name -> (query, oracle SQL), gathered from the plan modules."""

from __future__ import annotations

from .plans import feeds, games, intake, quality, scalars, seasons, stores, texts

MODULES = (scalars, games, seasons, quality, texts, feeds, stores, intake)
QUERIES = {name: q for m in MODULES for name, q in m.Q.queries.items()}
SQL: dict[str, str] = {name: s for m in MODULES for name, s in m.Q.sql.items()}
