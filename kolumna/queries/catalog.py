"""All registered queries and their SQL."""

from __future__ import annotations

from kolumna.queries import matching, pairs, profiling, storage

MODULES = [profiling, pairs, matching, storage]
QUERIES = {name: query for module in MODULES for name, query in module.QUERIES.items()}
SQL = {name: sql for module in MODULES for name, sql in module.SQL.items()}
