"""The engine's own queries and the SQL that says what they return."""

from __future__ import annotations

from factloom.plans import annotation, corpus, facts, flow, joins, learning, live, web  # noqa: F401 - they register queries
from factloom.plans.base import QUERIES, SQL, Query


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
