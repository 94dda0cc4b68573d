"""All queries of the subpackage and their SQL."""

from __future__ import annotations

from gridsnap.llm import queries as q


def queries() -> dict:
    return dict(q.QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(q.SQL)
