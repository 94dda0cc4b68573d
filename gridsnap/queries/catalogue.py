"""All core queries and their SQL."""

from __future__ import annotations

from gridsnap.queries import problems, reference


def queries() -> dict:
    return problems.QUERIES | reference.QUERIES


def oracle_sql() -> dict[str, str]:
    from gridsnap.queries import reference_sql

    return problems.SQL | reference_sql.SQL
