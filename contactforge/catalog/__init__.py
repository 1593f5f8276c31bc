"""Registered queries with their SQL twins, built over the shared test tables."""
from __future__ import annotations


def _load():
    from . import assemblies, base, learning, relational, sequence, spatial, storage  # noqa: F401

    return base


def queries() -> dict:
    return dict(_load().QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(_load().SQL)
