"""Registered, checkable queries over the driver tables."""

from __future__ import annotations


def all_queries():
    from kiln.catalog import core, edges, models  # noqa: F401  (registration on import)
    from kiln.catalog.registry import QUERIES
    return dict(QUERIES)


def all_oracle_sql():
    from kiln.catalog import core, edges, models  # noqa: F401
    from kiln.catalog.registry import ORACLE
    return dict(ORACLE)
