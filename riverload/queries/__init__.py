"""The library's operators run on the test tables, with the same result as SQL."""

from __future__ import annotations

from riverload.queries import cleaning, loads, network, perimeter
from riverload.queries.registry import Query

_MODULES = (cleaning, network, loads, perimeter)


def all_queries() -> dict[str, Query]:
    return {name: q for m in _MODULES for name, q in m.registry.queries.items()}


def all_sql() -> dict[str, str]:
    return {name: q for m in _MODULES for name, q in m.registry.sql.items()}
