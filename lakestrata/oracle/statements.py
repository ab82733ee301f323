"""All oracle statements, keyed like ``queries()``."""

from __future__ import annotations

from functools import lru_cache

from lakestrata.oracle.builder import Registry, base_registry
from lakestrata.oracle.gold_sql import register_gold
from lakestrata.oracle.ops_sql import register_ops


@lru_cache(maxsize=1)
def registry() -> Registry:
    r = base_registry()
    register_gold(r)
    register_ops(r)
    return r


def all_statements() -> dict[str, str]:
    from lakestrata.registry import build_queries

    r = registry()
    return {name: r.statement(name) for name in build_queries() if name in r.sql}
