"""Registered queries: every operator applied to the driver tables, with SQL twins."""

from importlib import import_module

_MODULES = (
    "site_queries", "interval_queries", "cell_queries", "region_queries", "methylation_queries",
    "expression_queries", "embedding_queries", "source_queries", "route_queries",
)


def _registry():
    from cellspan.catalog.base import registry

    for name in _MODULES:
        import_module(f"cellspan.catalog.{name}")
    return registry


def queries():
    return dict(_registry().queries)


def oracle_sql():
    return dict(_registry().oracles)
