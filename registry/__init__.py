"""Queries over the driver tables, one module per area."""

from importlib import import_module

AREAS = ["profiling", "preparing", "clusters", "web", "models", "estimators"]


def _load():
    for area in AREAS:
        import_module(f"registry.{area}")
    from registry import base

    return base


def queries():
    return _load().QUERIES


def oracle_sql():
    return _load().SQL
