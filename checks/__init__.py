"""Registered queries on the given tables, each with the SQL that must agree with it."""

from importlib import import_module

AREAS = ["audit", "text", "quality", "merging", "migration", "routes", "files"]


def _areas():
    return [import_module(f"checks.{name}") for name in AREAS]


def all_queries():
    return {k: v for area in _areas() for k, v in area.QUERIES.items()}


def all_sql():
    return {k: v for area in _areas() for k, v in area.ORACLE.items()}
