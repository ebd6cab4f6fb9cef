"""Registered queries over the benchmark tables, each with its check in SQL."""

from __future__ import annotations

from importlib import import_module

from cohortscore.catalog.registry import CHECKS, QUERIES

_MODULES = ("judging", "preparing", "modelling")


def registered():
    """(queries, checks) by name."""
    for name in _MODULES:
        import_module(f"cohortscore.catalog.{name}")
    return QUERIES, CHECKS
