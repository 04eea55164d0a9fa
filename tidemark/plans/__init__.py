"""The registry of checked queries."""

import importlib

from tidemark.plans.registry import ORACLES, QUERIES

_MODULES = ("checked_reports", "checked_sources", "checked_profiles", "checked_charts", "checked_ml")


def _load():
    for name in _MODULES:
        importlib.import_module(f"tidemark.plans.{name}")


def all_queries():
    _load()
    return dict(QUERIES)


def all_oracles():
    _load()
    return dict(ORACLES)
