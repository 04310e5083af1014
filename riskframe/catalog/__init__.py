"""Registered queries over the test tables, each with the SQL that must agree."""

from __future__ import annotations

from importlib import import_module

from riskframe.catalog.registry import ORACLES, QUERIES, Query

SECTIONS = ["cleaning", "features", "profiling", "evaluation", "governance", "monitoring", "serving", "streams", "models"]


def _load() -> None:
    for section in SECTIONS:
        import_module(f"riskframe.catalog.{section}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
