"""Registered queries over the driver's tables."""

from __future__ import annotations

import importlib
import pkgutil

from .registry import QUERIES, SQL, Query


def _load() -> None:
    for m in pkgutil.iter_modules(__path__):
        if m.name.startswith("q_"):
            importlib.import_module(f"{__name__}.{m.name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(SQL)
