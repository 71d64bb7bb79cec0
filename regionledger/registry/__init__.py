"""Named queries over the provided tables, each with its SQL twin."""

from __future__ import annotations

import importlib

from regionledger.registry import core

_MODULES = ["scalars", "shapes", "combining", "measures", "plans", "checks", "files"]


def _load() -> None:
    for m in _MODULES:
        importlib.import_module(f"regionledger.registry.{m}")


def queries() -> dict[str, core.Query]:
    _load()
    return dict(core.QUERIES)


def oracle_sql() -> dict[str, str]:
    _load()
    return dict(core.ORACLE)
