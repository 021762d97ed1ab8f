"""Every query over the driver's tables, by name."""

from __future__ import annotations

import importlib

from tidemark.plans.registry import ORACLES, QUERIES, Query

_CATALOGS = ["cleaning", "reports", "features", "series", "mining", "scenarios", "drift", "models", "streams", "fits", "files"]


def _load() -> None:
    for name in _CATALOGS:
        importlib.import_module(f"tidemark.plans.catalog_{name}")


def queries() -> dict[str, Query]:
    _load()
    return dict(QUERIES)


def oracles() -> dict[str, str]:
    _load()
    return dict(ORACLES)
