"""Queries of the library bound to the driver's tables."""

from __future__ import annotations

import importlib
import pkgutil

from ospara.plans.base import REGISTRY, Plan


def load_all() -> dict[str, Plan]:
    for module in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{module.name}")
    return dict(sorted(REGISTRY.items()))
