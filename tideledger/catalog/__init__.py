"""Queries over the driver tables, each with the SQL that checks it."""

from __future__ import annotations

import importlib

MODULES = ("bridges", "flows", "quotes", "transfers", "routers", "settlement", "operators", "sources")


def load_all():
    """(queries by name, checking SQL by name)."""
    from . import registry

    for module in MODULES:
        importlib.import_module(f"{__name__}.{module}")
    return dict(registry.QUERIES), dict(registry.ORACLES)
