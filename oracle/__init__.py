"""DuckDB statements that check each registered query on the same tables."""

from __future__ import annotations

import importlib

from .base import compose

MODULES = ["events", "storage", "joins", "derived", "quality", "measures", "planning", "streams", "semantic"]


def statements() -> dict[str, str]:
    out: dict[str, str] = {}
    for name in MODULES:
        for key, sql in importlib.import_module(f"{__name__}.{name}").SQL.items():
            out[key] = compose(sql)
    return out
