"""Registered queries and their SQL counterparts."""

from __future__ import annotations

import importlib
from pathlib import Path


def all_queries() -> None:
    """Import every query module, which registers its queries."""
    for path in sorted(Path(__file__).parent.glob("*_queries.py")):
        importlib.import_module(f"{__name__}.{path.stem}")
