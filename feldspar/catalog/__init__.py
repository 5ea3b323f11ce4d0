"""Runnable queries over the given tables, one or more per operator."""

from __future__ import annotations

from importlib import import_module

MODULES = ("tables", "encodings", "series", "texts", "quality", "models")


def load():
    """(queries, oracles) of all catalog modules."""
    from feldspar.catalog import base

    for m in MODULES:
        import_module(f"feldspar.catalog.{m}")
    return dict(base.QUERIES), dict(base.ORACLES)
