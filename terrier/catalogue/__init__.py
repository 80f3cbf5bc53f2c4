"""Registered queries over the test tables."""

from __future__ import annotations

from importlib import import_module

MODULES = ("marts", "parsing", "analysis", "forecast", "io")


def _load() -> None:
    for name in MODULES:
        import_module(f"terrier.catalogue.{name}")


def all_queries():
    from terrier.catalogue.registry import QUERIES

    _load()
    return dict(QUERIES)


def all_oracles():
    from terrier.catalogue.registry import ORACLES

    _load()
    return dict(ORACLES)
