"""Registered queries over the test tables and their SQL oracles."""

from __future__ import annotations

import importlib

MODULES = ("metric_queries", "text_queries", "source_queries")


def load():
    """Import every query module and return the registry."""
    for name in MODULES:
        importlib.import_module(f"checks.{name}")
    return importlib.import_module("checks.registry")
