"""Bindings of the operators to the given tables, each with its oracle SQL."""

from __future__ import annotations

import importlib

MODULES = ["normalization", "relational", "matching", "places", "pricing", "recommending", "learning"]


def load_all():
    """The registry with every query module loaded."""
    for m in MODULES:
        importlib.import_module(f"waymark.plans.{m}")
    return importlib.import_module("waymark.plans.registry")
