"""Registered queries with their independent SQL counterparts."""

from importlib import import_module
from types import ModuleType

MODULES = ("q_dims", "q_graph", "q_facts", "q_activity", "q_patterns", "q_batch", "q_streaming", "q_experiments")


def load() -> ModuleType:
    """Import every query module and return the registry they filled."""
    for name in MODULES:
        import_module(f"ledgerline.catalog.{name}")
    return import_module("ledgerline.catalog.registry")
