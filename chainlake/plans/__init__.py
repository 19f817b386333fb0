"""Registered queries, grouped as in the survey."""

from importlib import import_module

GROUPS = [
    "scalars", "transport", "layouts", "projections", "lookups", "aggregates", "windows",
    "streams", "series",
]


def load():
    """The registry with all groups registered."""
    for group in GROUPS:
        import_module(f"chainlake.plans.{group}")
    return import_module("chainlake.plans.registry")
