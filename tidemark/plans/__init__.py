"""Queries bound to the given tables, by family."""

from __future__ import annotations

from importlib import import_module

from tidemark.plans.registry import REGISTRY, BoundQuery

FAMILIES = (
    "relational",
    "scalars",
    "series",
    "sequences",
    "readiness",
    "sources",
    "clustering",
    "models",
    "streams",
)


def catalog() -> dict[str, BoundQuery]:
    for family in FAMILIES:
        import_module(f"tidemark.plans.{family}")
    return dict(REGISTRY)
