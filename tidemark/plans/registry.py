"""Registry of the bound queries: a Spark callable and, where SQL can say it, an equivalent."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Run = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class BoundQuery:
    run: Run
    sql: str | None


REGISTRY: dict[str, BoundQuery] = {}


def query(name: str, sql: str | None = None) -> Callable[[Run], Run]:
    def register(run: Run) -> Run:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = BoundQuery(run, sql)
        return run

    return register
