"""Names of queries with their Spark form and, where there is one, their SQL form."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None):
    def register(build: Build) -> Build:
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Entry(build, sql)
        return build
    return register
