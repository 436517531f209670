"""Registry of named queries: a Spark builder plus its DuckDB oracle twin."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable

from pyspark.sql import DataFrame

from tessera.oracle.adapter_sql import with_ctes


@dataclass
class Entry:
    name: str
    fn: Callable  # (Mart) -> DataFrame
    sql: str | None
    needs: tuple[str, ...]

    def oracle(self) -> str | None:
        return with_ctes(self.sql, *self.needs) if self.sql is not None else None


REGISTRY: dict[str, Entry] = {}


def query(name: str, sql: str | None = None, needs: tuple[str, ...] = ()):
    """Register ``fn(mart) -> DataFrame`` under ``name`` with its oracle SQL."""

    def deco(fn: Callable[..., DataFrame]):
        REGISTRY[name] = Entry(name, fn, sql, tuple(needs))
        return fn

    return deco
