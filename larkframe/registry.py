"""Named queries: each has a DataFrame form and, where one can be written, independent SQL for checking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from larkframe.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register
