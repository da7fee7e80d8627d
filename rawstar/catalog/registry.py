"""Named queries with their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """One module's queries: ``@reg.query("select ...")`` names them after the function."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def query(self, sql: str | None = None) -> Callable[[Query], Query]:
        def keep(fn: Query) -> Query:
            self.queries[fn.__name__] = fn
            if sql is not None:
                self.oracles[fn.__name__] = sql.strip()
            return fn

        return keep
