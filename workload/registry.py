"""Register of queries: Spark callable, reference SQL and the operators covered."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from .tables import Bound
from .views import VIEWS, with_views


@dataclass(frozen=True)
class Query:
    name: str
    covers: tuple[str, ...]
    run: Callable[[Bound], DataFrame]
    sql: str | None

    def __call__(self, spark: SparkSession, folder: str) -> DataFrame:
        return self.run(Bound(spark, folder))


QUERIES: dict[str, Query] = {}


def query(
    name: str, covers: str, sql: str | None, run: Callable[[Bound], DataFrame], views: dict[str, str] = VIEWS
) -> None:
    if name in QUERIES:
        raise ValueError(f"query {name} is registered twice")
    QUERIES[name] = Query(name, tuple(covers.split()), run, with_views(sql, views) if sql else None)
