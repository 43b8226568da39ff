"""Names, queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tablework.workload.fixtures import Fixtures, duck_views

Builder = Callable[[Fixtures], DataFrame]

_BUILDERS: dict[str, Builder] = {}
_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, views: tuple[str, ...] = ()) -> Callable[[Builder], Builder]:
    """Register a query; ``views`` are the fixture views its SQL twin starts from."""

    def register(build: Builder) -> Builder:
        if name in _BUILDERS:
            raise ValueError(f"query {name} registered twice")
        _BUILDERS[name] = build
        if sql is not None:
            _SQL[name] = duck_views(sql, views)
        return build

    return register


def _callable(build: Builder) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: build(Fixtures(spark, sf_dir))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: _callable(build) for name, build in sorted(_BUILDERS.items())}


def all_sql() -> dict[str, str]:
    return dict(sorted(_SQL.items()))
