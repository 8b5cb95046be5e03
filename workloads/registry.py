"""Collects each query with its SQL twin."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from workloads.standin import CTES, Tables

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None, *needs: str) -> Callable[[Callable[[Tables], DataFrame]], Callable]:
    """Register a function of the stand-in tables; ``sql`` may name any of the ``needs``."""

    def register(fn: Callable[[Tables], DataFrame]) -> Callable[[Tables], DataFrame]:
        if key in QUERIES:
            raise ValueError(f"{key} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(Tables(spark, sf_dir))

        run.__name__, run.__doc__ = key, fn.__doc__
        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = with_views(sql, needs)
        return fn

    return register


def with_views(sql: str, needs: tuple[str, ...]) -> str:
    """Put the needed stand-in views, and what they need, in front of ``sql``."""
    ordered: list[str] = []

    def add(name: str) -> None:
        if name in ordered:
            return
        requires, _ = CTES[name]
        for other in requires:
            add(other)
        ordered.append(name)

    for name in needs:
        add(name)
    if not ordered:
        return sql.strip()
    views = ",\n".join(f"{name} AS ({CTES[name][1].strip()})" for name in ordered)
    return f"WITH {views}\n{sql.strip()}"
