"""Registered queries: one Spark plan per operator of the inventory, with its DuckDB oracle.

Each query reads whole input tables from ``sf_dir`` (or data Spark derives from them) and
returns a DataFrame; ``oracle_sql`` gives the same result in DuckDB SQL over the same
parquet tables.  Array results are emitted as joined strings and counts as bigint so the
two engines hash identically.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

REGISTRY: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}


def _load_all() -> None:
    # Importing the plan modules registers their queries.
    from . import news, text_queries, models, events_queries, nodes_queries, stream_queries, feeds_queries  # noqa: F401
