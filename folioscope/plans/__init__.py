"""The registered queries: ``queries()`` and ``oracle_sql()`` of the core."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import congress, identity, institutions, pages, registry, serving, surfaces, training

MODULES = [training, congress, institutions, identity, serving, surfaces, pages, registry]


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for m in MODULES for k, f in m.QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {k: s for m in MODULES for k, s in m.SQL.items()}
