"""Registry of named queries: each entry is a Spark builder ``(spark, sf_dir) ->
DataFrame`` plus, when the result can be written in SQL, the DuckDB oracle text.

Queries are registered by the ``plans.q_*`` modules; ``__spark_entry__`` exposes
them to the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    build: Builder
    sql: str | None
    ids: tuple[str, ...]  # SURVEY section 2 operator ids covered
    check: str            # E, T or R


REGISTRY: dict[str, Query] = {}


def register(name: str, ids, sql: str | None = None, check: str = "E"):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = Query(name, fn, sql, tuple(ids.split() if isinstance(ids, str) else ids), check)
        return fn
    return deco


def load_all() -> dict[str, Query]:
    from . import (q_cleanse, q_cycles, q_diagnose, q_entries, q_flow, q_geo, q_live,  # noqa: F401
                   q_inventory, q_models, q_moments, q_panel, q_profiles, q_sources, q_splits, q_timeparts, q_windows)
    return REGISTRY
