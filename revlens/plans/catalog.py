"""Registered queries: one per operator of the survey inventory.

Each entry is ``name -> (build(spark, sf_dir) -> DataFrame, oracle SQL or None)``.
The SQL is the same computation written for DuckDB over the raw tables; a
``None`` marks operators with no SQL equivalent (ML fits, sampled counts,
file-system facts), which get a rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

REGISTRY: dict[str, tuple[Builder, str | None]] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return deco


def _load_all() -> None:
    # Importing the modules fills REGISTRY.
    from . import (q_aggregate, q_clean, q_graph, q_io, q_ml, q_profile, q_sketch,  # noqa: F401
                   q_stats, q_stream, q_text)


def queries() -> dict[str, Builder]:
    _load_all()
    return {k: v[0] for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    _load_all()
    return {k: v[1] for k, v in REGISTRY.items() if v[1] is not None}
