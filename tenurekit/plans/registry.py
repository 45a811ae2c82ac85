"""Registry of named queries over the driver tables and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}
# operator ids from the survey inventory each query covers
COVERS: dict[str, tuple[str, ...]] = {}


def register(name: str, sql: str | None = None, covers: tuple[str, ...] = ()):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        COVERS[name] = covers
        return fn
    return deco


def load_all() -> None:
    """Import every module that registers queries."""
    from . import q_panel, q_cohort, q_clean, q_careers, q_movement, q_describe  # noqa: F401
    from . import q_wiki, q_ranktests, q_models, q_streaming, q_io, q_extras, q_reports, q_landing, q_tenures, q_listings, q_fits  # noqa: F401
