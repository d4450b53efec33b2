"""Registered queries over the star-schema tables, each next to the SQL it must equal."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its independent statement for the same tables."""
    def add(fn: Query) -> Query:
        if name in REGISTRY:
            raise ValueError(f"query registered twice: {name}")
        REGISTRY[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return add


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def load_all() -> None:
    """Import every query module once."""
    from pitwise.queries import cleaning, cohorts, expressions, features, linkage, pointintime, profiles, quality, sources  # noqa: F401
