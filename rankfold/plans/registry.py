"""Registry of named queries and their DuckDB oracle SQL.

Each query is ``fn(spark, sf_dir) -> DataFrame`` built from the driver's
tables (through ``rankfold.sources.staging``).  The oracle SQL, when given, is
an independent formulation over the same parquet tables; queries whose result
SQL cannot express (model training, PCA, hashing with Spark's own hash) have
none and are checked by row count and by tests against brute force.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def r6(c: Column | str) -> Column:
    """Round to 6 decimals as double (both sides of every float comparison)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.round(col.cast("double"), 6) + F.lit(0.0)  # no negative zero


def load_all() -> None:
    # importing the catalog modules fills the registry
    from rankfold.plans import (catalog_build, catalog_core, catalog_encode, catalog_features,  # noqa: F401
                                catalog_files, catalog_learn, catalog_metrics, catalog_streaming,
                                catalog_vectors, catalog_wide)
