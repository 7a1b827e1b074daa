"""Registry of named queries: each has a Spark builder ``(spark, sf_dir) -> DataFrame`` and, where the
result is deterministic, an equivalent DuckDB SQL text over the same tables."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


@dataclass(frozen=True)
class Query:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str = ""


CATALOG: dict[str, Query] = {}


def register(name: str, sql: str | None = None, ids: str = ""):
    """Decorator: add a query builder under ``name`` with its oracle SQL (``None`` = rows-only)."""
    def deco(fn):
        if name in CATALOG:
            raise ValueError(f"duplicate query {name}")
        CATALOG[name] = Query(name, fn, sql.strip() if sql else None, ids)
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def r6(c, digits: int = 6) -> Column:
    """Round a double for comparison with the oracle (same digits in the SQL)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.cast("double"), digits)


def load_all() -> dict[str, Query]:
    """Import every query module so that their ``register`` calls run."""
    import importlib
    for mod in QUERY_MODULES:
        importlib.import_module(f"{__package__}.{mod}")
    return CATALOG


QUERY_MODULES = ["q_timeseries", "q_frame", "q_split", "q_metrics", "q_ensemble", "q_prepare", "q_io",
                 "q_vectors", "q_models"]
