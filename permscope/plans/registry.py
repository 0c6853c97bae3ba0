"""Query registry: name -> (Spark plan builder, DuckDB oracle SQL).

Every catalogued query reads the driver's tables of ``sf_dir`` (through the
derived ACL estate of ``sources.fixtures``) and returns a DataFrame; the
oracle SQL computes the same result independently in DuckDB over the same
parquet views.  Column names are identical on both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from permscope.sources import fixtures as fx


@dataclass(frozen=True)
class QuerySpec:
    name: str
    build: Callable[[SparkSession, str], DataFrame]
    oracle: str | None
    section: str


REGISTRY: dict[str, QuerySpec] = {}


def register(name: str, section: str, oracle: str | None = None):
    def deco(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = QuerySpec(name, fn, oracle, section)
        return fn
    return deco


def with_ctes(body: str, recursive: bool = False, **ctes: str) -> str:
    """``WITH [RECURSIVE] name AS (sql), ... body`` for the oracle."""
    parts = [f"{k} AS (\n{v}\n)" for k, v in ctes.items()]
    return ("WITH RECURSIVE " if recursive else "WITH ") + ",\n".join(parts) + "\n" + body


def fixture_ctes(*names: str) -> dict[str, str]:
    """Oracle CTEs for the derived tables: aces, aces_b, shares, principals, edges, ..."""
    src = {
        "aces": lambda: fx.duck_ace_sql("a"),
        "aces_b": lambda: fx.duck_ace_sql("b"),
        "shares": fx.duck_shares_sql,
        "principals": lambda: fx.duck_principals_sql("a"),
        "principals_b": lambda: fx.duck_principals_sql("b"),
        "edges": lambda: fx.duck_edges_sql("a"),
        "edges_b": lambda: fx.duck_edges_sql("b"),
    }
    return {n: src[n]() for n in names}


def oracle(body: str, *fixtures: str, recursive: bool = False, **extra: str) -> str:
    ctes = fixture_ctes(*fixtures)
    ctes.update(extra)
    return with_ctes(body, recursive, **ctes)
