"""Registered test queries: one key per operator id, each with its DuckDB SQL.

Every query reads the driver tables (or data Spark derives from them) in
full; small inline tables appear only as parameters (rules, mappings).
"""

from __future__ import annotations

import importlib
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}

MODULES = ("flagship", "q_prepare", "q_joins", "q_aggregate", "q_window", "q_ordering", "q_setops",
           "q_functions", "q_excel", "q_sources", "q_quality", "q_stats", "q_models", "q_search", "q_patterns")


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn

    return deco


def as_double(df: DataFrame, *cols: str) -> DataFrame:
    """Integer columns that can hold nulls, as double.

    Result comparison goes through pandas, where a nullable integer column
    becomes float64 on one engine and Int64 on the other; double on both
    sides keeps the comparison about values.
    """
    return df.withColumns({c: df[c].cast("double") for c in cols})


def load_all() -> None:
    for m in MODULES:
        try:
            importlib.import_module(f"{__name__}.{m}")
        except ModuleNotFoundError as e:
            if e.name != f"{__name__}.{m}":
                raise
