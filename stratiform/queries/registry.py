"""Registration of queries and access to the given tables."""

from __future__ import annotations

import importlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}
_ORACLES: dict[str, str] = {}
MODULES = ["checks", "shaping", "publishing", "runs", "monitoring", "metadata", "reading"]


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        _QUERIES[name] = fn
        if oracle is not None:
            _ORACLES[name] = oracle
        return fn

    return add


def load_all() -> None:
    for module in MODULES:
        importlib.import_module(f"stratiform.queries.{module}")


def queries() -> dict[str, Query]:
    load_all()
    return dict(_QUERIES)


def oracles() -> dict[str, str]:
    load_all()
    return dict(_ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
