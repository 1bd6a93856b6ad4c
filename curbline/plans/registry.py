"""Every registered query: a Spark plan and, where SQL can say the same, an oracle."""

from __future__ import annotations

import importlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None
    covers: str = ""


QUERIES: dict[str, Query] = {}


def register(name: str, sql: str | None = None, covers: str = ""):
    """Decorator: adds a ``(spark, sf_dir) -> DataFrame`` function under ``name``."""

    def add(f):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(f, sql, covers)
        return f

    return add


for _module in ("timeseries", "relational", "scalars", "traffic", "network", "spatial", "loading", "summaries"):
    importlib.import_module(f"curbline.plans.{_module}")
