"""Queries of this subpackage by name, each with its SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def load() -> tuple[dict[str, Query], dict[str, str]]:
    from importlib import import_module
    from pathlib import Path

    for path in sorted(Path(__file__).parent.glob("op*.py")):
        import_module(f"trajspark.llm.{path.stem}")
    import_module("trajspark.llm.pipeline_query")
    return QUERIES, ORACLES
