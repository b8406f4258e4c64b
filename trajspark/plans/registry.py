"""Named queries over the given tables, each with the SQL that defines its result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


# The adapters of ``trajspark.sources.adapters`` in SQL.
EVENTS = """ev AS (
  SELECT row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS f,
         dense_rank() OVER (ORDER BY user_id) - 1 AS e,
         row_number() OVER (ORDER BY user_id, ts, event_id) - 1 AS i,
         dense_rank() OVER (ORDER BY event_type) - 1 AS task_index,
         count(*) OVER (PARTITION BY user_id) AS n,
         date_diff('microsecond', min(ts) OVER (PARTITION BY user_id), ts) / 1e6 AS t,
         event_type AS task, value AS v, CAST(regexp_extract(props, '[0-9]+') AS DOUBLE) AS k, user_id
  FROM events),
fr AS (SELECT *, f = n - 1 AS is_last, (f = n - 1 OR task = 'error') AS done FROM ev)"""

LINES = """fr AS (
  SELECT row_number() OVER (PARTITION BY l_orderkey ORDER BY l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax) - 1 AS f,
         dense_rank() OVER (ORDER BY l_orderkey) - 1 AS e,
         row_number() OVER (ORDER BY l_orderkey, l_shipdate, l_linenumber, l_partkey, l_suppkey, l_quantity,
           l_extendedprice, l_discount, l_tax) - 1 AS i,
         dense_rank() OVER (ORDER BY l_returnflag || l_linestatus) - 1 AS task_index,
         count(*) OVER (PARTITION BY l_orderkey) AS n, l_returnflag || l_linestatus AS task, l_orderkey,
         l_quantity AS a0, l_extendedprice AS a1, l_discount AS a2, l_tax AS a3
  FROM lineitem)"""

CONV = """fr AS (
  SELECT row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS f, dense_rank() OVER (ORDER BY conv_id) - 1 AS e,
         row_number() OVER (ORDER BY conv_id, turn) - 1 AS i, dense_rank() OVER (ORDER BY role) - 1 AS task_index,
         count(*) OVER (PARTITION BY conv_id) AS n, role AS task, text, conv_id
  FROM conversations)"""


def uniform_sql(seed: int, *counters: str) -> str:
    """``hash_uniform`` in SQL."""
    text = " || ':' || ".join([f"'{seed}'", *(f"CAST({x} AS VARCHAR)" for x in counters)])
    return f"((CAST(CAST('0x' || substr(md5({text}), 1, 13) AS BIGINT) AS DOUBLE) + 0.5) / 4503599627370496.0)"
