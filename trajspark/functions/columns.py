"""Small column helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def c(name: str) -> Column:
    """Column by its exact name; names may hold ``.`` and ``/``."""
    return F.col(f"`{name}`")


def doubles(*values: float) -> Column:
    """Literal ``array<double>``."""
    return F.array(*[F.lit(float(v)) for v in values])


def block_of(order: Column, size: int) -> Column:
    """Number of the fixed-size block a dense position falls in."""
    return F.floor(order / F.lit(size)).cast("long")


def array_sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x)


def norm(values: Column) -> Column:
    """Euclidean length of an array column."""
    return F.sqrt(F.aggregate(values, F.lit(0.0), lambda acc, x: acc + x * x))


def vsub(left: Column, right: Column) -> Column:
    return F.zip_with(left, right, lambda x, y: x - y)


def hash_uniform(seed: int, *cols: Column) -> Column:
    """Uniform number in (0, 1) for a seed and whole-number counters: the same on every retry, and in every SQL engine.

    The first 13 hex digits of ``md5('seed:counter:…')`` are a 52-bit number v; the result is ``(v + 0.5) / 2^52``, exact in
    doubles. Null counters are left out.
    """
    counters = F.concat_ws(":", F.lit(str(seed)), *[x.cast("string") for x in cols])
    bits = F.conv(F.substring(F.md5(counters), 1, 13), 16, 10).cast("long")
    return (bits.cast("double") + F.lit(0.5)) / F.lit(float(1 << 52))


def is_numeric(df: DataFrame, name: str) -> bool:
    kind = dict(df.dtypes)[name]
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
