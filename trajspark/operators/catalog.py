"""Clip catalogs: listing, de-duplication, updates and profiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.functions.columns import c
from trajspark.functions.text import file_stem
from trajspark.operators.packing import path_range


def clip_id(df: DataFrame) -> Column:
    """``id`` without blanks around it, or the file stem of ``path`` when it is null or blank."""
    raw = F.trim(c("id").cast("string")) if "id" in df.columns else F.lit(None).cast("string")
    return F.when(raw.isNull() | (raw == ""), file_stem(F.coalesce(c("path"), F.lit("")))).otherwise(raw)


def dedupe_catalog(df: DataFrame) -> DataFrame:
    """First row in path order per ``path``, then per clip id.

    Both steps keep the row with the smallest key by an aggregate that combines on the map side, so a clip id shared by a
    large part of the table is not collected. Where a path repeats with different ids, the row with the smallest clip id
    stands for the path.
    """
    row = F.struct(*[c(n) for n in df.columns])
    keyed = df.select(F.coalesce(c("path"), F.lit("")).alias("_path"), clip_id(df).alias("_id"), row.alias("_row"))
    per_path = keyed.groupBy("_path").agg(F.min_by(F.struct("_id", "_row"), "_id").alias("_k"))
    per_id = per_path.groupBy(F.col("_k._id").alias("_id")).agg(F.min_by(F.col("_k._row"), "_path").alias("_r"))
    return per_id.select("_r.*")


def read_catalog(
    df: DataFrame,
    partition: str | None = None,
    dataset_name: str | None = None,
    path_gte: str | None = None,
    path_lt: str | None = None,
    not_null: Sequence[str] = (),
    is_null: Sequence[str] = (),
    limit: int | None = None,
    select: Sequence[str] | None = None,
) -> DataFrame:
    """Filtered, de-duplicated listing in path order; range and equality predicates reach the scan."""
    if limit is not None and limit <= 0:
        raise ValueError("limit must be positive")
    out = filter_catalog(df, partition, dataset_name, path_gte, path_lt, not_null, is_null)
    out = dedupe_catalog(out).orderBy("path")
    if limit is not None:
        out = out.limit(limit)
    return out if select is None else out.select(*[c(n) for n in select])


def filter_catalog(
    df: DataFrame,
    partition: str | None = None,
    dataset_name: str | None = None,
    path_gte: str | None = None,
    path_lt: str | None = None,
    not_null: Sequence[str] = (),
    is_null: Sequence[str] = (),
) -> DataFrame:
    out = path_range(df, "path", path_gte, path_lt)
    if partition:
        out = out.filter(c("partition") == partition)
    if dataset_name:
        out = out.filter(c("dataset_name") == dataset_name)
    for name in not_null:
        out = out.filter(c(name).isNotNull())
    for name in is_null:
        out = out.filter(c(name).isNull())
    return out


def count_rows(df: DataFrame, partition: str | None = None) -> DataFrame:
    return filter_catalog(df, partition).agg(F.count(F.lit(1)).alias("n"))


def count_ready(df: DataFrame, partition: str | None, path_gte: str | None, path_lt: str | None, not_null: Sequence[str]) -> DataFrame:
    return filter_catalog(df, partition, None, path_gte, path_lt, not_null).agg(F.count(F.lit(1)).alias("n"))


def upsert_by_path(table: DataFrame, updates: DataFrame, order: str, mode: str = "upsert") -> DataFrame:
    """Apply updates keyed on ``path``; of several updates for one path the last by ``order`` wins.

    ``update`` changes the given columns of existing rows, ``insert`` adds rows and fails on a known path, ``upsert`` does
    both. Updates without a path are skipped. A column an update does not carry keeps its value; a column it carries is
    written even when null.
    """
    if mode not in ("update", "insert", "upsert"):
        raise ValueError(f"unknown mode {mode!r}")
    given = [n for n in updates.columns if n not in ("path", order)]
    latest = (
        updates.filter(F.col("path").isNotNull() & (F.col("path") != ""))
        .groupBy("path")
        .agg(F.max_by(F.struct(*[c(n) for n in given]), c(order)).alias("_u"))
    )
    if mode == "insert" and not latest.join(table.select("path"), "path", "left_semi").isEmpty():
        raise ValueError("a path to insert already exists")
    how = "left" if mode == "update" else "full"
    joined = table.withColumn("_known", F.lit(True)).join(latest, "path", how)
    new = F.col("_u").isNotNull()
    cols = []
    for n in table.columns:
        cols.append(c(n) if n == "path" or n not in given else F.when(new, F.col("_u")[n].cast(table.schema[n].dataType)).otherwise(c(n)).alias(n))
    return joined.select(*cols)


def profile(df: DataFrame) -> DataFrame:
    """Per column: non-null count and ratio (an empty string is null), an example of up to 200 characters and its type.

    One aggregate over all columns; the example is the smallest value, which does not depend on row order.
    """
    parts = []
    for f in df.schema.fields:
        text = F.to_json(c(f.name)) if isinstance(f.dataType, (T.ArrayType, T.StructType, T.MapType)) else c(f.name).cast("string")
        v = F.when(text != "", text)
        parts.append(F.struct(F.lit(f.name).alias("field"), F.count(v).alias("non_null_count"), F.min(v).alias("_e"), F.lit(f.dataType.simpleString()).alias("type")))
    wide = df.agg(F.count(F.lit(1)).alias("_n"), F.array(*parts).alias("_f"))
    rows = wide.select("_n", F.explode("_f").alias("_p")).select("_n", "_p.*")
    return rows.select(
        "field",
        "non_null_count",
        F.round(F.col("non_null_count") / F.col("_n"), 4).alias("non_null_ratio"),
        F.when(F.col("non_null_count") > 0, F.col("type")).alias("type"),
        F.substring("_e", 1, 200).alias("example"),
    )


def status_distribution(df: DataFrame, suffix: str = "_status") -> DataFrame:
    """Value counts of all columns with that suffix, exploded once and combined on the map side."""
    names = [n for n in df.columns if n.endswith(suffix)]
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), c(n).cast("string").alias("value")) for n in names])
    return df.select(F.explode(pairs).alias("_p")).select("_p.*").groupBy("field", "value").agg(F.count(F.lit(1)).alias("n"))


def json_subkeys(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How often each key occurs in JSON objects held by string columns."""
    names = columns or [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    pairs = F.array(*[F.struct(F.lit(n).alias("field"), F.json_object_keys(c(n)).alias("keys")) for n in names])
    rows = df.select(F.explode(pairs).alias("_p")).select("_p.field", F.explode("_p.keys").alias("key"))
    return rows.groupBy("field", "key").agg(F.count(F.lit(1)).alias("n"))
