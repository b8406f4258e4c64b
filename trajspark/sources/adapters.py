"""Plain tables seen as episodic data."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.dataset import DEFAULT_FEATURES, EpisodicDataset
from trajspark.functions.columns import c
from trajspark.operators.layout import dictionary_join, hot_rows, join_numbered, positions, running, set_checkpoint_dir, text_join


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dense_episodes(lengths: DataFrame, key: str, at_most: int | None = None) -> DataFrame:
    """Number episodes by ``key`` and lay them end to end; ``lengths`` has one row per episode with ``length``."""
    numbered = positions(lengths, "episode_index", [key], at_most=at_most)
    ends = {"dataset_to_index": ("sum", F.col("length"))}
    summed = running(numbered, ends, keys=(), order="episode_index", at_most=at_most)
    return summed.withColumn("dataset_from_index", F.col("dataset_to_index") - F.col("length"))


def task_dictionary(rows: DataFrame, text: str, at_most: int | None = None) -> DataFrame:
    """Distinct texts numbered in sorted order."""
    distinct = rows.select(c(text).alias("task")).filter(F.col("task").isNotNull()).distinct()
    return positions(distinct, "task_index", ["task"], at_most=at_most)


def build_frames(
    raw: DataFrame, key: str, order: Sequence[str], task: str, extra: dict[str, Column] | None = None
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Turn ordered rows into frames, episodes and tasks.

    ``extra`` holds per-episode aggregates to carry to every frame. The row count, which Parquet answers from its footers,
    bounds all three tables. Above ``spark.trajspark.hotGroupRows`` the table of keys and the texts are kept, so that the raw
    rows are not grouped again for each use, and the longest group decides: without a hot group the raw rows are shuffled
    once, by key, and the episode table meets them there; otherwise it joins back on ``(key, block)``.
    """
    rows = raw.count()
    per_key = raw.groupBy(c(key)).agg(
        F.count(F.lit(1)).alias("length"), *[e.alias(n) for n, e in (extra or {}).items()]
    )
    tasks = task_dictionary(raw, task, rows)
    longest, to_task = rows, dictionary_join
    if rows > hot_rows(raw):
        set_checkpoint_dir(raw)
        per_key, tasks, to_task = per_key.checkpoint(), tasks.checkpoint(), text_join
        longest = per_key.agg(F.max("length")).first()[0]
    ordered = positions(raw, "frame_index", order, [key], at_most=longest)
    episodes = dense_episodes(per_key, key, rows)
    frames = join_numbered(ordered, episodes, key, longest)
    frames = frames.withColumn("index", F.col("dataset_from_index") + F.col("frame_index"))
    frames = to_task(frames, tasks.withColumnRenamed("task", task), task, ["index"])
    return frames, episodes, tasks


def frames_events(spark: SparkSession, sf_dir: str) -> EpisodicDataset:
    """One episode per user; state = (value, k), action = (value), reward = value, done on the last row or an error."""
    raw = table(spark, sf_dir, "events").withColumn("_us", F.unix_micros(F.col("ts").cast("timestamp")))
    raw = raw.withColumn("_k", F.get_json_object("props", "$.k").cast("double"))
    frames, episodes, tasks = build_frames(raw, "user_id", ["ts", "event_id"], "event_type", {"_t0": F.min("_us")})
    last = F.col("frame_index") == F.col("length") - 1
    frames = frames.select(
        ((F.col("_us") - F.col("_t0")) / 1e6).alias("timestamp"),
        "frame_index",
        "episode_index",
        "index",
        "task_index",
        F.array("value", "_k").alias("observation.state"),
        F.array("value").alias("action"),
        F.col("value").alias("next.reward"),
        (last | (F.col("event_type") == "error")).alias("next.done"),
        last.alias("is_last"),
        F.col("event_type").alias("task"),
        F.col("length").alias("episode_length"),
    )
    episodes = episodes.select("episode_index", "length", "dataset_from_index", "dataset_to_index", "user_id")
    features = {
        "observation.state": {"dtype": "float64", "shape": [2], "names": ["value", "k"]},
        "action": {"dtype": "float64", "shape": [1], "names": ["value"]},
        "next.reward": {"dtype": "float64", "shape": [1], "names": None},
        "next.done": {"dtype": "bool", "shape": [1], "names": None},
        **DEFAULT_FEATURES,
    }
    return EpisodicDataset(frames, episodes, tasks, {"fps": 1, "features": features})


LINE_ORDER = (
    "l_shipdate",
    "l_linenumber",
    "l_partkey",
    "l_suppkey",
    "l_quantity",
    "l_extendedprice",
    "l_discount",
    "l_tax",
)


def frames_lineitem(spark: SparkSession, sf_dir: str) -> EpisodicDataset:
    """One short episode per order; action = (quantity, extendedprice, discount, tax), task = flag + status."""
    raw = table(spark, sf_dir, "lineitem").withColumn("_task", F.concat("l_returnflag", "l_linestatus"))
    frames, episodes, tasks = build_frames(raw, "l_orderkey", LINE_ORDER, "_task")
    frames = frames.select(
        F.col("frame_index").cast("double").alias("timestamp"),
        "frame_index",
        "episode_index",
        "index",
        "task_index",
        F.array("l_quantity", "l_extendedprice", "l_discount", "l_tax").alias("action"),
        F.col("_task").alias("task"),
        F.col("length").alias("episode_length"),
    )
    episodes = episodes.select("episode_index", "length", "dataset_from_index", "dataset_to_index", "l_orderkey")
    features = {
        "action": {"dtype": "float64", "shape": [4], "names": ["quantity", "extendedprice", "discount", "tax"]},
        **DEFAULT_FEATURES,
    }
    return EpisodicDataset(frames, episodes, tasks, {"fps": 1, "features": features})


def frames_conv(spark: SparkSession, sf_dir: str) -> EpisodicDataset:
    """One episode per conversation; the role is the task."""
    raw = table(spark, sf_dir, "conversations")
    frames, episodes, tasks = build_frames(raw, "conv_id", ["turn"], "role")
    frames = frames.select(
        F.col("frame_index").cast("double").alias("timestamp"),
        "frame_index",
        "episode_index",
        "index",
        "task_index",
        "text",
        F.col("role").alias("task"),
        F.col("length").alias("episode_length"),
    )
    episodes = episodes.select("episode_index", "length", "dataset_from_index", "dataset_to_index", "conv_id")
    features = {"text": {"dtype": "string", "shape": [1], "names": None}, **DEFAULT_FEATURES}
    return EpisodicDataset(frames, episodes, tasks, {"fps": 1, "features": features})
