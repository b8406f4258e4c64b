"""Dataset directories: the given tables written as datasets and read back."""

from __future__ import annotations

import json

from pyspark.sql import functions as F

from trajspark.functions.columns import c
from trajspark.operators import joins as j
from trajspark.operators import stats as s
from trajspark.plans.dataset_queries import walk_sql
from trajspark.plans.registry import EVENTS, query
from trajspark.plans.stats_queries import STATE, rounded
from trajspark.plans.stream_queries import scratch, shards
from trajspark.sources import dataset_io as io
from trajspark.sources.adapters import frames_events, table
from trajspark.streaming import ops


def stored(spark, d, stats: bool = False):
    """Event episodes as a dataset directory of small files; a frame counts 1000 bytes."""
    ds = frames_events(spark, d)
    ds = ds.with_(frames=ds.frames.drop("task", "episode_length"), episodes=ds.episodes.drop("user_id"))
    if stats:
        per_episode = s.episode_stats(ds.frames, STATE, quantiles=(0.1,), mode="exact")
        ds = ds.with_(episode_stats=per_episode, stats=s.combine_stats(per_episode))
    root = scratch(spark)
    return io.write_dataset(ds, root, max_mb=0.5, bytes_per_frame=1000), root


@query("A1_A5_write_and_read", f'WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, i AS "index", task_index, v AS reward, k FROM fr')
def a5(spark, d):
    frames = stored(spark, d)[0].frames
    return frames.select("episode_index", "frame_index", "index", "task_index", c("next.reward").alias("reward"), c("observation.state")[1].alias("k"))


@query("A1_read_some_episodes", f'WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, v AS reward FROM fr WHERE e IN (3, 7, 8)')
def a1(spark, d):
    root = stored(spark, d)[1]
    io.publish_names(spark, root)
    ds = io.read_dataset(spark, root, [3, 7, 8])
    return ds.frames.select("episode_index", "frame_index", c("next.reward").alias("reward"))


@query("A2_A7_episode_files", walk_sql(EVENTS, "n * 1000", "w.held + s.sz >= 524288") + " SELECT DISTINCT 'data/chunk-000/file-' || lpad(CAST(g AS VARCHAR), 3, '0') || '.parquet' AS path FROM w")
def a7(spark, d):
    root = stored(spark, d)[1]
    return io.episode_file_paths(io.read_episodes(spark, root))


@query("A3_read_tasks", f"WITH {EVENTS} SELECT DISTINCT task_index, task FROM fr")
def a3(spark, d):
    return io.read_tasks(spark, stored(spark, d)[1])


@query("A4_read_stats", f"""WITH {EVENTS}, x AS (SELECT 0 AS dim, v AS x FROM fr UNION ALL SELECT 1, k FROM fr)
SELECT 'observation.state' AS feature, dim, round(min(x), 5) AS "min", round(max(x), 5) AS "max", round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std, count(*) AS "count" FROM x GROUP BY dim""")
def a4(spark, d):
    out = io.read_stats(spark, stored(spark, d, stats=True)[1])
    return rounded(out.select("feature", "dim", "min", "max", "mean", "std", "count"), 5)


@query("A2_episode_stats_columns", f"""WITH {EVENTS} SELECT e AS episode_index, min(v) AS lo, max(k) AS hi, count(*) AS n FROM fr GROUP BY e""")
def a2(spark, d):
    table_ = io.read_episodes(spark, stored(spark, d, stats=True)[1], with_stats=True)
    p = "stats/observation.state/"
    return table_.select("episode_index", c(p + "min")[0].alias("lo"), c(p + "max")[1].alias("hi"), c(p + "count")[0].alias("n"))


@query("A6_append_episodes", f"""WITH {EVENTS}, n AS (SELECT max(e) + 1 AS ne, count(*) AS ni FROM fr)
SELECT e AS episode_index, f AS frame_index, i AS "index", v AS reward FROM fr UNION ALL SELECT e + ne, f, i + ni, v FROM fr, n""")
def a6(spark, d):
    root = stored(spark, d)[1]
    rows = table(spark, d, "events").select("user_id", "ts", "event_id", F.col("event_type").alias("task"), F.col("value").alias("next.reward"))
    ds = io.append_dataset(spark, root, rows, "user_id", ["ts", "event_id"])
    return ds.frames.select("episode_index", "frame_index", "index", c("next.reward").alias("reward"))


@query("J10_missing_files", """SELECT DISTINCT 'data/file-' || o_orderkey || '.parquet' AS path FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)""")
def j10(spark, d):
    name = lambda k: F.concat(F.lit("data/file-"), F.col(k).cast("string"), F.lit(".parquet")).alias("path")
    return j.missing_files(table(spark, d, "orders").select(name("o_orderkey")), table(spark, d, "lineitem").select(name("l_orderkey")))


@query("T5_stream_episode_writer", f"""WITH {EVENTS} SELECT user_id, f AS frame_index, v AS reward FROM fr WHERE e >= 5""")
def t5(spark, d):
    """Episodes 0-4 are on disk; the others arrive as a stream and are appended when their last row is there."""
    ds = frames_events(spark, d)
    users = ds.episodes.select("episode_index", "user_id")
    first = ds.with_(
        frames=ds.frames.filter("episode_index < 5").drop("task", "episode_length"),
        episodes=ds.episodes.filter("episode_index < 5").drop("user_id"),
    )
    root = scratch(spark)
    io.write_dataset(first, root, bytes_per_frame=1000)
    rows = ds.frames.filter("episode_index >= 5").join(users, "episode_index")
    rows = rows.select("user_id", F.col("frame_index").alias("seq"), "task", c("next.reward").alias("next.reward"), "is_last")
    stream, folder = shards(spark, rows, "seq")
    ops.stream_episode_writer(stream, root, "user_id", ["seq"], "is_last", f"{folder}/cp", availableNow=True).awaitTermination()
    episodes = io.read_episodes(spark, root).filter("source_key IS NOT NULL").select("episode_index", F.col("source_key").alias("user_id"))
    frames = io.read_dataset(spark, root).frames.join(episodes, "episode_index")
    return frames.select("user_id", "frame_index", c("next.reward").alias("reward"))


def older_layout(spark, d) -> str:
    """Event episodes in the older layout: one folder of frames per episode and JSON-lines metadata."""
    ds, root = frames_events(spark, d), scratch(spark)
    name = F.format_string("episode_%06d", "episode_index")
    # Three parts are made of the frames; each would number them again.
    kept = f"{scratch(spark)}/frames"
    ds.frames.write.parquet(kept)
    ds = ds.with_(frames=spark.read.parquet(kept))
    files = ds.frames.drop("task", "episode_length", "index").withColumn("part", name).repartition("part").write
    # The tasks move their files into place; the driver would move one after the other.
    files.partitionBy("part").option("mapreduce.fileoutputcommitter.algorithm.version", "2").parquet(f"{root}/data")
    used = ds.frames.groupBy("episode_index").agg(F.sort_array(F.collect_set("task")).alias("tasks"), F.count(F.lit(1)).alias("length"))
    used.write.json(f"{root}/meta/episodes.jsonl")
    names = ["min", "max", "mean", "std", "count"]
    rows = s.episode_stats(ds.frames, STATE).groupBy("episode_index", "feature").agg(F.sort_array(F.collect_list(F.struct("dim", *names))).alias("_x"))
    arrays = F.struct(*[F.col(f"_x.{n}").alias(n) for n in names])
    stats = rows.groupBy("episode_index").agg(F.map_from_entries(F.collect_list(F.struct("feature", arrays))).alias("stats"))
    stats.write.json(f"{root}/meta/episodes_stats.jsonl")
    ds.tasks.write.json(f"{root}/meta/tasks.jsonl")
    io._write_text(spark, f"{root}/meta/info.json", json.dumps({"codebase_version": "v2.1", "fps": 10.0, "total_chunks": 1, "features": STATE}))
    return root


@query("A8_read_legacy", f"WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, task_index, v AS reward, k FROM fr")
def a8(spark, d):
    frames = io.read_legacy(spark, older_layout(spark, d)).frames
    at = F.col("_file_episode").alias("episode_index")
    return frames.select(at, "frame_index", "task_index", c("next.reward").alias("reward"), c("observation.state")[1].alias("k"))


@query("D7_convert_legacy", f'WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, i AS "index", task_index, v AS reward, k FROM fr')
def d7(spark, d):
    frames = io.convert_legacy(spark, older_layout(spark, d), scratch(spark), max_mb=0.5).frames
    return frames.select("episode_index", "frame_index", "index", "task_index", c("next.reward").alias("reward"), c("observation.state")[1].alias("k"))


@query("D7_converted_stats", f"""WITH {EVENTS}, x AS (SELECT 0 AS dim, v AS x FROM fr UNION ALL SELECT 1, k FROM fr)
SELECT 'observation.state' AS feature, dim, round(min(x), 5) AS "min", round(max(x), 5) AS "max", round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std, count(*) AS "count" FROM x GROUP BY dim""")
def d7_stats(spark, d):
    out = io.convert_legacy(spark, older_layout(spark, d), scratch(spark), max_mb=0.5).stats
    return rounded(out.select("feature", "dim", "min", "max", "mean", "std", "count"), 5)
