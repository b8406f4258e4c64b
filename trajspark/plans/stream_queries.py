"""Streaming operators over event frames: the frames are written as shards and read back as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trajspark.functions.columns import c
from trajspark.operators import windows as w
from trajspark.operators.layout import shared_folder
from trajspark.plans.catalog_queries import SIMILAR, repeated_step
from trajspark.plans.registry import EVENTS, query
from trajspark.plans.stats_queries import STATE, rounded
from trajspark.plans.window_queries import DELTAS
from trajspark.sources.adapters import frames_events, table
from trajspark.streaming import ops


def scratch(spark) -> str:
    """A new folder under the folder all executors share."""
    return f"{shared_folder(spark)}/trajspark-{uuid.uuid4().hex}"


def shards(spark, frames: DataFrame, order: str = "frame_index", n: int = 3) -> tuple[DataFrame, str]:
    """Frames written as shards in ``order``, one after the other as a recorder would, and the stream reading them.

    The frames are computed once and kept; the cuts and each shard read them back.
    """
    folder = scratch(spark)
    frames.write.parquet(f"{folder}/frames")
    frames = spark.read.schema(frames.schema).parquet(f"{folder}/frames")
    rank = F.unix_micros(c(order)) if dict(frames.dtypes)[order] == "timestamp" else c(order)
    cuts = frames.select(F.percentile_approx(rank, [i / n for i in range(1, n)])).first()[0]
    for low, high in zip([None, *cuts], [*cuts, None]):
        part = frames if low is None else frames.filter(rank > low)
        part = part if high is None else part.filter(rank <= high)
        part.write.mode("append").parquet(f"{folder}/shards")
    return ops.stream_source(spark, f"{folder}/shards", frames.schema, 8), folder


def drain(spark, stream: DataFrame, folder: str, mode: str = "append") -> DataFrame:
    """Run a stream to its end into a Parquet folder and read that."""
    out = f"{folder}/out"
    q = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(out)
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)


def drain_updates(spark, stream: DataFrame, folder: str, keys: list[str]) -> DataFrame:
    """Run a stream to its end in update mode and read the last row of each key: what is still open at the end is there too."""
    out = f"{folder}/updates"

    def keep(batch, number):
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = stream.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/cp-updates").trigger(availableNow=True).start()
    q.awaitTermination()
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    values = [n for n in stream.columns if n not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*values), "batch").alias("_r"))
    return latest.select(*keys, *[F.col(f"_r.{n}").alias(n) for n in values])


@query("T1_stream_delta_window", f"""WITH {EVENTS}, d(pos, o) AS (VALUES (0, -2), (1, 0), (2, 3))
SELECT a.e AS episode_index, a.f AS frame_index, d.pos, b.v AS value, (a.f + d.o < 0 OR a.f + d.o >= a.n) AS is_pad
FROM fr a CROSS JOIN d JOIN fr b ON b.e = a.e AND b.f = greatest(0, least(a.n - 1, a.f + d.o))""")
def t1(spark, d):
    frames = frames_events(spark, d).frames.select("episode_index", "frame_index", c("next.reward").alias("reward"), "is_last")
    stream, folder = shards(spark, frames)
    out = drain(spark, ops.stream_delta_window(stream, "reward", DELTAS, 1), folder)
    z = F.arrays_zip("values", "is_pad")
    rows = out.select("episode_index", "frame_index", F.posexplode(z).alias("pos", "_z"))
    return rows.select("episode_index", "frame_index", "pos", F.col("_z.values").alias("value"), F.col("_z.is_pad").alias("is_pad"))


@query("T2_stream_velocity", f"""WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, k, round(coalesce((v - lag(v) OVER p) / 0.1, 0), 6) AS v0
FROM fr WINDOW p AS (PARTITION BY e ORDER BY f)""")
def t2(spark, d):
    frames = frames_events(spark, d).frames.select("episode_index", "frame_index", c("observation.state").alias("state"), "is_last")
    stream, folder = shards(spark, frames)
    out = drain(spark, ops.stream_velocity(stream, "state", 0.1), folder)
    return out.select("episode_index", "frame_index", F.col("state")[1].alias("k"), F.round(F.col("velocity")[0], 6).alias("v0"))


@query("T2_stream_time_limit", f"WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, f + 1 >= 40 AS truncated FROM fr")
def t2_limit(spark, d):
    stream, folder = shards(spark, frames_events(spark, d).frames.select("episode_index", "frame_index"))
    return drain(spark, ops.stream_time_limit(stream, 40), folder)


@query("T3_stream_similar_filter", SIMILAR)
def t3(spark, d):
    frames = frames_events(spark, d).frames.withColumn("step", repeated_step())
    stream, folder = shards(spark, frames.select("episode_index", "frame_index", "step", "is_last", c("observation.state").alias("state")))
    return drain(spark, ops.stream_similar_filter(stream, "state", 25.0, step="step", end="is_last"), folder)


@query("T4_stream_merge_chunks", f"""WITH {EVENTS}, c AS (SELECT e, f, n, f // 3 AS arrival FROM fr WHERE f % 3 = 0 AND f + 6 <= n),
x AS (SELECT c.e, c.arrival, c.f + h.p AS ts, b.v + c.arrival AS a FROM c CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5)) h(p)
      JOIN fr b ON b.e = c.e AND b.f = c.f + h.p WHERE h.p > 0)
SELECT e AS episode_index, ts AS timestep, max(arrival) AS arrival,
       round(CASE WHEN count(*) = 1 THEN max(a) ELSE 0.3 * min_by(a, arrival) + 0.7 * max_by(a, arrival) END, 6) AS action
FROM x GROUP BY e, ts""")
def t4(spark, d):
    chunks = w.action_chunks(frames_events(spark, d).frames, 6).filter(F.col("frame_index") % 3 == 0)
    log = chunks.withColumn("arrival", (F.col("frame_index") / 3).cast("long"))
    rows = log.select("episode_index", "arrival", "frame_index", F.posexplode("chunk").alias("_p", "_a"))
    rows = rows.select("episode_index", "arrival", "frame_index", (F.col("frame_index") + F.col("_p")).alias("timestep"), F.col("frame_index").alias("latest"), F.array(F.col("_a")[0] + F.col("arrival")).alias("action"))
    stream, folder = shards(spark, rows)
    out = drain(spark, ops.stream_merge_chunks(stream), folder)
    last = out.groupBy("episode_index", "timestep").agg(F.max("arrival").alias("arrival"), F.max_by("action", "arrival").alias("_a"))
    return last.select("episode_index", "timestep", "arrival", F.round(F.col("_a")[0], 6).alias("action"))


@query("T6_stream_running_stats", f"""WITH {EVENTS}, x AS (SELECT 0 AS dim, v AS x FROM fr UNION ALL SELECT 1, k FROM fr)
SELECT dim, round(min(x), 5) AS "min", round(max(x), 5) AS "max", round(avg(x), 5) AS mean, round(stddev_pop(x), 5) AS std, count(*) AS "count" FROM x GROUP BY dim""")
def t6(spark, d):
    frames = frames_events(spark, d).frames.select("episode_index", "frame_index", "`observation.state`")
    stream, folder = shards(spark, frames)
    q = ops.stream_running_stats(stream, STATE, f"{folder}/state", f"{folder}/cp", availableNow=True)
    q.awaitTermination()
    last = max(p["batchId"] for p in q.recentProgress if p["numInputRows"] > 0)
    return rounded(ops.running_stats(spark, f"{folder}/state", last, STATE), 5).select("dim", "min", "max", "mean", "std", "count")


@query("T7_stream_rollout_returns", f"""WITH {EVENTS}, fd AS (SELECT e, min(CASE WHEN done THEN f END) AS fd FROM fr GROUP BY e)
SELECT fr.e AS episode_index, round(sum(v), 6) AS sum_reward, max(v) AS max_reward, bool_or(k > 50) AS success FROM fr JOIN fd ON fd.e = fr.e WHERE f <= fd GROUP BY fr.e""")
def t7(spark, d):
    f = frames_events(spark, d).frames
    rows = f.select("episode_index", "frame_index", F.col("frame_index").alias("step"), c("next.reward").alias("reward"), c("next.done").alias("done"), (c("observation.state")[1] > 50).alias("success"))
    stream, folder = shards(spark, rows)
    updates = ops.stream_rollout_returns(stream)
    out = f"{folder}/out"

    def keep(batch, number):
        batch.withColumn("_n", F.lit(number)).write.mode("overwrite").parquet(f"{out}/batch={number}")

    q = updates.writeStream.outputMode("update").foreachBatch(keep).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    q.awaitTermination()
    latest = spark.read.parquet(out).groupBy("episode_index").agg(F.max_by(F.struct("sum_reward", "max_reward", "success"), "_n").alias("_r"))
    return latest.select("episode_index", F.round("_r.sum_reward", 6).alias("sum_reward"), "_r.max_reward", "_r.success")


@query("T7_stream_fps", """WITH w AS (SELECT date_trunc('day', ts) AS d, user_id, count(*) AS n, date_diff('microsecond', min(ts), max(ts)) / 1e6 AS s FROM events GROUP BY 1, 2),
m AS (SELECT max(date_trunc('day', ts)) AS last FROM events)
SELECT CAST(date_diff('day', TIMESTAMP '2024-01-01', d) AS INTEGER) AS day, user_id, n, round(CASE WHEN s > 1e-6 THEN (n - 1) / s ELSE 0 END, 9) AS avg_fps FROM w, m WHERE d < last""")
def t7_fps(spark, d):
    events = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    stream, folder = shards(spark, events, "ts")
    out = drain(spark, ops.stream_fps(stream, ["user_id"], "ts", "1 day", "1 hour"), folder)
    day = F.datediff(F.col("window_start").cast("date"), F.lit("2024-01-01").cast("date"))
    return out.select(day.alias("day"), "user_id", "n", F.round("avg_fps", 9).alias("avg_fps"))


@query("T7_stream_fps_all_days", """WITH w AS (SELECT date_trunc('day', ts) AS d, user_id, count(*) AS n, date_diff('microsecond', min(ts), max(ts)) / 1e6 AS s FROM events GROUP BY 1, 2)
SELECT CAST(date_diff('day', TIMESTAMP '2024-01-01', d) AS INTEGER) AS day, user_id, n, round(CASE WHEN s > 1e-6 THEN (n - 1) / s ELSE 0 END, 9) AS avg_fps FROM w""")
def t7_fps_all(spark, d):
    events = table(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("ts"))
    stream, folder = shards(spark, events, "ts")
    out = drain_updates(spark, ops.stream_fps(stream, ["user_id"], "ts", "1 day", "1 hour"), folder, ["window_start", "user_id"])
    day = F.datediff(F.col("window_start").cast("date"), F.lit("2024-01-01").cast("date"))
    return out.select(day.alias("day"), "user_id", "n", F.round("avg_fps", 9).alias("avg_fps"))


@query("T8_bounded_queue", f"""WITH RECURSIVE {EVENTS}, q AS (SELECT e, f, task <> 'click' AND task <> 'view' AS up FROM fr),
r(e, f, depth, dropped) AS (SELECT e, f, CASE WHEN up THEN 1 ELSE 0 END, false FROM q WHERE f = 0
 UNION ALL SELECT q.e, q.f, CASE WHEN up THEN least(4, depth + 1) ELSE greatest(0, depth - 1) END, up AND depth = 4 FROM r JOIN q ON q.e = r.e AND q.f = r.f + 1)
SELECT e AS episode_index, f AS frame_index, CAST(depth AS BIGINT) AS depth, dropped FROM r""")
def t8(spark, d):
    log = frames_events(spark, d).frames.select("episode_index", "frame_index", (~F.col("task").isin("click", "view")).alias("up"))
    return ops.bounded_queue(log, 4, ["episode_index"], "frame_index", "up")
