"""Windowed reads over event and order-line episodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajspark.functions.columns import c
from trajspark.operators import windows as w
from trajspark.operators.joins import with_task_text
from trajspark.plans.registry import EVENTS, LINES, query
from trajspark.sources.adapters import frames_events, frames_lineitem

DELTAS = [-2.0, 0.0, 3.0]


def _exploded(df, key, pad):
    pairs = F.arrays_zip(c(key).alias("v"), c(pad).alias("p"))
    rows = df.select("episode_index", "frame_index", F.posexplode(pairs).alias("pos", "_z"))
    return rows.select("episode_index", "frame_index", "pos", F.col("_z.v").alias("value"), F.col("_z.p").alias("is_pad"))


CLAMPED = f"""WITH {EVENTS}, d(pos, o) AS (VALUES (0, -2), (1, 0), (2, 3))
SELECT a.e AS episode_index, a.f AS frame_index, d.pos, b.v AS value, (a.f + d.o < 0 OR a.f + d.o >= a.n) AS is_pad
FROM fr a CROSS JOIN d JOIN fr b ON b.e = a.e AND b.f = greatest(0, least(a.n - 1, a.f + d.o))"""


@query("W1_delta_window", CLAMPED)
def w1(spark, d):
    return _exploded(w.delta_window(frames_events(spark, d).frames, {"next.reward": DELTAS}, 1), "next.reward", "next.reward_is_pad")


@query("W1_delta_window_by_join", CLAMPED)
def w1_join(spark, d):
    frames = frames_events(spark, d).frames
    return _exploded(w.delta_window(frames, {"next.reward": DELTAS}, 1, method="join"), "next.reward", "next.reward_is_pad")


@query("W1_J1_training_window", f"""WITH {EVENTS}, d(pos, o) AS (VALUES (0, -2), (1, 0), (2, 3))
SELECT a.e AS episode_index, a.f AS frame_index, a.i AS "index", a.task, d.pos, b.v AS value,
       (a.f + d.o < 0 OR a.f + d.o >= a.n) AS is_pad
FROM fr a CROSS JOIN d JOIN fr b ON b.e = a.e AND b.f = greatest(0, least(a.n - 1, a.f + d.o))""")
def training_window(spark, d):
    ds = frames_events(spark, d)
    frames = with_task_text(ds.frames.drop("task"), ds.tasks)
    out = w.delta_window(frames.select("episode_index", "frame_index", "index", "task", "`next.reward`"), {"next.reward": DELTAS}, 1)
    pairs = F.arrays_zip(c("next.reward").alias("v"), c("next.reward_is_pad").alias("p"))
    rows = out.select("episode_index", "frame_index", "index", "task", F.posexplode(pairs).alias("pos", "_z"))
    return rows.select("episode_index", "frame_index", "index", "task", "pos", F.col("_z.v").alias("value"), F.col("_z.p").alias("is_pad"))


@query("W4_nearest_requested", f"""WITH {EVENTS}, d(pos, o) AS (VALUES (0, -3), (1, -1), (2, 0), (3, 2), (4, 4)),
asked AS (
  SELECT a.e, a.f, a.n, d.pos, d.o, (SELECT max(abs(x.o)) FROM d x WHERE x.o * sign(d.o) > 0 AND abs(x.o) <= abs(d.o)
    AND a.f + x.o >= 0 AND a.f + x.o < a.n) AS reach FROM fr a CROSS JOIN d)
SELECT q.e AS episode_index, q.f AS frame_index, q.pos, b.v AS value, (q.f + q.o < 0 OR q.f + q.o >= q.n) AS is_pad
FROM asked q JOIN fr b ON b.e = q.e AND b.f = q.f + CAST(coalesce(q.reach * sign(q.o), 0) AS BIGINT)""")
def w4(spark, d):
    out = w.delta_window(frames_events(spark, d).frames, {"next.reward": [-3.0, -1.0, 0.0, 2.0, 4.0]}, 1, pad="nearest_requested")
    return _exploded(out, "next.reward", "next.reward_is_pad")


@query("W5_symmetric_window", f"""WITH {EVENTS}, d(pos, o) AS (VALUES (0, -6), (1, -3), (2, 0), (3, 3), (4, 6))
SELECT e AS episode_index, f AS frame_index, pos, greatest(0, least(n - 1, f + o)) AS obs_index,
       CASE WHEN f + o < 0 OR f + o >= n THEN 1 ELSE 0 END AS out_of_bounds FROM fr CROSS JOIN d""")
def w5(spark, d):
    out = w.symmetric_window(frames_events(spark, d).frames, 4, 3)
    z = F.arrays_zip(c("obs_indices").alias("i"), c("obs_out_of_bounds").alias("o"))
    rows = out.select("episode_index", "frame_index", F.posexplode(z).alias("pos", "_z"))
    return rows.select("episode_index", "frame_index", "pos", F.col("_z.i").alias("obs_index"), F.col("_z.o").alias("out_of_bounds"))


@query("W6_rewind_indices", f"""WITH {EVENTS}, s AS (
  SELECT e, f, f - 4 AS earliest, CASE WHEN f - 4 <= 0 THEN 0 ELSE least(3, (f - 4) // 2, 5) END AS steps FROM fr)
SELECT e AS episode_index, f AS frame_index, CAST(steps AS INTEGER) AS rewind_step, CAST(r.g AS INTEGER) AS pos,
       greatest(0, earliest - r.g * 2) AS rewind_frame
FROM s JOIN (VALUES (1), (2), (3)) r(g) ON r.g <= s.steps""")
def w6(spark, d):
    out = w.rewind_indices(frames_events(spark, d).frames, n_obs=4, max_steps=5, gap=2, step=3)
    rows = out.select("episode_index", "frame_index", "rewind_step", F.posexplode("rewind_frames").alias("_p", "rewind_frame"))
    return rows.select("episode_index", "frame_index", "rewind_step", (F.col("_p") + 1).alias("pos"), "rewind_frame")


@query("W7_action_chunks", f"""WITH {EVENTS}, h(pos) AS (VALUES (0), (1), (2), (3))
SELECT a.e AS episode_index, a.f AS frame_index, h.pos, round(b.v - a.v, 6) AS value
FROM fr a CROSS JOIN h JOIN fr b ON b.e = a.e AND b.f = a.f + h.pos WHERE a.f + 4 <= a.n""")
def w7(spark, d):
    out = w.action_chunks(frames_events(spark, d).frames, 4, delta_dims=[0])
    rows = out.select("episode_index", "frame_index", F.posexplode("chunk").alias("pos", "_row"))
    return rows.select("episode_index", "frame_index", "pos", F.round(F.col("_row")[0], 6).alias("value"))


@query("W8_episode_sampler", f"""WITH {LINES}
SELECT i AS "index", e AS episode_index, f AS frame_index FROM fr WHERE f >= 1 AND f < n - 2""")
def w8(spark, d):
    ds = frames_lineitem(spark, d)
    return w.episode_sampler(ds.frames, ds.episodes, 1, 2).select("index", "episode_index", "frame_index")


@query("W8_skipped_episodes", f"WITH {LINES} SELECT DISTINCT e AS episode_index, n AS length FROM fr WHERE n <= 3")
def w8_skipped(spark, d):
    return w.skipped_episodes(frames_lineitem(spark, d).episodes, 1, 2)


@query("W9_next_state", f"""WITH {EVENTS}
SELECT e AS episode_index, f AS frame_index, v AS reward, v AS s0, k AS s1, done, done AS truncated, false AS stored_truncated,
       CASE WHEN done THEN v ELSE lead(v) OVER p END AS n0, CASE WHEN done THEN k ELSE lead(k) OVER p END AS n1
FROM fr WINDOW p AS (PARTITION BY e ORDER BY f)""")
def w9(spark, d):
    out = w.next_state(frames_events(spark, d).frames, ["observation.state"])
    s, n = c("observation.state"), c("next_observation.state")
    return out.select("episode_index", "frame_index", "reward", s[0].alias("s0"), s[1].alias("s1"), "done", "truncated",
                      "stored_truncated", n[0].alias("n0"), n[1].alias("n1"))


@query("W10_finite_difference", f"""WITH {EVENTS}
SELECT e AS episode_index, f AS frame_index, v AS x0, k AS x1,
       round(coalesce((v - lag(v) OVER p) / 0.1, 0), 6) AS v0, round(coalesce((k - lag(k) OVER p) / 0.1, 0), 6) AS v1
FROM fr WINDOW p AS (PARTITION BY e ORDER BY f)""")
def w10(spark, d):
    out = w.finite_difference(frames_events(spark, d).frames, "observation.state", 0.1)
    s = c("observation.state")
    return out.select("episode_index", "frame_index", s[0].alias("x0"), s[1].alias("x1"), F.round(s[2], 6).alias("v0"), F.round(s[3], 6).alias("v1"))


@query("W11_time_limit", f"""WITH {EVENTS}
SELECT e AS episode_index, f AS frame_index, (f + 1 >= 40 OR done) AS truncated FROM fr""")
def w11(spark, d):
    return w.time_limit(frames_events(spark, d).frames, 40, "next.done").select("episode_index", "frame_index", "truncated")


@query("W12_jump_check", f"""WITH {EVENTS}, b AS (
  SELECT e, f, greatest(5.0, least(150.0, v)) AS p0, greatest(10.0, least(90.0, k)) AS p1 FROM fr), s AS (
  SELECT *, coalesce(sqrt((p0 - lag(p0) OVER p) * (p0 - lag(p0) OVER p) + (p1 - lag(p1) OVER p) * (p1 - lag(p1) OVER p)), 0) AS st
  FROM b WINDOW p AS (PARTITION BY e ORDER BY f))
SELECT e AS episode_index, f AS frame_index, CAST(p0 AS DOUBLE) AS p0, CAST(p1 AS DOUBLE) AS p1,
       round(CAST(st AS DOUBLE), 6) AS step FROM s WHERE st > 60""")
def w12(spark, d):
    out = w.jump_check(frames_events(spark, d).frames, "observation.state", [5, 10], [150, 90], 60)
    s = c("observation.state")
    return out.filter("is_jump").select("episode_index", "frame_index", s[0].alias("p0"), s[1].alias("p1"), F.round("step", 6).alias("step"))


@query("W13_latched_reference", f"""WITH {EVENTS}, x AS (
  SELECT *, k >= 50 AS en, lag(k >= 50) OVER (PARTITION BY e ORDER BY f) AS was FROM fr), y AS (
  SELECT *, last_value(CASE WHEN en AND NOT coalesce(was, false) THEN v END IGNORE NULLS) OVER (PARTITION BY e ORDER BY f) AS ref,
         first_value(v) OVER (PARTITION BY e ORDER BY f) AS v0 FROM x)
SELECT e AS episode_index, f AS frame_index, ref AS reference,
       round(coalesce(last_value(CASE WHEN en THEN ref + k END IGNORE NULLS) OVER (PARTITION BY e ORDER BY f), v0), 6) AS command
FROM y""")
def w13(spark, d):
    frames = frames_events(spark, d).frames.withColumns({"enabled": c("observation.state")[1] >= 50, "step": F.array(c("observation.state")[1])})
    out = w.latched_reference(frames, "enabled", "action", "step")
    return out.select("episode_index", "frame_index", F.col("reference")[0].alias("reference"), F.round(F.col("command")[0], 6).alias("command"))


@query("W14_motion_score", f"""WITH {EVENTS}, p AS (
  SELECT e, v - lag(v) OVER w AS a, k - lag(k) OVER w AS b, f - lag(f) OVER w AS g FROM fr WINDOW w AS (PARTITION BY e ORDER BY f))
SELECT e AS episode_index, round(avg(sqrt(a * a + b * b + g * g)), 6) AS motion_score FROM p GROUP BY e""")
def w14(spark, d):
    frames = frames_events(spark, d).frames.withColumn("xyz", F.concat("`observation.state`", F.array(F.col("frame_index").cast("double"))))
    return w.motion_score(frames, "xyz").select("episode_index", F.round("motion_score", 6).alias("motion_score"))


@query("W15_forward_fill_downsample", f"""WITH {EVENTS}
SELECT a.e AS episode_index, a.f AS frame_index, b.v AS value FROM fr a JOIN fr b ON b.e = a.e AND b.f = a.f - a.f % 4""")
def w15(spark, d):
    out = w.forward_fill_downsample(frames_events(spark, d).frames, "next.reward", 4, "value")
    return out.select("episode_index", "frame_index", "value")


@query("W16_resample", f"""WITH {EVENTS}, tgt AS (
  SELECT e, n, unnest(range(CAST(round_even(CAST((n - 1) / 10.0 * 25.0 AS DOUBLE), 0) AS BIGINT) + 1)) AS j
  FROM (SELECT DISTINCT e, n FROM fr)), pos AS (
  SELECT e, j, least(n - 1, j * 10 // 25) AS lo, least(n - 1, j * 10 // 25 + 1) AS hi, (j * 10 - (j * 10 // 25) * 25) / 25.0 AS w FROM tgt)
SELECT p.e AS episode_index, p.j AS frame_index, round(CAST(a.v + (b.v - a.v) * p.w AS DOUBLE), 6) AS v,
       round(CAST(a.k + (b.k - a.k) * p.w AS DOUBLE), 6) AS k
FROM pos p JOIN fr a ON a.e = p.e AND a.f = p.lo JOIN fr b ON b.e = p.e AND b.f = p.hi""")
def w16(spark, d):
    out = w.resample(frames_events(spark, d).frames, ["observation.state"], 10, 25)
    s = c("observation.state")
    return out.select("episode_index", "frame_index", F.round(s[0], 6).alias("v"), F.round(s[1], 6).alias("k"))


@query("W17_interpolate_progress", f"""WITH {EVENTS}, g AS (
  SELECT e, f, last_value(CASE WHEN k < 30 THEN f END IGNORE NULLS) OVER p AS bf, last_value(CASE WHEN k < 30 THEN v END IGNORE NULLS) OVER p AS bv,
    first_value(CASE WHEN k < 30 THEN f END IGNORE NULLS) OVER q AS af, first_value(CASE WHEN k < 30 THEN v END IGNORE NULLS) OVER q AS av
  FROM fr WINDOW p AS (PARTITION BY e ORDER BY f ROWS UNBOUNDED PRECEDING),
    q AS (PARTITION BY e ORDER BY f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT e AS episode_index, f AS frame_index, round(CAST(CAST(CASE WHEN af IS NULL THEN bv WHEN bf IS NULL OR af = bf THEN av
  ELSE bv + (av - bv) * (f - bf) / (af - bf) END AS FLOAT) AS DOUBLE), 3) AS progress FROM g""")
def w17(spark, d):
    frames = frames_events(spark, d).frames.withColumn("sparse", F.when(c("observation.state")[1] < 30, c("next.reward")))
    out = w.interpolate_progress(frames, "sparse")
    return out.select("episode_index", "frame_index", F.round(F.col("progress").cast("double"), 3).alias("progress"))


@query("W18_strided_indices", f"""WITH {EVENTS}, o AS (
  SELECT *, row_number() OVER (PARTITION BY e ORDER BY f % 5, f) - 1 AS visit_order FROM fr)
SELECT e AS episode_index, f AS frame_index, i AS "index", visit_order FROM o WHERE f % 3 = 0 OR is_last""")
def w18(spark, d):
    out = w.strided_indices(frames_events(spark, d).frames, 5, 3)
    return out.select("episode_index", "frame_index", "index", "visit_order")


def _chunk_log(spark, d):
    """Every third frame issues a chunk with the next six rewards."""
    chunks = w.action_chunks(frames_events(spark, d).frames, 6)
    picked = chunks.filter(F.col("frame_index") % 3 == 0)
    return picked.withColumn("arrival", (F.col("frame_index") / 3).cast("long"))


@query("W20_merge_overlapping_chunks", f"""WITH {EVENTS}, c AS (SELECT e, f, n, f // 3 AS arrival FROM fr WHERE f % 3 = 0 AND f + 6 <= n),
x AS (SELECT c.e, c.arrival, c.f + h.p AS ts, b.v + c.arrival AS a FROM c CROSS JOIN (VALUES (0),(1),(2),(3),(4),(5)) h(p)
      JOIN fr b ON b.e = c.e AND b.f = c.f + h.p WHERE c.f + h.p > c.f)
SELECT e AS episode_index, ts AS timestep, max(arrival) AS arrival,
       round(CASE WHEN count(*) = 1 THEN max(a) ELSE 0.3 * min_by(a, arrival) + 0.7 * max_by(a, arrival) END, 6) AS action
FROM x GROUP BY e, ts""")
def w20(spark, d):
    log = _chunk_log(spark, d).withColumn("actions", F.transform("chunk", lambda r: F.array(r[0] + F.col("arrival"))))
    rows = w.chunk_timestamps(log.select("episode_index", "arrival", F.col("frame_index").alias("_t0"), "frame_index", "actions"), "_t0", "frame_index", 1)
    rows = rows.withColumn("latest", F.col("timestep") - F.col("pos"))
    out = w.merge_overlapping_chunks(rows, "weighted_average", latest="latest")
    return out.select("episode_index", "timestep", "arrival", F.round(F.col("action")[0], 6).alias("action"))


@query("W21_action_queue", f"""WITH {EVENTS}, c AS (SELECT e, f, n, f // 3 AS arrival FROM fr WHERE f % 3 = 0 AND f + 6 <= n),
last AS (SELECT e, max(f) AS f, count(*) AS chunks FROM c GROUP BY e),
app AS (SELECT c.e, c.arrival * 6 + h.p - 2 * (l.chunks - 1) AS pos, c.f + h.p AS src FROM c JOIN last l ON l.e = c.e CROSS JOIN range(6) h(p))
SELECT l.e AS episode_index, 'replace' AS mode, h.p - 2 AS pos, b.v AS action
FROM last l CROSS JOIN range(6) h(p) JOIN fr b ON b.e = l.e AND b.f = l.f + h.p WHERE h.p >= 2
UNION ALL SELECT a.e, 'append', a.pos, b.v FROM app a JOIN fr b ON b.e = a.e AND b.f = a.src WHERE a.pos >= 0""")
def w21(spark, d):
    log = _chunk_log(spark, d).select("episode_index", "arrival", F.col("chunk").alias("actions"), F.lit(2).alias("delay"), F.lit(2).alias("consumed"))
    both = [w.action_queue(log, m).withColumn("mode", F.lit(m)) for m in ("replace", "append")]
    return both[0].unionByName(both[1]).select("episode_index", "mode", "pos", F.col("action")[0].alias("action"))


@query("W22_chunk_timestamps", f"""WITH {EVENTS}
SELECT a.e AS episode_index, a.f AS "chunk", h.p AS pos, round(a.t + h.p * 0.5, 6) AS "timestamp", a.f + h.p AS timestep, b.v AS action
FROM fr a CROSS JOIN (VALUES (0), (1), (2)) h(p) JOIN fr b ON b.e = a.e AND b.f = a.f + h.p WHERE a.f + 3 <= a.n""")
def w22(spark, d):
    frames = frames_events(spark, d).frames
    chunks = w.action_chunks(frames, 3).join(frames.select("episode_index", "frame_index", "timestamp"), ["episode_index", "frame_index"])
    log = chunks.select("episode_index", F.col("frame_index").alias("chunk"), "timestamp", "frame_index", F.col("chunk").alias("actions"))
    out = w.chunk_timestamps(log, "timestamp", "frame_index", 0.5)
    return out.select("episode_index", "chunk", "pos", F.round("timestamp", 6).alias("timestamp"), "timestep", F.col("action")[0].alias("action"))


@query("W23_temporal_ensemble", f"""WITH {EVENTS}, x AS (
  SELECT a.e, a.f, a.f + h.p AS ts, b.v + a.f AS x FROM fr a CROSS JOIN range(5) h(p) JOIN fr b ON b.e = a.e AND b.f = a.f + h.p WHERE a.f + 5 <= a.n),
y AS (SELECT *, exp(-0.1 * (row_number() OVER (PARTITION BY e, ts ORDER BY f) - 1)) AS w FROM x)
SELECT e AS episode_index, ts AS timestep, 0 AS dim, round(sum(w * x) / sum(w), 6) AS value FROM y GROUP BY e, ts""")
def w23(spark, d):
    chunks = w.action_chunks(frames_events(spark, d).frames, 5)
    chunks = chunks.withColumn("chunk", F.transform("chunk", lambda r: F.transform(r, lambda x: x + F.col("frame_index"))))
    return w.temporal_ensemble(chunks, 0.1).withColumn("value", F.round("value", 6))


@query("W24_history_window", f"""WITH {EVENTS}, h(pos) AS (VALUES (0), (1), (2))
SELECT a.e AS episode_index, a.f AS frame_index, h.pos, b.v AS value
FROM fr a CROSS JOIN h JOIN fr b ON b.e = a.e AND b.f = greatest(0, a.f - 2 + h.pos)""")
def w24(spark, d):
    out = w.history_window(frames_events(spark, d).frames, "next.reward", 3)
    return out.select("episode_index", "frame_index", F.posexplode("`next.reward`").alias("pos", "value"))
