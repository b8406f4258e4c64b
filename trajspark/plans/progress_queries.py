"""Progress labels, annotations and weights over event episodes."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajspark.functions.columns import c
from trajspark.operators import progress as p
from trajspark.operators import stats as s
from trajspark.plans.dataset_queries import INTERVALS, intervals
from trajspark.plans.registry import EVENTS, query
from trajspark.sources.adapters import frames_events

STAGES = ["click", "error", "purchase", "signup", "view"]


@query("P3_stage_and_tau", f"""WITH {INTERVALS}, m AS (
  SELECT fr.e, fr.f, min(pos) FILTER (s <= f AND f <= x) AS hit, max(pos) FILTER (x < f) AS before, min(pos) FILTER (s > f) AS after, max(x) AS lastx
  FROM fr LEFT JOIN ivp ON ivp.e = fr.e GROUP BY fr.e, fr.f),
z AS (SELECT m.e, m.f, CASE WHEN m.f > m.lastx THEN 4 WHEN p.pos IS NULL THEN 0 ELSE list_position(['click', 'error', 'purchase', 'signup', 'view'], p.name) - 1 END AS stage,
  CASE WHEN m.f > m.lastx THEN 0.999 WHEN p.pos IS NULL THEN 0.0 WHEN m.hit IS NULL THEN 1.0 ELSE (m.f - p.s) / (p.x - p.s) END AS tau
  FROM m LEFT JOIN ivp p ON p.e = m.e AND p.pos = coalesce(m.hit, CASE WHEN after IS NOT NULL THEN before END))
SELECT e AS episode_index, f AS frame_index, CAST(stage AS INTEGER) AS stage, round(CAST(tau AS DOUBLE), 6) AS tau,
  round(CAST(CASE WHEN stage >= 4 AND tau >= 1 THEN 4.999 ELSE stage + tau END AS DOUBLE), 6) AS stage_tau FROM z""")
def p3(spark, d):
    ds = frames_events(spark, d)
    out = p.stage_and_tau(ds.frames, intervals(spark, d, ds), STAGES)
    return out.select("episode_index", "frame_index", "stage", F.round("tau", 6).alias("tau"), F.round("stage_tau", 6).alias("stage_tau"))


@query("P3_single_stage", f"WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, round(CAST(f / greatest(n - 1, 1) AS DOUBLE), 9) AS tau FROM fr")
def p3_single(spark, d):
    out = p.stage_and_tau(frames_events(spark, d).frames, None, ["task"])
    return out.select("episode_index", "frame_index", F.round("tau", 9).alias("tau"))


@query("P4_P5_normalize_stage_tau", f"""WITH {EVENTS}, x AS (SELECT e, f, k / 20.0 - 0.5 AS x FROM fr),
b(i, lo, hi) AS (VALUES (0, 0.0, 0.2), (1, 0.2, 0.5), (2, 0.5, 0.6), (3, 0.6, 1.0))
SELECT x.e AS episode_index, x.f AS frame_index, round(CAST(CASE WHEN x < 0 THEN 0 WHEN x >= 4 THEN 1 ELSE lo + (x - i) * (hi - lo) END AS DOUBLE), 6) AS progress
FROM x LEFT JOIN b ON b.i = greatest(0, least(3, floor(x.x)))""")
def p5(spark, d):
    x = c("observation.state")[1] / 20.0 - 0.5
    value = p.normalize_stage_tau(x, proportions={"a": 2.0, "b": 3.0, "c": 1.0, "d": 4.0}, names=["a", "b", "c", "d"])
    return frames_events(spark, d).frames.select("episode_index", "frame_index", F.round(value, 6).alias("progress"))


@query("P6_annotations", f"""WITH {INTERVALS} SELECT e AS episode_index, pos, name, CAST(s // 10 AS INTEGER) AS start_time, CAST(x // 10 AS INTEGER) AS end_time,
 CAST(floor(s / 10.0 * 10.0) AS BIGINT) AS start_frame, CAST(floor(x / 10.0 * 10.0) AS BIGINT) AS end_frame FROM ivp""")
def p6(spark, d):
    ds = frames_events(spark, d)
    iv = intervals(spark, d, ds).withColumns({"start_time": F.col("start_frame") / 10.0, "end_time": F.col("end_frame") / 10.0})
    return p.read_annotations(p.write_annotations(ds.episodes, iv, 10), "sparse")


@query("P7_auto_single_stage", f"WITH {EVENTS} SELECT DISTINCT e AS episode_index, CAST(0 AS BIGINT) AS pos, 'task' AS name, CAST(0 AS DOUBLE) AS start_time, CAST(n / 30.0 AS DOUBLE) AS end_time FROM fr")
def p7(spark, d):
    return p.auto_single_stage(frames_events(spark, d).episodes, 30)


WEIGHTS = f"""WITH {EVENTS}, g AS (SELECT e, f, n, CASE WHEN k >= 5 THEN k / 100.0 END AS p FROM fr),
d AS (SELECT a.e, a.f, b.p - a.p AS delta FROM g a JOIN g b ON b.e = a.e AND b.f = least(a.f + 4, a.n - 1)),
st AS (SELECT greatest(avg(delta), 0) AS m, greatest(stddev_pop(delta), 1e-6) AS s FROM d),
w AS (SELECT e, f, CASE WHEN delta IS NULL THEN 1.0 WHEN delta > 0.25 THEN 1.0
  WHEN delta >= 0 THEN greatest(0, least(1, (delta - (m - 2 * s)) / (4 * s + 1e-6))) ELSE 0.0 END AS w FROM d, st)"""


def _weights(spark, d):
    k = c("observation.state")[1]
    frames = frames_events(spark, d).frames.withColumn("progress_sparse", F.when(k >= 5, k / 100.0))
    return p.progress_weights(frames, "progress_sparse", 4, kappa=0.25)


@query("P1_progress_weights", WEIGHTS + " SELECT e AS episode_index, f AS frame_index, round(CAST(w AS DOUBLE), 6) AS weight FROM w")
def p1(spark, d):
    return _weights(spark, d).select("episode_index", "frame_index", F.round("weight", 6).alias("weight"))


@query("P2_batch_weights", WEIGHTS + """, b AS (SELECT e, f, w, f // 16 AS batch FROM w),
t AS (SELECT batch, sum(w) AS s, count(*) AS n, avg(w) AS m, CAST(sum(CASE WHEN w = 0 THEN 1 ELSE 0 END) AS BIGINT) AS z, CAST(sum(CASE WHEN w = 1 THEN 1 ELSE 0 END) AS BIGINT) AS o FROM b GROUP BY batch)
SELECT e AS episode_index, f AS frame_index, b.batch, round(CAST(w * t.n / (t.s + 1e-6) AS DOUBLE), 6) AS normalized, round(CAST(m AS DOUBLE), 6) AS raw_mean_weight,
 z AS num_zero_weight, o AS num_full_weight FROM b JOIN t ON t.batch = b.batch""")
def p2(spark, d):
    w = _weights(spark, d).withColumn("batch", F.floor(F.col("frame_index") / 16))
    out = p.normalize_batch_weights(w, "batch")
    return out.select("episode_index", "frame_index", "batch", F.round("normalized", 6).alias("normalized"), F.round("raw_mean_weight", 6).alias("raw_mean_weight"), "num_zero_weight", "num_full_weight")


@query("P8_score_frames", f"""WITH {EVENTS}, g AS (SELECT e, f, CASE WHEN (f % 5 = 0 OR is_last) AND k >= 10 THEN v * 2 END AS sc FROM fr),
h AS (SELECT e, f, last_value(CASE WHEN sc IS NOT NULL THEN f END IGNORE NULLS) OVER a AS bf, last_value(sc IGNORE NULLS) OVER a AS bv,
  first_value(CASE WHEN sc IS NOT NULL THEN f END IGNORE NULLS) OVER b AS af, first_value(sc IGNORE NULLS) OVER b AS av FROM g
  WINDOW a AS (PARTITION BY e ORDER BY f ROWS UNBOUNDED PRECEDING), b AS (PARTITION BY e ORDER BY f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))
SELECT e AS episode_index, f AS frame_index, round(CAST(CAST(CASE WHEN af IS NULL THEN bv WHEN bf IS NULL OR af = bf THEN av ELSE bv + (av - bv) * (f - bf) / (af - bf) END AS FLOAT) AS DOUBLE), 2) AS progress
FROM h WHERE af IS NOT NULL OR bf IS NOT NULL""")
def p8(spark, d):
    frames = frames_events(spark, d).frames.withColumns({"v": c("next.reward"), "k": c("observation.state")[1]})

    def model(pdf):
        if (pdf["k"] < 10).any():
            raise ValueError("out of range")
        return pdf["v"] * 2

    out = p.score_frames(frames, model, ["v", "k"], 5)
    return out.select("episode_index", "frame_index", F.round(F.col("progress").cast("double"), 2).alias("progress"))


@query("S18_subtask_proportions", f"""WITH {INTERVALS}, l AS (SELECT e, name, max_by(d, pos) AS d FROM ivp GROUP BY e, name), t AS (SELECT e, sum(d) AS t FROM ivp GROUP BY e),
a AS (SELECT name, avg(l.d / t.t) AS p FROM l JOIN t ON t.e = l.e GROUP BY name)
SELECT name, round(p / sum(p) OVER (), 9) AS proportion, CAST(list_position(['click', 'error', 'purchase', 'signup', 'view'], name) - 1 AS BIGINT) AS pos FROM a""")
def s18(spark, d):
    iv = intervals(spark, d).withColumn("duration", F.col("end_frame") - F.col("start_frame") + 1)
    return s.subtask_proportions(iv, STAGES).withColumn("proportion", F.round("proportion", 9))


@query("S19_subtask_counts", f"WITH {INTERVALS} SELECT name, count(*) AS n FROM ivp GROUP BY name")
def s19(spark, d):
    return s.value_distribution(intervals(spark, d), "name")
