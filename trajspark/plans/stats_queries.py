"""Statistics over episodes, vectors, rollouts and tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajspark.functions.columns import c
from trajspark.operators import stats as s
from trajspark.plans.registry import CONV, EVENTS, LINES, query
from trajspark.sources.adapters import frames_conv, frames_events, frames_lineitem, table

STATE = {"observation.state": {"dtype": "float64", "shape": [2], "names": ["value", "k"]}}
ACTION = {"action": {"dtype": "float64", "shape": [4], "names": ["quantity", "extendedprice", "discount", "tax"]}}
QS = ("q01", "q10", "q50", "q90", "q99")


def rounded(df, digits=6, names=("min", "max", "mean", "std", *QS), mean=None):
    """Round what both engines compute in a different order; means of few decimals need more digits to avoid ties."""
    return df.withColumns({n: F.round(c(n), mean if mean and n == "mean" else digits) for n in names if n in df.columns})


def long_events(keys="e AS episode_index"):
    return f"SELECT {keys}, 0 AS dim, v AS x FROM fr UNION ALL SELECT {keys}, 1, k FROM fr"


def histogram_sql(ctes: str, source: str, keys: list[str], digits: int = 6, feature: str | None = None, mean: int | None = None) -> str:
    """Moments and 5000-bin histogram quantiles per key of a long ``(keys, x)`` relation."""
    k = ", ".join(keys)
    on = " AND ".join(f"a.{x} = b.{x}" for x in keys)
    qs = []
    for name, q in zip(QS, (0.01, 0.1, 0.5, 0.9, 0.99)):
        qs.append(
            f"""round(CASE WHEN m.n < 2 THEN m.mean WHEN h{name}.bin = 0 THEN m.lo ELSE m.lo + h{name}.bin * m.w
  + ({q} * m.n - (h{name}.cum - h{name}.c)) / h{name}.c * m.w END, {digits}) AS {name}"""
        )
    joins = " ".join(
        f"JOIN (SELECT {k}, min({{'bin': bin, 'cum': cum, 'c': c}}) AS h FROM cum WHERE cum >= {q} * n GROUP BY {k}) j{name} ON "
        + " AND ".join(f"j{name}.{x} = m.{x}" for x in keys)
        for name, q in zip(QS, (0.01, 0.1, 0.5, 0.9, 0.99))
    )
    body = ", ".join(qs)
    for name in QS:
        body = body.replace(f"h{name}.", f"j{name}.h.")
    feat = f"'{feature}' AS feature, " if feature else ""
    return f"""WITH {ctes}, long AS ({source}),
m AS (SELECT {k}, min(x) AS mn, max(x) AS mx, avg(x) AS mean, stddev_pop(x) AS sd, count(*) AS n, min(x) - 1e-10 AS lo,
        max(x) + 1e-10 AS hi, ((max(x) + 1e-10) - (min(x) - 1e-10)) / 5000 AS w FROM long GROUP BY {k}),
b AS (SELECT {", ".join("a." + x for x in keys)}, b.n, CAST(CASE WHEN b.hi = b.lo THEN 0
        ELSE greatest(0, least(4999, floor((a.x - b.lo) / (b.hi - b.lo) * 5000))) END AS INTEGER) AS bin FROM long a JOIN m b ON {on}),
cnt AS (SELECT {k}, n, bin, count(*) AS c FROM b GROUP BY {k}, n, bin),
cum AS (SELECT *, CAST(sum(c) OVER (PARTITION BY {k} ORDER BY bin) AS BIGINT) AS cum FROM cnt)
SELECT {feat}{", ".join("m." + x for x in keys)}, round(m.mn, {digits}) AS "min", round(m.mx, {digits}) AS "max",
  round(m.mean, {mean or digits}) AS mean, round(CASE WHEN m.n < 2 THEN 0 ELSE m.sd END, {digits}) AS std, m.n AS "count", {body}
FROM m {joins}"""


def combined_sql(ctes: str, source: str) -> str:
    """Per-episode histogram statistics of a long relation combined to one row per dimension, rounded to 5 digits (mean 8)."""
    qs = ", ".join(f"round(sum(n * {q}) / sum(n), 5) AS {q}" for q in QS)
    return f"""WITH p AS (SELECT *, "count" AS n FROM ({histogram_sql(ctes, source, ["episode_index", "dim"], 13)}) h),
t AS (SELECT dim, sum(n * mean) / sum(n) AS mm FROM p GROUP BY dim)
SELECT 'observation.state' AS feature, p.dim, round(min("min"), 5) AS "min", round(max("max"), 5) AS "max", round(sum(n * mean) / sum(n), 8) AS mean,
 round(sqrt(sum(n * (std * std + (mean - mm) * (mean - mm))) / sum(n)), 5) AS std, CAST(sum(n) AS BIGINT) AS "count", {qs}
FROM p JOIN t ON t.dim = p.dim GROUP BY p.dim"""


@query("S1_S2_episode_stats", histogram_sql(EVENTS, long_events(), ["episode_index", "dim"], 5, mean=8))
def episode_stats(spark, d):
    out = s.episode_stats(frames_events(spark, d).frames, STATE)
    return rounded(out, 5, mean=8).drop("feature")


LONG_LINES = " UNION ALL ".join(f"SELECT e AS episode_index, {i} AS dim, a{i} AS x FROM fr" for i in range(4))


@query("S4_small_episode_stats", histogram_sql(LINES, LONG_LINES, ["episode_index", "dim"], 3, mean=7))
def small_episode_stats(spark, d):
    out = s.episode_stats(frames_lineitem(spark, d).frames, ACTION)
    return rounded(out, 3, mean=7).drop("feature")


@query("S9_dataset_stats_axis_0", histogram_sql(EVENTS, long_events("0 AS z"), ["dim"], 5, "observation.state", mean=8))
def axis_0(spark, d):
    return rounded(s.stats_by_axis(frames_events(spark, d).frames, STATE, 0), 5, mean=8)


@query("S9_dataset_stats_axis_none", histogram_sql(EVENTS, "SELECT 0 AS dim, v AS x FROM fr UNION ALL SELECT 0, k FROM fr", ["dim"], 5, "observation.state", mean=8))
def axis_none(spark, d):
    return rounded(s.stats_by_axis(frames_events(spark, d).frames, STATE, None), 5, mean=8)


@query("S9_vector_stats_axis_1", histogram_sql("z AS (SELECT 1)", 'SELECT vec_id AS "index", CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings', ['"index"'], 6))
def axis_1(spark, d):
    rows = table(spark, d, "embeddings").withColumnRenamed("vec_id", "index")
    return rounded(s.stats_by_axis(rows, {"embedding": {"dtype": "float32", "shape": [64]}}, 1))


@query("S1_label_vector_stats", """WITH x AS (SELECT label, generate_subscripts(embedding, 1) - 1 AS dim, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings)
SELECT CAST(label AS BIGINT) AS episode_index, CAST(dim AS INTEGER) AS dim, round(min(x), 6) AS "min", round(max(x), 6) AS "max",
 round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, count(*) AS "count", round(quantile_cont(x, 0.5), 6) AS q50 FROM x GROUP BY label, dim""")
def label_vectors(spark, d):
    rows = table(spark, d, "embeddings").select(F.col("label").cast("long").alias("episode_index"), F.col("vec_id").alias("frame_index"), "embedding")
    out = s.episode_stats(rows, {"embedding": {"dtype": "float32", "shape": [64]}}, quantiles=(0.5,), mode="exact")
    return rounded(out).drop("feature")


S5 = """, x AS (SELECT e, 0 AS dim, v AS x FROM fr UNION ALL SELECT e, 1, k FROM fr),
p AS (SELECT e, dim, min(x) AS mn, max(x) AS mx, avg(x) AS m, stddev_pop(x) AS sd, count(*) AS n, quantile_cont(x, 0.1) AS q FROM x GROUP BY e, dim),
t AS (SELECT dim, sum(n * m) / sum(n) AS mm FROM p GROUP BY dim)
SELECT 'observation.state' AS feature, p.dim, round(min(mn), 5) AS "min", round(max(mx), 5) AS "max", round(sum(n * m) / sum(n), 5) AS mean,
 round(sqrt(sum(n * (sd * sd + (m - mm) * (m - mm))) / sum(n)), 5) AS std, CAST(sum(n) AS BIGINT) AS "count", round(sum(n * q) / sum(n), 5) AS q10
FROM p JOIN t ON t.dim = p.dim GROUP BY p.dim"""


@query("S5_combine_stats", f"WITH {EVENTS}{S5}")
def combine(spark, d):
    parts = s.episode_stats(frames_events(spark, d).frames, STATE, quantiles=(0.1,), mode="exact")
    return rounded(s.combine_stats(parts), 5)


@query("S10_augment_quantiles", combined_sql(EVENTS, long_events()))
def augment(spark, d):
    return rounded(s.augment_quantiles(frames_events(spark, d).frames, STATE, None), 5, mean=8)


@query("S6_validate_stats", f"""WITH {EVENTS} SELECT 'observation.state' AS feature, 'missing value' AS violation FROM fr WHERE false
UNION ALL SELECT 'camera', 'image stats must have shape (3,1,1)'""")
def validate(spark, d):
    good = s.dataset_quantiles(frames_events(spark, d).frames, STATE)
    image = good.withColumn("feature", F.lit("camera"))
    return s.validate_stats(good.unionByName(image), {**STATE, "camera": {"dtype": "image", "shape": [3, 8, 8]}})


@query("S8_sampled_frames", f"""WITH {EVENTS}, k AS (
  SELECT e, n, greatest(least(40, n), least(CAST(floor(pow(n, 0.75)) AS BIGINT), 10000)) AS k FROM (SELECT DISTINCT e, n FROM fr)),
big AS (SELECT e, n, greatest(least(100, n), least(CAST(floor(pow(n, 0.75)) AS BIGINT), 10000)) AS k FROM k),
ix AS (SELECT DISTINCT e, CAST(round_even(CAST(j * CASE WHEN k > 1 THEN (n - 1) / (k - 1) ELSE 0 END AS DOUBLE), 0) AS BIGINT) AS f
  FROM big, unnest(range(k)) u(j))
SELECT a.e AS episode_index, a.f AS frame_index, a.v AS reward FROM fr a JOIN ix ON ix.e = a.e AND ix.f = a.f""")
def sampled(spark, d):
    ds = frames_events(spark, d)
    return s.sampled_frames(ds.frames, ds.episodes).select("episode_index", "frame_index", c("next.reward").alias("reward"))


@query("S8_sample_indices", """SELECT n_chars AS n, greatest(least(100, n_chars), least(CAST(floor(pow(n_chars, 0.75)) AS BIGINT), 10000)) AS k,
 CAST(round_even(CAST((greatest(least(100, n_chars), least(CAST(floor(pow(n_chars, 0.75)) AS BIGINT), 10000)) // 2)
  * CASE WHEN n_chars > 1 THEN (n_chars - 1) / (greatest(least(100, n_chars), least(CAST(floor(pow(n_chars, 0.75)) AS BIGINT), 10000)) - 1) ELSE 0 END AS DOUBLE), 0) AS BIGINT) AS middle
FROM documents""")
def sample_indices(spark, d):
    n = F.col("n_chars")
    rows = table(spark, d, "documents").select(n.alias("n"), s.sample_size(n).alias("k"), s.sample_indices(n).alias("_i"))
    return rows.select("n", "k", F.get("_i", F.floor(F.col("k") / 2).cast("int")).alias("middle"))


def rollouts(spark, d):
    """Orders as rollouts: one step per line, done at the first returned line, success above a price."""
    frames = frames_lineitem(spark, d)
    orders = table(spark, d, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderpriority").alias("task_group"), F.col("o_orderstatus").alias("task_name"))
    episodes = frames.episodes.join(orders, "l_orderkey").select("episode_index", "task_group", "task_name")
    steps = frames.frames.select(
        "episode_index",
        F.col("frame_index").alias("step"),
        c("action")[1].alias("reward"),
        F.col("task").startswith("R").alias("done"),
        (c("action")[0] > 40).alias("success"),
    )
    return steps, episodes


ROLL = f"""WITH {LINES}, st AS (SELECT e, f, a1 AS reward, task[1] = 'R' AS done, a0 > 40 AS success, l_orderkey FROM fr),
fd AS (SELECT e, min(CASE WHEN done THEN f END) AS fd, any_value(l_orderkey) AS k FROM st GROUP BY e),
ret AS (SELECT st.e, sum(reward) AS s, max(reward) AS m, bool_or(success) AS ok FROM st JOIN fd ON fd.e = st.e WHERE fd IS NULL OR f <= fd GROUP BY st.e)"""


@query("S11_rollout_returns", ROLL + " SELECT e AS episode_index, round(s, 2) AS sum_reward, m AS max_reward, ok AS success FROM ret")
def returns(spark, d):
    return s.rollout_returns(rollouts(spark, d)[0]).withColumn("sum_reward", F.round("sum_reward", 2))


@query("S11_rollout_returns_reference_mask", f"""WITH {LINES}, st AS (SELECT e, f, a1 AS reward, task[1] = 'R' AS done, a0 > 40 AS success FROM fr),
fd AS (SELECT e, coalesce(min(CASE WHEN done THEN f END), 0) + 1 AS fd FROM st GROUP BY e)
SELECT st.e AS episode_index, round(sum(CASE WHEN f <= fd THEN reward ELSE 0 END), 2) AS sum_reward,
 max(CASE WHEN f <= fd THEN reward ELSE 0 END) AS max_reward, bool_or(success AND f <= fd) AS success FROM st JOIN fd ON fd.e = st.e GROUP BY st.e""")
def returns_masked(spark, d):
    return s.rollout_returns(rollouts(spark, d)[0], reference_mask=True).withColumn("sum_reward", F.round("sum_reward", 2))


@query("S11_eval_summary", ROLL + """ SELECT o_orderpriority AS task_group, o_orderstatus AS task, count(*) AS n_episodes, round(avg(s), 4) AS avg_sum_reward,
 round(avg(m), 4) AS avg_max_reward, round(avg(CAST(ok AS DOUBLE)) * 100, 6) AS pc_success
FROM ret JOIN fd ON fd.e = ret.e JOIN orders ON o_orderkey = fd.k GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def summary(spark, d):
    steps, episodes = rollouts(spark, d)
    joined = s.rollout_returns(steps).join(episodes.withColumnRenamed("task_name", "task"), "episode_index")
    out = s.eval_summary(joined)
    return out.withColumns({"avg_sum_reward": F.round("avg_sum_reward", 4), "avg_max_reward": F.round("avg_max_reward", 4), "pc_success": F.round("pc_success", 6)})


@query("S14_fps_metrics", f"""WITH {EVENTS} SELECT e AS episode_index, count(*) AS n,
 round(CASE WHEN max(t) - min(t) > 1e-6 THEN (count(*) - 1) / (max(t) - min(t)) ELSE 0 END, 12) AS avg_fps FROM fr GROUP BY e""")
def fps(spark, d):
    return s.fps_metrics(frames_events(spark, d).frames, ["episode_index"], "timestamp").withColumn("avg_fps", F.round("avg_fps", 12))


@query("S15_progress_stats", f"""WITH {EVENTS} SELECT count(*) AS "count", round(avg(v), 6) AS mean, round(stddev_samp(v), 6) AS std, min(v) AS "min", max(v) AS "max" FROM fr""")
def progress(spark, d):
    return rounded(s.progress_stats(frames_events(spark, d).frames, "next.reward"), 6, ("mean", "std"))


@query("S16_token_length_stats", """WITH t AS (SELECT length(text) - length(replace(text, ' ', '')) + 1 AS n FROM documents)
SELECT round(avg(n), 6) AS mean, min(n) AS "min", max(n) AS "max", round(quantile_cont(n, 0.99), 6) AS p99, round(640 / avg(n), 6) AS compression_ratio FROM t""")
def token_lengths(spark, d):
    rows = table(spark, d, "documents").select(F.split("text", " ").alias("tokens"))
    return rounded(s.token_length_stats(rows, "tokens", 16, 40), 6, ("mean", "p99", "compression_ratio"))


@query("S20_joint_limits", f"""WITH {LINES} SELECT 0 AS dim, min(a0) AS "min", max(a0) AS "max" FROM fr UNION ALL SELECT 1, min(a1), max(a1) FROM fr
UNION ALL SELECT 2, min(a2), max(a2) FROM fr UNION ALL SELECT 3, min(a3), max(a3) FROM fr""")
def limits(spark, d):
    return s.joint_limits(frames_lineitem(spark, d).frames, "action")


@query("S21_rate_stats", f"""WITH {EVENTS} SELECT task, round(avg(1 / v), 6) AS avg_rate, round(quantile_cont(1 / v, 0.9), 6) AS p90_rate
FROM fr WHERE v > 0 GROUP BY task""")
def rates(spark, d):
    out = s.rate_stats(frames_events(spark, d).frames, "next.reward", ["task"])
    return rounded(out, 6, ("avg_rate", "p90_rate"))


@query("S19_task_distribution", f"WITH {CONV} SELECT task, count(*) AS n FROM fr GROUP BY task")
def task_distribution(spark, d):
    return s.value_distribution(frames_conv(spark, d).frames, "task")


@query("S19_episode_length_distribution", f"WITH {LINES} SELECT length, count(*) AS n FROM (SELECT DISTINCT e, n AS length FROM fr) GROUP BY length")
def length_distribution(spark, d):
    return s.value_distribution(frames_lineitem(spark, d).episodes, "length")


def images(spark, d):
    """Embeddings as raw 1 x 8 x 8 byte images."""
    pixel = F.transform("embedding", lambda x: F.greatest(F.lit(0), F.least(F.lit(255), F.floor((x.cast("double") + 0.5) * 255))).cast("int"))
    return table(spark, d, "embeddings").select(F.col("vec_id").alias("index"), F.col("label").alias("camera"), pixel.alias("pixels"))


IMAGES = """px AS (SELECT vec_id AS i, label, generate_subscripts(embedding, 1) - 1 AS p,
 greatest(0, least(255, CAST(floor((CAST(unnest(embedding) AS DOUBLE) + 0.5) * 255) AS INTEGER))) AS x FROM embeddings)"""


@query("S7_image_stats", histogram_sql(IMAGES, "SELECT label AS camera, 0 AS dim, CAST(x AS DOUBLE) AS x FROM px", ["camera", "dim"], 12)
       .replace('round(m.mn, 12)', 'round(m.mn / 255, 6)').replace('round(m.mx, 12)', 'round(m.mx / 255, 6)').replace('round(m.mean, 12)', 'round(m.mean / 255, 6)')
       .replace('ELSE m.sd END, 12)', 'ELSE m.sd / 255 END, 6)').replace('* m.w END, 12)', '* m.w END / 255, 6)').replace('m.n AS "count"', 'm.n // 64 AS "count"'))
def image_stats(spark, d):
    return rounded(s.image_stats(images(spark, d), "pixels", 1, 8, 8, ["camera"]), 6)


@query("S17_image_quality_report", f"""WITH {IMAGES}, q AS (SELECT i, label, avg(((x - (x // 16) * 16) / 255.0) * ((x - (x // 16) * 16) / 255.0)) AS mse FROM px GROUP BY i, label)
SELECT label AS camera, count(*) AS frames, round(avg(mse), 9) AS avg_mse, round(avg(CASE WHEN mse > 0 THEN 10 * log10(1 / mse) END), 6) AS avg_psnr,
 round(count(*) * 32 / (count(*) * 64), 6) AS size_ratio, round(count(*) * 0.5 / count(*), 6) AS load_time_ratio FROM q GROUP BY label""")
def image_quality(spark, d):
    scale = lambda x: x / 255.0
    pairs = images(spark, d).select(
        "camera",
        F.transform("pixels", scale).alias("original"),
        F.transform("pixels", lambda x: F.floor(x / 16) * 16 / 255.0).alias("decoded"),
        F.lit(32).alias("video_bytes"),
        F.lit(64).alias("image_bytes"),
        F.lit(0.5).alias("video_load_s"),
        F.lit(1.0).alias("image_load_s"),
    )
    out = s.image_quality_report(pairs, ["camera"])
    return out.withColumns({"avg_mse": F.round("avg_mse", 9), "avg_psnr": F.round("avg_psnr", 6), "size_ratio": F.round("size_ratio", 6), "load_time_ratio": F.round("load_time_ratio", 6)})
