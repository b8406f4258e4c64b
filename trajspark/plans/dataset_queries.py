"""Lookups, schema work, packing and whole-dataset edits."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajspark.dataset import CHUNK_FILES
from trajspark.functions.columns import c
from trajspark.operators import algebra as a
from trajspark.operators import joins as j
from trajspark.operators import packing as k
from trajspark.operators import schema as b
from trajspark.operators import stats as s
from trajspark.plans.registry import CONV, EVENTS, LINES, query
from trajspark.plans.stats_queries import ACTION, STATE, combined_sql, images, long_events, rounded
from trajspark.sources.adapters import frames_conv, frames_events, frames_lineitem, table

KEYS = ["episode_index", "frame_index", "index", "task_index"]
IDS = "e AS episode_index, f AS frame_index"


# ---------------------------------------------------------------- joins


@query("J1_task_text", f'WITH {EVENTS} SELECT i AS "index", task_index, task FROM fr')
def j1(spark, d):
    ds = frames_events(spark, d)
    return j.with_task_text(ds.frames.drop("task"), ds.tasks).select("index", "task_index", "task")


@query("J2_subtask_text", f'WITH {CONV} SELECT i AS "index", task_index AS subtask_index, upper(task) AS subtask FROM fr')
def j2(spark, d):
    ds = frames_conv(spark, d)
    subtasks = ds.tasks.select(F.col("task_index").alias("subtask_index"), F.upper("task").alias("subtask"))
    return j.with_subtask_text(ds.frames.withColumnRenamed("task_index", "subtask_index"), subtasks).select("index", "subtask_index", "subtask")


@query("J3_frame_to_episode", f"""WITH {EVENTS} SELECT x.o AS "index", coalesce(fr.e, 0) AS episode_index
FROM (SELECT l_orderkey * 3 AS o FROM lineitem) x LEFT JOIN fr ON fr.i = x.o""")
def j3(spark, d):
    asked = table(spark, d, "lineitem").select((F.col("l_orderkey") * 3).alias("index"))
    return j.frame_to_episode(asked, frames_events(spark, d).episodes).select("index", "episode_index")


@query("J4_index_join", f"""WITH {EVENTS} SELECT fr.i AS "index", fr.v AS reward, CAST(event_id AS BIGINT) AS extra
FROM fr JOIN events ON event_id = fr.i""")
def j4(spark, d):
    values = table(spark, d, "events").select(F.col("event_id").alias("index"), F.col("event_id").alias("extra"))
    return j.index_join(frames_events(spark, d).frames, values, "inner").select("index", c("next.reward").alias("reward"), "extra")


@query("J5_nearest_frame", f"""WITH {EVENTS}, q AS (SELECT e, f, i, t + 7000.0 * ((f % 5) - 2) AS q FROM fr),
m AS (SELECT q.e, q.f, q.q, min({{'d': abs(fr.t - q.q), 't': fr.t, 'f': fr.f}}) FILTER (abs(fr.t - q.q) < 12000.0) AS b
  FROM q JOIN fr ON fr.e = q.e GROUP BY q.e, q.f, q.q)
SELECT e AS episode_index, f AS frame_index, b.f AS nearest_frame, round(b.d, 4) AS distance, b IS NULL AS is_violation FROM m""")
def j5(spark, d):
    frames = frames_events(spark, d).frames
    asked = frames.select("episode_index", "frame_index", "index", (F.col("timestamp") + 7000.0 * (F.col("frame_index") % 5 - 2)).alias("query_time"))
    out = j.nearest_frame(asked, frames, 12000.0, "index")
    return out.select("episode_index", "frame_index", "nearest_frame", F.round("distance", 4).alias("distance"), "is_violation")


# Subtask intervals: runs of equal event type of at least two rows.
INTERVALS = f"""{EVENTS}, g AS (SELECT *, f - row_number() OVER (PARTITION BY e, task ORDER BY f) AS g FROM fr),
iv AS (SELECT e, task AS name, min(f) AS s, max(f) AS x, count(*) AS d FROM g GROUP BY e, task, g HAVING count(*) >= 2),
ivp AS (SELECT *, row_number() OVER (PARTITION BY e ORDER BY s) - 1 AS pos FROM iv)"""


def intervals(spark, d, ds=None):
    from trajspark.operators.progress import runs

    ds = ds or frames_events(spark, d)
    return runs(ds.frames, "task", at_least=2)


@query("J7_subtask_of_frame", f"""WITH {INTERVALS}, m AS (
  SELECT fr.e, fr.f, min(pos) FILTER (s <= f AND f <= x) AS hit,
    max(pos) FILTER (x < f) AS before, min(pos) FILTER (s > f) AS after FROM fr LEFT JOIN ivp ON ivp.e = fr.e GROUP BY fr.e, fr.f)
SELECT m.e AS episode_index, m.f AS frame_index, p.name AS subtask,
  round(CASE WHEN p.pos IS NULL THEN NULL WHEN m.hit IS NULL THEN 1.0 ELSE (m.f - p.s) / (p.x - p.s) END, 6) AS tau
FROM m LEFT JOIN ivp p ON p.e = m.e AND p.pos = coalesce(m.hit, CASE WHEN after IS NOT NULL THEN before END)""")
def j7(spark, d):
    ds = frames_events(spark, d)
    out = j.subtask_of_frame(ds.frames, intervals(spark, d, ds))
    return out.select("episode_index", "frame_index", "subtask", F.round("tau", 6).alias("tau"))


@query("J8_common_columns_union", f"""SELECT 0 AS dataset_index, e AS episode_index, f AS frame_index, task FROM (WITH {EVENTS} SELECT e, f, task FROM fr)
UNION ALL SELECT 1, e, f, task FROM (WITH {CONV} SELECT e, f, task FROM fr)""")
def j8(spark, d):
    out = j.common_columns_union([frames_events(spark, d).frames, frames_conv(spark, d).frames])
    return out.select("dataset_index", "episode_index", "frame_index", "task")


@query("U2_common_columns", f"""WITH x AS (SELECT 0 AS dataset_index, * FROM (WITH {EVENTS} SELECT e, f, i, task_index, task, n, t FROM fr)
 UNION ALL SELECT 1, * FROM (WITH {CONV} SELECT e, f, i, task_index, task, n, CAST(f AS DOUBLE) FROM fr))
SELECT dataset_index, name, count(CASE name WHEN 'timestamp' THEN CAST(t AS VARCHAR) WHEN 'task' THEN task WHEN 'task_index' THEN CAST(task_index AS VARCHAR) ELSE CAST(i AS VARCHAR) END) AS "values"
FROM x CROSS JOIN (VALUES ('timestamp'), ('frame_index'), ('episode_index'), ('index'), ('task_index'), ('task'), ('episode_length')) c(name) GROUP BY dataset_index, name""")
def u2(spark, d):
    out = j.common_columns_union([frames_events(spark, d).frames, frames_conv(spark, d).frames])
    names = [n for n in out.columns if n != "dataset_index"]
    counts = out.groupBy("dataset_index").agg(*[F.count(c(n)).alias(n) for n in names])
    return counts.unpivot("dataset_index", names, "name", "values")


@query("B14_compat", """WITH u AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY ALL),
s AS (SELECT row_number() OVER (ORDER BY event_type) - 1 AS i, max(n) AS fps, chr(39) || 'arm-' || count(*) % 2 || chr(39) AS robot, count(*) AS width FROM u GROUP BY event_type)
SELECT problem FROM (SELECT unnest([
 CASE WHEN b.fps <> a.fps THEN 'dataset ' || b.i || ': fps is ' || b.fps || ', expected ' || a.fps END,
 CASE WHEN b.robot <> a.robot THEN 'dataset ' || b.i || ': robot_type is ' || b.robot || ', expected ' || a.robot END,
 CASE WHEN b.width <> a.width THEN 'dataset ' || b.i || ': features differ' END]) AS problem
FROM s a JOIN s b ON a.i = 0 AND b.i > 0) WHERE problem IS NOT NULL""")
def b14(spark, d):
    """One data set per event type; most events of a user stand for its rate, its users for the kind and width."""
    per_user = table(spark, d, "events").groupBy("event_type", "user_id").count()
    found = per_user.groupBy("event_type").agg(F.max("count").alias("fps"), F.count(F.lit(1)).alias("users")).sort("event_type").collect()
    specs = [{"fps": r.fps, "robot_type": f"arm-{r.users % 2}", "features": {"users": {"dtype": "int64", "shape": (r.users,), "info": r.event_type}}} for r in found]
    return spark.createDataFrame([(p,) for p in b.compat_problems(specs)], "problem string")


@query("J9_missing_units", "SELECT o_orderkey AS unit FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def j9(spark, d):
    expected = table(spark, d, "orders").select(F.col("o_orderkey").alias("unit"))
    done = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("unit"))
    return j.missing_units(expected, done, "unit")


# ---------------------------------------------------------------- schema and columns


@query("B1_filter_episodes", f'WITH {EVENTS} SELECT {IDS}, i AS "index" FROM fr WHERE e IN (1, 3, 5, 7, 11)')
def b1(spark, d):
    return b.subset(frames_events(spark, d), [1, 3, 5, 7, 11]).frames.select("episode_index", "frame_index", "index")


@query("B1_filter_episodes_by_table", f"""WITH {EVENTS} SELECT {IDS}, i AS "index" FROM fr WHERE e IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def b1_table(spark, d):
    ids = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("episode_index"))
    return b.filter_episodes(frames_events(spark, d).frames, ids).select("episode_index", "frame_index", "index")


@query("B3_B4_modify_features", f"""WITH {EVENTS} SELECT {IDS}, k AS extra, round(v * 2, 6) AS doubled FROM fr""")
def b4(spark, d):
    ds = frames_events(spark, d)
    values = ds.frames.select("index", F.array(c("observation.state")[1]).alias("value"))
    one = {"dtype": "float64", "shape": [1]}
    out = b.modify_features(ds, add={"extra": (values, one), "doubled": (c("next.reward") * 2, one)}, remove=["observation.state", "action"])
    return out.frames.select("episode_index", "frame_index", "extra", F.round("doubled", 6).alias("doubled"))


@query("B3_X1_row_function", f"WITH {EVENTS} SELECT {IDS}, round(v + e * 1000 + f, 6) AS label FROM fr")
def x1(spark, d):
    ds = b.subset_columns(frames_events(spark, d), ["next.reward"])
    fn = lambda row, e, f: row["next.reward"] + e * 1000 + f
    out = b.add_features(ds, {"label": (fn, {"dtype": "float64", "shape": [1]})})
    return out.frames.select("episode_index", "frame_index", F.round("label", 6).alias("label"))


@query("B5_rename", f"WITH {EVENTS} SELECT {IDS}, v AS reward FROM fr")
def b5(spark, d):
    return b.rename_columns(frames_events(spark, d).frames, {"next.reward": "reward"}).select("episode_index", "frame_index", "reward")


@query("B6_validate_frames", f"""WITH {LINES} SELECT {IDS}, 'feature action does not have shape (4,)' AS message FROM fr WHERE a0 > 45""")
def b6(spark, d):
    ds = frames_lineitem(spark, d)
    cut = ds.frames.withColumn("action", F.when(c("action")[0] > 45, F.slice("action", 1, 3)).otherwise(c("action")))
    bad = b.validate_frames(cut, {k: v for k, v in ds.features.items() if k != "timestamp"})
    return bad.select("episode_index", "frame_index", F.explode("messages").alias("message"))


@query("B7_validate_episodes", f"WITH {CONV} SELECT e AS episode_index, n AS \"rows\", 'episode_index is already used' AS message FROM (SELECT DISTINCT e, n FROM fr WHERE e < 10)")
def b7(spark, d):
    out = b.validate_episodes(frames_conv(spark, d).frames, total_episodes=10)
    return out.select("episode_index", "rows", F.explode("messages").alias("message"))


@query("B8_B9_vectors", "SELECT l_orderkey AS k, CAST(CAST(l_quantity AS FLOAT) AS DOUBLE) AS qty, CAST(CAST(l_tax AS FLOAT) AS DOUBLE) AS tax FROM lineitem")
def b8(spark, d):
    raw = table(spark, d, "lineitem")
    packed = b.build_vectors(raw, {"action": {"dtype": "float32", "shape": [2], "names": ["l_quantity", "l_tax"]}}, keep=["l_orderkey"])
    out = b.unpack_vector(packed, "action", ["qty", "tax"])
    return out.select(F.col("l_orderkey").alias("k"), F.col("qty").cast("double").alias("qty"), F.col("tax").cast("double").alias("tax"))


@query("B11_align_vectors", f"""WITH {EVENTS} SELECT 0 AS src, {IDS}, v AS "value", k, CAST(NULL AS DOUBLE) AS length FROM fr
UNION ALL SELECT 1, {IDS}, CAST(NULL AS DOUBLE), k, CAST(n AS DOUBLE) FROM fr""")
def b11(spark, d):
    frames = frames_events(spark, d).frames
    first = frames.select(F.lit(0).alias("src"), "episode_index", "frame_index", "`observation.state`")
    second = frames.select(F.lit(1).alias("src"), "episode_index", "frame_index", F.array(F.col("episode_length").cast("double"), c("observation.state")[1]).alias("observation.state"))
    other = {"observation.state": {"dtype": "float64", "shape": [2], "names": ["length", "k"]}}
    out = b.align_vectors([(first, STATE), (second, other)])
    return b.unpack_vector(out, "observation.state", ["value", "k", "length"])


@query("B13_select_features", f'WITH {EVENTS} SELECT {IDS}, v AS "value" FROM fr')
def b13(spark, d):
    frames = b.unpack_vector(frames_events(spark, d).frames, "observation.state", ["observation.state.value", "observation.state.k"])
    return b.select_feature_columns(frames, ["value$"], keep=["episode_index", "frame_index"])


@query("B16_regroup_transition", f"""WITH {EVENTS} SELECT i AS "index", v AS reward, done, false AS truncated, k, task FROM fr""")
def b16(spark, d):
    t = b.regroup_transition(frames_events(spark, d).frames)
    flat = b.ungroup_transition(t)
    return flat.select("index", c("next.reward").alias("reward"), c("next.done").alias("done"), c("next.truncated").alias("truncated"), c("observation.state")[1].alias("k"), "task")


@query("B18_standardise_observation", """WITH px AS (SELECT vec_id, generate_subscripts(embedding, 1) - 1 AS p,
 greatest(0, least(255, CAST(floor((CAST(unnest(embedding) AS DOUBLE) + 0.5) * 255) AS INTEGER))) AS x FROM embeddings)
SELECT vec_id, p // 8 AS y, p % 8 AS x, round(CAST(CAST(px.x / 255.0 AS FLOAT) AS DOUBLE), 5) AS v FROM px""")
def b18(spark, d):
    rows = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda y: F.transform(F.slice("pixels", y * 8 + 1, 8), lambda p: F.array(p)))
    df = images(spark, d).select(F.col("index").alias("vec_id"), rows.alias("pixels"))
    out = b.standardise_observation(df, (8, 8, 1))
    flat = out.select("vec_id", F.posexplode(F.flatten(c("observation.image")[0])).alias("_p", "_v"))
    return flat.select("vec_id", F.floor(F.col("_p") / 8).alias("y"), (F.col("_p") % 8).cast("long").alias("x"), F.round(F.col("_v").cast("double"), 5).alias("v"))


@query("B19_B20_state_vectors", f"""WITH {EVENTS}, p(pos) AS (SELECT unnest(range(4)))
SELECT {IDS}, CAST(pos AS INTEGER) AS pos, round(CAST(CAST(CASE pos WHEN 0 THEN v WHEN 1 THEN v WHEN 2 THEN k ELSE 0 END AS FLOAT) AS DOUBLE), 3) AS x, pos < 3 AS is_real FROM fr CROSS JOIN p""")
def b20(spark, d):
    df = b.concat_state(frames_events(spark, d).frames, ["action", "observation.state"], "state")
    z = F.arrays_zip(b.pad_or_truncate(c("state"), 4).alias("x"), b.pad_mask(c("state"), 4).alias("m"))
    rows = df.select("episode_index", "frame_index", F.posexplode(z).alias("pos", "_z"))
    return rows.select("episode_index", "frame_index", "pos", F.round(F.col("_z.x").cast("double"), 3).alias("x"), F.col("_z.m").alias("is_real"))


@query("B21_B22_pad_horizon", f"""WITH {LINES}, h(pos) AS (SELECT unnest(range(6)))
SELECT {IDS}, CAST(pos AS INTEGER) AS pos, CASE pos WHEN 0 THEN a0 WHEN 1 THEN a1 WHEN 2 THEN a2 ELSE a3 END AS action, 7 AS domain_id FROM fr CROSS JOIN h""")
def b21(spark, d):
    df = b.add_constant_column(frames_lineitem(spark, d).frames, "domain_id", 7)
    return df.select("episode_index", "frame_index", F.posexplode(b.pad_horizon(c("action"), 6)).alias("pos", "action"), "domain_id")


@query("B23_long_series", f"""WITH {EVENTS} SELECT {IDS}, 'state/0' AS entity, v AS "value" FROM fr UNION ALL SELECT {IDS}, 'state/1', k FROM fr
UNION ALL SELECT {IDS}, 'action/0', v FROM fr UNION ALL SELECT {IDS}, 'next.done', CAST(done AS DOUBLE) FROM fr UNION ALL SELECT {IDS}, 'next.reward', v FROM fr""")
def b23(spark, d):
    out = b.to_long_series(frames_events(spark, d).frames, {"state": "observation.state", "action": "action"}, ["next.done", "next.reward", "next.success"])
    return out.drop("timestamp")


@query("B24_nan_check", f"""WITH {EVENTS} SELECT i AS "index", 'state' AS nan_column FROM fr WHERE k > 90 UNION ALL SELECT i, 'action' FROM fr WHERE v < 1""")
def b24(spark, d):
    f = frames_events(spark, d).frames
    nan = F.lit(float("nan"))
    rows = f.select(
        "index",
        F.transform("`observation.state`", lambda x: F.when(c("observation.state")[1] > 90, nan).otherwise(x)).alias("state"),
        F.transform("action", lambda x: F.when(x < 1, nan).otherwise(x)).alias("action"),
    )
    return b.nan_check(rows, ["state", "action"]).select("index", F.explode("nan_columns").alias("nan_column"))


# ---------------------------------------------------------------- packing




def walk_sql(ctes: str, size: str, cond: str, extra: str = "") -> str:
    """Greedy packing as a recursive walk over the episodes."""
    return f"""WITH RECURSIVE {ctes}, s AS (SELECT DISTINCT e, n, {size} AS sz FROM fr),
w(e, g, held, cnt, frames) AS (SELECT e, 0, sz, 1, n FROM s WHERE e = 0
 UNION ALL SELECT s.e, CASE WHEN {cond} THEN w.g + 1 ELSE w.g END, CASE WHEN {cond} THEN s.sz ELSE w.held + s.sz END,
   CASE WHEN {cond} THEN 1 ELSE w.cnt + 1 END, CASE WHEN {cond} THEN s.n ELSE w.frames + s.n END FROM w JOIN s ON s.e = w.e + 1)"""


@query("K1_pack_files", walk_sql(EVENTS, "n * 1000", "w.held + s.sz >= 524288") + ' SELECT e AS episode_index, CAST(g // 4 AS BIGINT) AS chunk_index, CAST(g % 4 AS BIGINT) AS file_index FROM w')
def k1(spark, d):
    e = frames_events(spark, d).episodes.withColumn("bytes", F.col("length") * 1000)
    return k.pack_files(e, "bytes", 0.5, 4, names=("chunk_index", "file_index")).select("episode_index", "chunk_index", "file_index")


@query("K2_pack_videos", walk_sql(EVENTS, "n * 2000", "w.held + s.sz >= 1048576") + """, t AS (SELECT w.e, g, n / 30.0 AS dur FROM w JOIN s ON s.e = w.e)
SELECT e AS episode_index, CAST(g AS BIGINT) AS file_index, round(CAST(sum(dur) OVER (PARTITION BY g ORDER BY e) - dur AS DOUBLE), 6) AS from_timestamp,
 round(CAST(sum(dur) OVER (PARTITION BY g ORDER BY e) AS DOUBLE), 6) AS to_timestamp FROM t""")
def k2(spark, d):
    e = frames_events(spark, d).episodes.withColumns({"bytes": F.col("length") * 2000, "seconds": F.col("length") / 30.0})
    out = k.pack_videos(e, "top", "seconds", "bytes", 1.0)
    v = "videos/top/"
    number = c(v + "chunk_index") * CHUNK_FILES + c(v + "file_index")  # running over all chunks
    return out.select("episode_index", number.alias("file_index"), F.round(c(v + "from_timestamp"), 6).alias("from_timestamp"), F.round(c(v + "to_timestamp"), 6).alias("to_timestamp"))


@query("K3_episode_batches", walk_sql(EVENTS, "n", "w.held * 0.01 + s.sz * 0.01 >= 4.0 OR w.cnt >= 6 OR w.frames + s.n > 350") + " SELECT e AS episode_index, CAST(g AS BIGINT) AS batch FROM w")
def k3(spark, d):
    out = k.episode_batches(frames_events(spark, d).episodes, 0.01, 4.0, 6, 350)
    return out.select("episode_index", "batch")


@query("K4_range_boundaries", """WITH r AS (SELECT 'doc/' || lpad(CAST(doc_id AS VARCHAR), 8, '0') AS p, row_number() OVER (ORDER BY 'doc/' || lpad(CAST(doc_id AS VARCHAR), 8, '0')) - 1 AS i FROM documents),
m AS (SELECT p, i // 7 AS m FROM r WHERE i % 7 = 0), n AS (SELECT count(*) AS n FROM m),
w AS (SELECT 0 AS pos, 0 AS m UNION ALL SELECT x + 1, CAST(floor((x + 1) * (n - 1) / 4.0) AS BIGINT) FROM n, range(3) t(x) UNION ALL SELECT 4, n - 1 FROM n)
SELECT CAST(pos AS BIGINT) AS pos, p || CASE WHEN pos = 4 THEN chr(65535) ELSE '' END AS boundary FROM w JOIN m ON m.m = w.m""")
def k4(spark, d):
    docs = table(spark, d, "documents").select(F.concat(F.lit("doc/"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("path"))
    marks = k.range_boundaries(docs, "path", 4, 7)
    return spark.createDataFrame(list(enumerate(marks)), "pos long, boundary string")


@query("K5_shards", f"WITH {EVENTS} SELECT e AS episode_index, e % 4 AS shard FROM (SELECT DISTINCT e FROM fr)")
def k5(spark, d):
    e = frames_events(spark, d).episodes.select("episode_index")
    return a.union_all([k.shard(e, "episode_index", 4, r).withColumn("shard", F.lit(r).cast("long")) for r in range(4)])


@query("K6_top_rows", "SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 25")
def k6(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "n_chars", (-F.col("n_chars")).alias("_o"))
    return k.top_rows(docs, ["_o", "doc_id"], 25).drop("_o")


# ---------------------------------------------------------------- dataset algebra

RENUMBERED = """, kept AS (SELECT DISTINCT e, n FROM fr WHERE {keep}), en AS (
  SELECT e, n, row_number() OVER (ORDER BY e) - 1 AS ne, sum(n) OVER (ORDER BY e) - n AS off FROM kept),
x AS (SELECT en.ne, fr.f, en.off + fr.f AS ni, fr.task, fr.task_index FROM fr JOIN en ON en.e = fr.e),
tk AS (SELECT task, row_number() OVER (ORDER BY min(ni)) - 1 AS ti FROM x GROUP BY task)"""


@query("D1_delete_episodes", f"""WITH {EVENTS}{RENUMBERED.format(keep="e NOT IN (0, 4, 9)")}
SELECT ne AS episode_index, f AS frame_index, CAST(ni AS BIGINT) AS "index", ti AS task_index FROM x JOIN tk ON tk.task = x.task""")
def d1(spark, d):
    return a.delete_episodes(frames_events(spark, d), [0, 4, 9]).frames.select(*KEYS)


@query("D1_deleted_tasks", f"""WITH {LINES}{RENUMBERED.format(keep="e NOT IN (0, 1, 2, 3)")} SELECT ti AS task_index, task FROM tk""")
def d1_tasks(spark, d):
    return a.delete_episodes(frames_lineitem(spark, d), [0, 1, 2, 3]).tasks


@query("D1_S5_deleted_stats", combined_sql(EVENTS, f"SELECT * FROM ({long_events()}) WHERE episode_index NOT IN (0, 4, 9)"))
def d1_stats(spark, d):
    ds = frames_events(spark, d)
    ds = ds.with_(episode_stats=s.episode_stats(ds.frames, STATE))
    return rounded(a.delete_episodes(ds, [0, 4, 9]).stats, 5, mean=8)


@query("D2_split", f"""WITH {EVENTS}, n AS (SELECT max(e) + 1 AS total FROM fr), ep AS (SELECT DISTINCT e, n FROM fr),
z AS (SELECT e, ep.n, CASE WHEN e < CAST(floor(total * 0.5) AS BIGINT) THEN 'train' WHEN e < CAST(floor(total * 0.5) AS BIGINT) + CAST(floor(total * 0.3) AS BIGINT) THEN 'val' ELSE 'test' END AS split FROM ep, n)
SELECT split, row_number() OVER (PARTITION BY split ORDER BY e) - 1 AS episode_index, CAST(sum(n) OVER (PARTITION BY split ORDER BY e) - n AS BIGINT) AS dataset_from_index, n AS length FROM z""")
def d2(spark, d):
    parts = a.split(frames_events(spark, d), {"train": 0.5, "val": 0.3, "test": 0.1})
    return a.union_all([p.episodes.select(F.lit(n).alias("split"), "episode_index", "dataset_from_index", "length") for n, p in parts.items()])


@query("D3_merge", f"""WITH {EVENTS}, n AS (SELECT max(e) + 1 AS ne, count(*) AS ni FROM fr)
SELECT e AS episode_index, f AS frame_index, i AS "index", task FROM fr UNION ALL SELECT e + ne, f, i + ni, upper(task) FROM fr, n""")
def d3(spark, d):
    ds = frames_events(spark, d)
    other = ds.with_(tasks=ds.tasks.withColumn("task", F.upper("task")))
    merged = a.merge([ds, other])
    return j.with_task_text(merged.frames.drop("task"), merged.tasks).select("episode_index", "frame_index", "index", "task")


@query("D3_merged_tasks", f"""WITH {EVENTS}, m AS (SELECT max(task_index) + 1 AS m FROM fr)
SELECT DISTINCT task_index, task FROM fr UNION SELECT DISTINCT task_index + m, upper(task) FROM fr, m""")
def d3_tasks(spark, d):
    ds = frames_events(spark, d)
    return a.merge([ds, ds.with_(tasks=ds.tasks.withColumn("task", F.upper("task")))]).tasks


@query("D4_modify_tasks", f"""WITH {EVENTS}, t AS (SELECT {IDS}, CASE WHEN e = 2 THEN 'b task' WHEN e = 5 THEN 'c task' ELSE 'a task' END AS task FROM fr)
SELECT episode_index, frame_index, task, dense_rank() OVER (ORDER BY task) - 1 AS task_index FROM t""")
def d4(spark, d):
    out = a.modify_tasks(frames_events(spark, d), "a task", {2: "b task", 5: "c task"})
    return out.frames.select("episode_index", "frame_index", "task", "task_index")


@query("D5_register_tasks", f"""WITH {EVENTS}, t AS (SELECT DISTINCT task_index, task FROM fr), n AS (SELECT count(*) AS n FROM t)
SELECT task_index, task FROM t UNION ALL SELECT n + (row_number() OVER (ORDER BY n_nationkey) - 1), n_name FROM nation, n""")
def d5(spark, d):
    new = table(spark, d, "nation").select(F.col("n_name").alias("task"), F.col("n_nationkey").alias("_order"))
    return a.register_tasks(frames_events(spark, d).tasks, new)


@query("D6_append_episodes", f"""WITH {EVENTS}, n AS (SELECT max(e) + 1 AS ne, count(*) AS ni FROM fr),
l AS (SELECT * FROM (WITH {CONV} SELECT e, f, i, n, text, task FROM fr))
SELECT e AS episode_index, f AS frame_index, i AS "index" FROM fr UNION ALL SELECT l.e + ne, l.f, l.i + ni FROM l, n""")
def d6(spark, d):
    rows = table(spark, d, "conversations").withColumnRenamed("role", "task")
    return a.append_episodes(frames_events(spark, d), rows, "conv_id", ["turn"]).frames.select("episode_index", "frame_index", "index")


APPENDED = f"""SELECT * FROM (WITH {EVENTS} {long_events()})
UNION ALL SELECT l.e + (SELECT count(DISTINCT user_id) FROM events), 0, CAST(l.a0 AS DOUBLE) FROM (WITH {LINES} SELECT e, a0 FROM fr) l
UNION ALL SELECT l.e + (SELECT count(DISTINCT user_id) FROM events), 1, CAST(l.a3 AS DOUBLE) FROM (WITH {LINES} SELECT e, a3 FROM fr) l"""


@query("D6_appended_stats", combined_sql("z AS (SELECT 1)", APPENDED))
def d6_stats(spark, d):
    ds = frames_events(spark, d)
    ds = ds.with_(episode_stats=s.episode_stats(ds.frames, STATE))
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_shipdate", "l_linenumber", F.col("l_returnflag").alias("task"), F.array("l_quantity", "l_tax").alias("observation.state"))
    return a.append_episodes(ds, rows, "l_orderkey", ["l_shipdate", "l_linenumber"], STATE).stats.transform(rounded, 5, mean=8)


@query("D8_merge_shards", """WITH sh AS (SELECT l_suppkey, count(*) AS fr, count(DISTINCT l_orderkey) AS ep, count(*) // 100 + 1 AS fi FROM lineitem GROUP BY l_suppkey),
x AS (SELECT row_number() OVER (ORDER BY l_suppkey) - 1 AS s, * FROM sh), y AS (SELECT *, CAST(sum(fi) OVER (ORDER BY s) - fi AS BIGINT) AS first FROM x)
SELECT s AS shard_index, first AS first_file, first // 50 AS first_chunk_index, first % 50 AS first_file_index, CAST(sum(fr) OVER (ORDER BY s) - fr AS BIGINT) AS frame_offset,
 CAST(sum(ep) OVER (ORDER BY s) - ep AS BIGINT) AS episode_offset FROM y""")
def d8(spark, d):
    from trajspark.operators.layout import positions

    per = table(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("n_frames"), F.countDistinct("l_orderkey").alias("n_episodes"))
    shards = positions(per.withColumn("n_files", F.floor(F.col("n_frames") / 100) + 1), "shard_index", ["l_suppkey"])
    return a.merge_shards(shards, 50)


@query("D9_images_to_external", f"""WITH {EVENTS}{RENUMBERED.format(keep="e IN (2, 3, 8)")} SELECT ne AS episode_index, f AS frame_index, CAST(ni AS BIGINT) AS "index" FROM x""")
def d9(spark, d):
    ds = frames_events(spark, d)
    ds = ds.with_(frames=ds.frames.withColumn("camera", F.array(F.lit(0))), info={**ds.info, "features": {**ds.features, "camera": {"dtype": "image", "shape": [1, 1, 1]}}})
    return a.images_to_external(ds, ["camera"], [2, 3, 8]).frames.drop("camera").select("episode_index", "frame_index", "index")


@query("D11_replay_to_frames", f"""WITH {EVENTS}, p AS (SELECT i, v, coalesce(lag(done) OVER (ORDER BY i), true) AS st FROM fr),
z AS (SELECT i, v, CAST(sum(CAST(st AS INTEGER)) OVER (ORDER BY i) AS BIGINT) - 1 AS e FROM p)
SELECT e AS episode_index, row_number() OVER (PARTITION BY e ORDER BY i) - 1 AS frame_index, i AS "index", v AS reward FROM z""")
def d11(spark, d):
    log = frames_events(spark, d).frames.select("index", c("next.reward").alias("reward"), c("next.done").alias("done"), F.lit(False).alias("truncated"))
    return a.replay_to_frames(log, 10).select("episode_index", "frame_index", "index", "reward")


@query("D12_dataset_info", f"""WITH {EVENTS} SELECT count(*) AS total_episodes, CAST(sum(n) AS BIGINT) AS total_frames, round(avg(n), 6) AS mean_frames,
 round(avg(n) / 1.0, 6) AS mean_seconds FROM (SELECT DISTINCT e, n FROM fr)""")
def d12(spark, d):
    out = a.dataset_info(frames_events(spark, d))
    return out.select("total_episodes", "total_frames", F.round("mean_frames", 6).alias("mean_frames"), F.round("mean_seconds", 6).alias("mean_seconds"))


@query("D13_compile_rollouts", f"""WITH {LINES}, fd AS (SELECT e, n, coalesce(min(CASE WHEN task[1] = 'R' THEN f END), n - 1) AS last FROM fr GROUP BY e, n),
o AS (SELECT *, CAST(sum(last + 2) OVER (ORDER BY e) - (last + 2) AS BIGINT) AS off FROM fd)
SELECT o.e AS episode_index, x.p AS frame_index, o.off + x.p AS "index", a.a1 AS reward, b.a0 AS observation
FROM o, LATERAL (SELECT unnest(range(o.last + 2)) AS p) x JOIN fr a ON a.e = o.e AND a.f = least(x.p, o.last) JOIN fr b ON b.e = o.e AND b.f = least(x.p, o.n - 1)""")
def d13(spark, d):
    f = frames_lineitem(spark, d).frames
    steps = f.select("episode_index", F.col("frame_index").alias("step"), c("action")[1].alias("reward"), c("action")[0].alias("observation"), F.col("task").startswith("R").alias("done"))
    return a.compile_rollouts(steps, 10, ["observation"]).select("episode_index", "frame_index", "index", "reward", "observation")


# ---------------------------------------------------------------- sets


@query("U1_U4_union", f"""WITH {EVENTS} SELECT i AS "index", v AS reward, CAST(NULL AS VARCHAR) AS text FROM fr UNION ALL SELECT * FROM (WITH {CONV} SELECT i, CAST(NULL AS DOUBLE), text FROM fr)""")
def u1(spark, d):
    one = frames_events(spark, d).frames.select("index", c("next.reward").alias("reward"))
    return a.union_sorted([one, frames_conv(spark, d).frames.select("index", "text")])


@query("U3_differences", f"""WITH {EVENTS} SELECT DISTINCT e AS episode_index FROM fr WHERE e NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0)""")
def u3(spark, d):
    drop = table(spark, d, "customer").filter("c_acctbal > 0").select(F.col("c_custkey").alias("episode_index"))
    return a.episodes_to_keep(frames_events(spark, d).episodes, drop).select("episode_index")


@query("U3_unused_tasks", f"""WITH {EVENTS} SELECT DISTINCT task_index, task FROM fr WHERE task NOT IN (SELECT task FROM fr WHERE e < 1 AND f < 3)""")
def u3_tasks(spark, d):
    ds = frames_events(spark, d)
    return a.unused_tasks(ds.frames.filter("episode_index < 1 AND frame_index < 3"), ds.tasks)
