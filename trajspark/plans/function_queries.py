"""Numeric and text transforms over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from trajspark.functions import rotation as r
from trajspark.functions import text as t
from trajspark.functions.columns import c
from trajspark.operators import numeric as n
from trajspark.operators import stats as s
from trajspark.operators import windows as w
from trajspark.plans.registry import CONV, EVENTS, LINES, query
from trajspark.plans.stats_queries import ACTION, STATE, histogram_sql, long_events
from trajspark.sources.adapters import frames_conv, frames_events, frames_lineitem, table

IDS = "e AS episode_index, f AS frame_index"
BOTH = ["episode_index", "frame_index"]


def _line_stats(frames):
    """Statistics of the lines; the caller's own frames, since numbering them is most of the work."""
    return n.stats_literals(s.dataset_quantiles(frames, ACTION))


def _dims(df, digits=6):
    a = c("action")
    return df.select(*BOTH, *[F.round(a[i], digits).alias(f"a{i}") for i in range(4)])


M = "m AS (SELECT {aggs} FROM fr)"
MEANS = M.format(aggs=", ".join(f"avg(a{i}) AS m{i}, stddev_pop(a{i}) AS s{i}, min(a{i}) AS lo{i}, max(a{i}) AS hi{i}" for i in range(4)))


def lines(expr: str, digits: int = 6) -> str:
    cols = ", ".join(f"round(CAST({expr.replace('#', str(i))} AS DOUBLE), {digits}) AS a{i}" for i in range(4))
    return f"WITH {LINES}, {MEANS} SELECT {IDS}, {cols} FROM fr, m"


@query("N1_normalize_mean_std", lines("(a# - m#) / (s# + 1e-8)"))
def n1(spark, d):
    frames = frames_lineitem(spark, d).frames
    return _dims(n.normalize(frames, ACTION, _line_stats(frames), {"ACTION": "MEAN_STD"}))


@query("N1_normalize_min_max", lines("2 * (a# - lo#) / (hi# - lo#) - 1"))
def n1_min_max(spark, d):
    frames = frames_lineitem(spark, d).frames
    return _dims(n.normalize(frames, ACTION, _line_stats(frames), {"ACTION": "MIN_MAX"}))


@query("N2_unnormalize", lines("a#", 4))
def n2(spark, d):
    frames = frames_lineitem(spark, d).frames
    stats, by = _line_stats(frames), {"ACTION": "MIN_MAX"}
    return _dims(n.unnormalize(n.normalize(frames, ACTION, stats, by), ACTION, stats, by), 4)


Q10 = "q AS (SELECT " + ", ".join(f"quantile_cont(a{i}, 0.1) AS lo{i}, quantile_cont(a{i}, 0.9) AS hi{i}" for i in range(4)) + " FROM fr)"


@query("N3_normalize_clipped", f"WITH {LINES}, {Q10} SELECT {IDS}, " + ", ".join(
    f"round(CAST(2 * (greatest(lo{i}, least(hi{i}, a{i})) - lo{i}) / greatest(hi{i} - lo{i}, 1e-8) - 1 AS DOUBLE), 6) AS a{i}" for i in range(4)) + " FROM fr, q")
def n3(spark, d):
    frames = frames_lineitem(spark, d).frames
    values = frames.select(F.posexplode("action").alias("dim", "value"))
    exact = s.counted_percentiles(values, "value", (0.1, 0.9), ["dim"])
    stats = n.stats_literals(exact.withColumn("feature", F.lit("action")))
    return _dims(n.normalize_clipped(frames, "action", stats, "QUANTILE10"))


@query("N4_normalize_padded", f"WITH {LINES}, {MEANS} SELECT {IDS}, round(CAST(2 * (a0 - lo0) / (hi0 - lo0) - 1 AS DOUBLE), 6) AS a0, CAST(0 AS DOUBLE) AS a1, round(2 * a2 - 1, 6) AS a2, round(2 * a3 - 1, 6) AS a3 FROM fr, m")
def n4(spark, d):
    frames = frames_lineitem(spark, d).frames
    stats = _line_stats(frames)["action"]
    cut = {"action": {"min": [stats["min"][0], 7.0], "max": [stats["max"][0], 7.0]}}
    return _dims(n.normalize_padded(frames, "action", cut, 4))


@query("N5_swap_stats", lines("(a# - 1) / (2 + 1e-8)"))
def n5(spark, d):
    new = {"action": {"mean": [1.0] * 4, "std": [2.0] * 4}}
    frames = frames_lineitem(spark, d).frames
    stats = n.swap_stats(_line_stats(frames), new)
    return _dims(n.normalize(frames, ACTION, stats, {"ACTION": "MEAN_STD"}))


@query("N6_discretize", f"""WITH {EVENTS}, x AS (SELECT *, k / 40.0 - 1.2 AS x FROM fr)
SELECT {IDS}, CAST(CASE WHEN x < -1 THEN -1 ELSE least(255, floor((x + 1) * 128)) END AS INTEGER) AS bin FROM x""")
def n6(spark, d):
    x = c("observation.state")[1] / 40.0 - 1.2
    return frames_events(spark, d).frames.select(*BOTH, n.discretize(x).alias("bin"))


@query("N7_select_dims", f"WITH {LINES} SELECT {IDS}, a0, a2, a3 FROM fr")
def n7(spark, d):
    v = n.select_dims(c("action"), "0:1,2:4")
    return frames_lineitem(spark, d).frames.select(*BOTH, v[0].alias("a0"), v[1].alias("a2"), v[2].alias("a3"))


@query("N8_delta_to_target", f"""WITH {LINES} SELECT {IDS}, sqrt(a2 * a2 + a3 * a3 + 0.0025) > 0.08 AS enabled, round(a2 * 10, 6) AS target_x, round(a3 * 10, 6) AS target_y,
 0.5::DOUBLE AS target_z, 0.0::DOUBLE AS target_wx, a0 AS gripper_vel FROM fr""")
def n8(spark, d):
    f = frames_lineitem(spark, d).frames.withColumn("action", F.array(c("action")[2], c("action")[3], F.lit(0.05), c("action")[0]))
    out = n.delta_to_target(n.map_action_to_deltas(f), 10, 0.08)
    return out.select(*BOTH, "enabled", F.round("target_x", 6).alias("target_x"), F.round("target_y", 6).alias("target_y"), "target_z", "target_wx", "gripper_vel")


ROT = f"""WITH {LINES}, a AS (SELECT e, f, a0 / 25 AS x, a2 * 10 AS y, a3 * 10 - 0.3 AS z FROM fr), b AS (SELECT *, sqrt(x * x + y * y + z * z) AS an FROM a),
q AS (SELECT *, x / an * sin(an / 2) AS qx, y / an * sin(an / 2) AS qy, z / an * sin(an / 2) AS qz, cos(an / 2) AS qw FROM b)"""


def _pose(spark, d):
    a = c("action")
    pose = F.array(F.lit(0.0), F.lit(0.0), F.lit(0.0), a[0] / 25, a[2] * 10, a[3] * 10 - 0.3)
    return n.pose_features(frames_lineitem(spark, d).frames.withColumn("pose", pose), "pose")


@query("N9_rotations", ROT + """ SELECT e AS episode_index, f AS frame_index, round(qx, 6) AS qx, round(qw, 6) AS qw, round(x, 6) AS rx, round(y, 6) AS ry,
 round(1 - 2 * (qy * qy + qz * qz), 6) AS m00, round(2 * (qy * qz + qx * qw), 6) AS m21 FROM q""")
def n9(spark, d):
    q, v, m = c("quat"), c("rotvec"), c("rot6d")
    out = _pose(spark, d).select(*BOTH, F.round(q[0], 6).alias("qx"), F.round(q[3], 6).alias("qw"), F.round(v[0], 6).alias("rx"), F.round(v[1], 6).alias("ry"), F.round(m[0], 6).alias("m00"), F.round(m[5], 6).alias("m21"))
    return out


@query("N9_six_d_axis_angle", ROT + " SELECT e AS episode_index, f AS frame_index, round(x, 3) AS rx, round(y, 3) AS ry, round(z, 3) AS rz FROM q WHERE an < 3.0 AND an > 0.01")
def n9_6d(spark, d):
    pose = _pose(spark, d)
    size = F.sqrt(c("pose")[3] * c("pose")[3] + c("pose")[4] * c("pose")[4] + c("pose")[5] * c("pose")[5])
    v = r.six_d_to_axis_angle(c("rot6d"))
    out = pose.filter((size < 3.0) & (size > 0.01)).withColumn("_v", v)
    return out.select(*BOTH, *[F.round(c("_v")[i], 3).alias(f"r{a}") for i, a in enumerate("xyz")])


@query("N10_gripper_penalty", f"""WITH {EVENTS} SELECT {IDS}, CASE WHEN (k / 100 < 0.5 AND v / 100 > 0.5) OR (k / 100 > 0.75 AND v / 100 < 0.5) THEN -0.1 ELSE 0.0 END::DOUBLE AS penalty FROM fr""")
def n10(spark, d):
    p = n.gripper_penalty(c("observation.state")[1], c("action")[0], 100, -0.1)
    return frames_events(spark, d).frames.select(*BOTH, p.alias("penalty"))


@query("N11_apply_interventions", f"""WITH {EVENTS} SELECT {IDS}, CASE WHEN k > 70 THEN v * 2 ELSE v END AS a0, CASE WHEN k > 70 THEN 1.0 ELSE v END AS a3,
 (task = 'error' OR v > 100) AS done, CASE WHEN v > 100 THEN 1.0 ELSE 0.0 END::DOUBLE AS reward FROM fr""")
def n11(spark, d):
    v = c("action")[0]
    f = frames_events(spark, d).frames.withColumns({
        "teleop_action": F.struct((v * 2).alias("delta_x")), "is_intervention": c("observation.state")[1] > 70,
        "success": v > 100, "terminate_episode": F.col("task") == "error", "action": F.array(v, v, v, v)})
    out = n.apply_interventions(f)
    return out.select(*BOTH, c("action")[0].alias("a0"), c("action")[3].alias("a3"), "done", "reward")


@query("N12_success_from_score", """SELECT doc_id, CASE WHEN quality = 1 THEN 5.0 ELSE 0.25 END::DOUBLE AS reward, quality = 1 OR toxic = 1 AS done FROM documents JOIN labels USING (doc_id)""")
def n12(spark, d):
    rows = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id")
    rows = rows.withColumns({"reward": F.lit(0.25), "done": F.col("toxic") == 1, "score": F.col("quality").cast("double")})
    return n.success_from_score(rows, "score", 0.5, 5.0).select("doc_id", "reward", "done")


@query("N13_N15_gripper", f"""WITH {EVENTS} SELECT {IDS}, round(greatest(0, least(100, k + (task_index % 3 - 1) * 100 * 0.2)), 6)::DOUBLE AS position,
 CASE WHEN k / 100 > 0.5 THEN 1.0 ELSE -1.0 END::DOUBLE AS closed FROM fr""")
def n13(spark, d):
    k = c("observation.state")[1]
    pos = n.gripper_velocity_to_position(k, F.col("task_index") % 3, 0.2, 0, 100, discrete=True)
    return frames_events(spark, d).frames.select(*BOTH, F.round(pos, 6).alias("position"), n.binarize_gripper(k / 100).alias("closed"))


@query("N14_teleop_log", f"""WITH {EVENTS}, x AS (SELECT *, k > 30 AS en FROM fr)
SELECT {IDS}, CASE WHEN en THEN -k ELSE 0 END::DOUBLE AS target_x, CASE WHEN en THEN v ELSE 0 END::DOUBLE AS target_y, CASE WHEN en THEN 3.0 ELSE 0 END::DOUBLE AS target_z,
 round(CASE WHEN en THEN f / 100.0 ELSE 0 END, 6)::DOUBLE AS target_wy, v::DOUBLE AS gripper_vel FROM x""")
def n14(spark, d):
    v, k = c("observation.state")[0], c("observation.state")[1]
    half = F.col("frame_index") / 200.0
    log = frames_events(spark, d).frames.select(
        *BOTH, (k > 30).alias("enabled"), F.array(v, k, F.lit(3.0)).alias("pos"),
        F.array(F.sin(half), F.lit(0.0), F.lit(0.0), F.cos(half)).alias("rot"), F.create_map(F.lit("a3"), v).alias("raw_inputs"))
    out = n.remap_teleop_log(log, "ios")
    return out.select(*BOTH, (F.col("target_x") + 0.0).alias("target_x"), "target_y", "target_z", F.round("target_wy", 6).alias("target_wy"), "gripper_vel")


@query("N16_gripper_ranges", f"""WITH {EVENTS}, x AS (SELECT e, f, k / 100 AS x FROM fr), p AS (SELECT *, x * (0.058 - 0.01844) + 0.01844 AS p FROM x)
SELECT {IDS}, round((asin(greatest(-1, least(1, (0.000484 + p * p - 0.001296) / (0.044 * p)))) - 0.4) / 1.1, 6) AS angular,
 round((x * 1.1 + 0.4 + 0.6213) / (1.4910 + 0.6213), 6) AS joint FROM p""")
def n16(spark, d):
    x = c("observation.state")[1] / 100
    return frames_events(spark, d).frames.select(*BOTH, F.round(n.gripper_linear_to_angular(x), 6).alias("angular"), F.round(n.gripper_from_angular(x), 6).alias("joint"))


# ---------------------------------------------------------------- text


@query("F1_times", """SELECT doc_id, CAST((n_chars // 60) * 60 + n_chars % 60 AS INTEGER) AS seconds, lpad(CAST(n_chars // 60 AS VARCHAR), CAST(greatest(2, length(CAST(n_chars // 60 AS VARCHAR))) AS INTEGER), '0') || ':' || lpad(CAST(n_chars % 60 AS VARCHAR), 2, '0') AS mmss FROM documents""")
def f1(spark, d):
    text = t.seconds_to_mmss(F.col("n_chars"))
    return table(spark, d, "documents").select("doc_id", t.mmss_to_seconds(text).alias("seconds"), text.alias("mmss"))


@query("F2_prompt", f"""WITH {CONV} SELECT {IDS}, 'Task: ' || translate(regexp_replace(regexp_replace(text, '^\\s+', ''), '\\s+$', ''), '_' || chr(10), '  ') || ', State: ' || f || ' ' || n || ';' || chr(10) || 'Action: ' AS prompt FROM fr""")
def f2(spark, d):
    p = t.prompt(F.col("text"), F.array("frame_index", "episode_length"))
    return frames_conv(spark, d).frames.select(*BOTH, p.alias("prompt"))


@query("F3_ensure_suffix", """SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN 'Execute the robot action.' WHEN text LIKE '%.' THEN text ELSE text || '.' END AS task FROM documents""")
def f3(spark, d):
    text = F.when(F.col("doc_id") % 7 != 0, F.col("text"))
    return table(spark, d, "documents").select("doc_id", t.ensure_suffix(text, ".", "Execute the robot action.").alias("task"))


@query("F4_parse_caption", """SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN lang WHEN doc_id % 3 = 1 THEN 'plain ' || source ELSE '' END AS short_caption,
 CASE WHEN doc_id % 3 = 0 THEN source ELSE '' END AS semantic_motion, '' AS motion_sequence FROM documents""")
def f4(spark, d):
    as_json = F.to_json(F.struct(F.col("lang").alias("short_caption"), F.col("source").alias("semantic_motion")))
    raw = F.when(F.col("doc_id") % 3 == 0, as_json).when(F.col("doc_id") % 3 == 1, F.concat(F.lit("plain "), F.col("source")))
    return table(spark, d, "documents").select("doc_id", t.parse_caption(raw).alias("_c")).select("doc_id", "_c.*")


@query("F5_F6_paths", """SELECT page_id, '/home/' || substr(url, length('http') + 1) AS local, CASE WHEN position('.' IN regexp_extract(url, '([^/]*)$', 1)) > 1 THEN regexp_replace(regexp_extract(url, '([^/]*)$', 1), '\\.[^.]*$', '') ELSE regexp_extract(url, '([^/]*)$', 1) END AS stem,
 page_id * 3 AS chunk, page_id AS file FROM pages""")
def f5(spark, d):
    path = F.format_string("data/chunk-%03d/file-%03d.parquet", F.col("page_id") * 3, F.col("page_id"))
    return table(spark, d, "pages").select("page_id", t.map_path(F.col("url"), "http").alias("local"), t.file_stem(F.col("url")).alias("stem"),
                                           t.path_number(path, "chunk-").alias("chunk"), t.path_number(path, "file-").alias("file"))


@query("F7_flatten", 'SELECT doc_id, lang AS "meta/lang", n_chars AS "meta/size/chars" FROM documents')
def f7(spark, d):
    nested = table(spark, d, "documents").select("doc_id", F.struct("lang", F.struct(F.col("n_chars").alias("chars")).alias("size")).alias("meta"))
    return t.flatten_columns(t.unflatten_columns(t.flatten_columns(nested)))


@query("F8_annotation_record", """SELECT doc_id, source AS partition_name, lang AS caption, n_chars AS kept, false AS has_dropped FROM documents""")
def f8(spark, d):
    docs = table(spark, d, "documents")
    payload = F.struct(F.col("n_chars").alias("kept"), F.col("text").alias("disps"))
    caption = t.parse_caption(F.to_json(F.struct(F.col("lang").alias("short_caption"))))
    record = t.annotation_record({"partition": F.col("source")}, caption, {"slam": t.slim_struct(payload, ["disps"])})
    g = lambda path: F.get_json_object("_r", path)
    return docs.select("doc_id", record.alias("_r")).select(
        "doc_id", g("$.manifest_entry.partition").alias("partition_name"), g("$.caption.short_caption").alias("caption"),
        g("$.slam.kept").cast("long").alias("kept"), g("$.slam.disps").isNotNull().alias("has_dropped"))


WORDS = "wd AS (SELECT doc_id, list_filter(string_split_regex(text, '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '') AS w FROM documents)"


@query("F10_vocabulary", f"""WITH {WORDS}, x AS (SELECT unnest(w) AS token FROM wd), g AS (SELECT token, count(*) AS n FROM x GROUP BY token)
SELECT token, n, row_number() OVER (ORDER BY n DESC, token) - 1 AS token_id FROM g""")
def f10(spark, d):
    return t.vocabulary(table(spark, d, "documents"), "text")


@query("F9_tokenize", f"""WITH {WORDS}, x AS (SELECT unnest(w) AS token FROM wd), g AS (SELECT token, count(*) AS n FROM x GROUP BY token),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) - 1 AS id FROM g), p AS (SELECT unnest(range(16)) AS pos)
SELECT wd.doc_id, CAST(p.pos AS INTEGER) AS pos, CASE WHEN pos < len(w) THEN CASE WHEN v.id < 200 THEN v.id ELSE -1 END ELSE 0 END AS token_id, pos < len(w) AS is_real
FROM wd CROSS JOIN p LEFT JOIN v ON v.token = w[pos + 1]""")
def f9(spark, d):
    docs = table(spark, d, "documents").select("doc_id", "text")
    out = t.tokenize(docs, "doc_id", "text", t.vocabulary(docs, "text", 200), 16)
    z = F.arrays_zip(c("tokens").alias("t"), c("tokens_mask").alias("m"))
    return out.select("doc_id", F.posexplode(z).alias("pos", "_z")).select("doc_id", "pos", F.col("_z.t").alias("token_id"), F.col("_z.m").alias("is_real"))


@query("F9_action_tokens", f"""WITH {EVENTS}, p AS (SELECT unnest(range(6)) AS pos)
SELECT {IDS}, CAST(pos AS INTEGER) AS pos, CAST(CASE pos WHEN 0 THEN 2 WHEN 1 THEN 77 WHEN 2 THEN 1000 - 1 - 128 - k WHEN 3 THEN 1000 - 1 - 128 - floor(v) WHEN 4 THEN 88 ELSE 0 END AS BIGINT) AS token, pos < 5 AS is_real FROM fr CROSS JOIN p""")
def f9_action(spark, d):
    s0, s1 = c("observation.state")[0], c("observation.state")[1]
    f = frames_events(spark, d).frames.withColumn("ids", F.array(s1.cast("long"), F.floor(s0)))
    out = t.action_tokens(f, "ids", 1000, 128, 2, [77], [88], 6)
    z = F.arrays_zip(c("action_tokens").alias("t"), c("action_tokens_mask").alias("m"))
    return out.select(*BOTH, F.posexplode(z).alias("pos", "_z")).select(*BOTH, "pos", F.col("_z.t").alias("token"), F.col("_z.m").alias("is_real"))


@query("F11_float_member", f"WITH {LINES} SELECT {IDS}, CAST(CASE WHEN a2 < 1e-6 THEN 0 WHEN abs(a2 - 0.05) < 1e-6 THEN 1 WHEN abs(a2 - 0.1) < 1e-6 THEN 2 ELSE -1 END AS INTEGER) AS at FROM fr")
def f11(spark, d):
    options = F.array(F.lit(0.0), F.lit(0.05), F.lit(0.1))
    return frames_lineitem(spark, d).frames.select(*BOTH, t.float_member(options, c("action")[2]).alias("at"))


@query("F12_rescale_points", """SELECT doc_id, 'go <point>[' || CAST(least(319, CAST(round_even(CAST((n_chars % 640) * 0.5 AS DOUBLE), 0) AS BIGINT)) AS VARCHAR) || ', ' || CAST(least(239, CAST(round_even(CAST((doc_id % 480) * 0.5 AS DOUBLE), 0) AS BIGINT)) AS VARCHAR)
 || ']</point> then <point>[7]</point> ' || lang AS moved FROM documents""")
def f12(spark, d):
    text = F.concat(F.lit("go <point>("), (F.col("n_chars") % 640).cast("string"), F.lit(","), (F.col("doc_id") % 480).cast("string"), F.lit(")</point> then <point>7</point> "), F.col("lang"))
    size = lambda w, h: (F.lit(w), F.lit(h))
    return table(spark, d, "documents").select("doc_id", t.rescale_points(text, size(640, 480), size(320, 240)).alias("moved"))


@query("F13_frame_instruction", f"""WITH {EVENTS} SELECT {IDS}, CASE WHEN f >= 5 AND f < 10 THEN chr(10) || 'sub ' || e WHEN f = 20 THEN chr(10) || 'dist' ELSE 'base ' || e END AS instruction FROM fr""")
def f13(spark, d):
    ds = frames_events(spark, d)
    e = ds.episodes.select("episode_index")
    row = lambda pos, key, rng, text: F.struct(F.lit(pos).alias("pos"), F.lit(key).alias("key"), F.lit(rng).cast("string").alias("frame_range"), text.alias("text"))
    name = F.col("episode_index").cast("string")
    rows = F.array(row(0, "instruction", None, F.concat(F.lit("base "), name)), row(1, "subtask_generation", "5 10", F.concat(F.lit("sub "), name)), row(2, "distribute", "20 20", F.lit("dist")))
    ins = e.select("episode_index", F.explode(rows).alias("_r")).select("episode_index", "_r.*")
    return t.frame_instruction(ds.frames, ins).select(*BOTH, "instruction")


@query("F14_chat_prompt", """SELECT doc_id, '<|im_start|>system' || chr(10) || 'You are a helpful assistant.<|im_end|>' || chr(10) || '<|im_start|>user' || chr(10) || 'Observation: front view: <|vision_start|><|image_pad|><|vision_end|>'
 || chr(10) || 'Instruction: ' || lang || chr(10) || 'Predict the next action in robot action.' || chr(10) || 'Proprioception: <|propri|>' || chr(10) || '<|im_end|>' || chr(10) || '<|im_start|>assistant' || chr(10) || '<|action_fast|><|im_end|>' || chr(10) || '<|action|><|action|>' AS prompt FROM documents""")
def f14(spark, d):
    return table(spark, d, "documents").select("doc_id", t.chat_prompt(F.col("lang"), 2, ["observation.images.face_view"]).alias("prompt"))


@query("W7_N3_tokenizer_windows", f"""WITH {LINES}, m AS (SELECT min(a0) AS lo, max(a0) AS hi FROM fr), h AS (SELECT unnest(range(3)) AS pos)
SELECT a.e AS episode_index, a.f AS frame_index, CAST(h.pos AS INTEGER) AS pos, round(2 * (b.a0 - lo) / (hi - lo) - 1, 6) AS x FROM fr a CROSS JOIN h JOIN fr b ON b.e = a.e AND b.f = a.f + h.pos CROSS JOIN m WHERE a.f + 3 <= a.n""")
def tokenizer_windows(spark, d):
    frames = frames_lineitem(spark, d).frames
    chunks = w.action_chunks(frames, 3)
    out = n.normalize_clipped(chunks, "chunk", {"chunk": _line_stats(frames)["action"]}, "MIN_MAX")
    return out.select(*BOTH, F.posexplode("chunk").alias("pos", "_r")).select(*BOTH, "pos", F.round(F.col("_r")[0], 6).alias("x"))


WHOLE = histogram_sql(EVENTS, long_events("0 AS z"), ["dim"], 13)


@query("N1_normalize_state_quantiles", f"""WITH {EVENTS}, q AS ({WHOLE})
SELECT e AS episode_index, f AS frame_index, round(2 * (v - a.q01) / (a.q99 - a.q01) - 1, 5) AS s0, round(2 * (k - b.q01) / (b.q99 - b.q01) - 1, 5) AS s1
FROM fr JOIN q a ON a.dim = 0 JOIN q b ON b.dim = 1""")
def n1_quantiles(spark, d):
    frames = frames_events(spark, d).frames
    stats = n.stats_literals(s.dataset_quantiles(frames, STATE))
    out = n.normalize(frames, STATE, stats, {"STATE": "QUANTILES"})
    return out.select(*BOTH, *[F.round(c("observation.state")[i], 5).alias(f"s{i}") for i in (0, 1)])
