"""Catalogs, samples, images and filters over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.functions.columns import c
from trajspark.operators import catalog as k
from trajspark.operators import images as im
from trajspark.operators import sampling as p
from trajspark.operators import similar, steps
from trajspark.operators import windows as w
from trajspark.dataset import EpisodicDataset
from trajspark.plans.registry import EVENTS, query, uniform_sql
from trajspark.plans.stats_queries import IMAGES, images
from trajspark.sources.adapters import frames_events, table
from trajspark.sources.nested import load_episodic_from_nested


def clips(spark, d):
    """Documents as clips: several paths share an id, some ids are blank, labels are status columns."""
    docs = table(spark, d, "documents").join(table(spark, d, "labels"), "doc_id", "left")
    n = F.col("doc_id")
    return docs.select(
        F.concat(F.lit("oss://clips/"), F.col("lang"), F.lit("/"), F.lpad(n.cast("string"), 7, "0"), F.lit(".mp4")).alias("path"),
        F.when(n % 5 == 0, "  ").when(n % 5 == 1, F.lit(None)).otherwise(F.concat(F.lit("id"), F.floor(n / 3).cast("string"))).alias("id"),
        F.col("source").alias("partition"),
        F.col("lang").alias("dataset_name"),
        "n_chars",
        F.col("quality").cast("string").alias("quality_status"),
        F.col("toxic").cast("string").alias("toxic_status"),
        F.when(n % 2 == 0, F.to_json(F.struct("lang", F.col("n_chars").alias("size")))).otherwise(F.col("lang")).alias("caption"),
    )


CLIPS = """cl AS (SELECT 'oss://clips/' || lang || '/' || lpad(CAST(doc_id AS VARCHAR), 7, '0') || '.mp4' AS path,
 CASE WHEN doc_id % 5 = 0 THEN '  ' WHEN doc_id % 5 = 1 THEN NULL ELSE 'id' || CAST(doc_id // 3 AS VARCHAR) END AS id, source AS "partition", lang AS dataset_name, n_chars,
 CAST(quality AS VARCHAR) AS quality_status, CAST(toxic AS VARCHAR) AS toxic_status, CASE WHEN doc_id % 2 = 0 THEN '{"lang":1,"size":2}' ELSE lang END AS caption
 FROM documents LEFT JOIN labels USING (doc_id)),
ids AS (SELECT *, CASE WHEN id IS NULL OR trim(id) = '' THEN regexp_extract(path, '([^/]*)\\.mp4$', 1) ELSE trim(id) END AS cid FROM cl)"""


@query("A9_J6_read_catalog", f"""WITH {CLIPS}, x AS (SELECT * FROM ids WHERE dataset_name = 'en' AND path >= 'oss://clips/en/0000100' AND path < 'oss://clips/en/0000900' AND quality_status IS NOT NULL)
SELECT path, "partition" FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY path) AS r FROM x) WHERE r = 1 ORDER BY path LIMIT 100""")
def a9(spark, d):
    return k.read_catalog(clips(spark, d), None, "en", "oss://clips/en/0000100", "oss://clips/en/0000900", ["quality_status"], limit=100, select=["path", "partition"])


@query("J6_dedupe_catalog", f"WITH {CLIPS} SELECT path, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY cid ORDER BY path) AS r FROM ids) WHERE r = 1")
def j6(spark, d):
    return k.dedupe_catalog(clips(spark, d)).select("path", "n_chars")


@query("A10_upsert_by_path", f"""WITH {CLIPS}, up AS (SELECT CASE WHEN doc_id % 4 = 0 THEN 'oss://clips/new/' || doc_id ELSE 'oss://clips/' || lang || '/' || lpad(CAST(doc_id AS VARCHAR), 7, '0') || '.mp4' END AS path, n_chars * 2 AS n_chars FROM documents WHERE n_chars > 500)
SELECT coalesce(up.path, ids.path) AS path, CASE WHEN up.path IS NOT NULL THEN up.n_chars ELSE ids.n_chars END AS n_chars, dataset_name FROM ids FULL JOIN up ON up.path = ids.path""")
def a10(spark, d):
    docs = table(spark, d, "documents").filter("n_chars > 500")
    n = F.col("doc_id")
    path = F.when(n % 4 == 0, F.concat(F.lit("oss://clips/new/"), n.cast("string"))).otherwise(
        F.concat(F.lit("oss://clips/"), F.col("lang"), F.lit("/"), F.lpad(n.cast("string"), 7, "0"), F.lit(".mp4")))
    first = docs.select(path.alias("path"), F.col("n_chars"), F.lit(0).alias("seq"))
    last = docs.select(path.alias("path"), (F.col("n_chars") * 2).alias("n_chars"), F.lit(1).alias("seq"))
    skipped = docs.select(F.lit(None).cast("string").alias("path"), F.col("n_chars"), F.lit(2).alias("seq"))
    out = k.upsert_by_path(clips(spark, d), first.unionByName(last).unionByName(skipped), "seq")
    return out.select("path", "n_chars", "dataset_name")


@query("S12_profile", f"""WITH {CLIPS} SELECT field, count(v) AS non_null_count, round(count(v) / count(*), 4) AS non_null_ratio, substr(min(v), 1, 200) AS example FROM (
 SELECT 'path' AS field, path AS v FROM cl UNION ALL SELECT 'id', nullif(id, '') FROM cl UNION ALL SELECT 'partition', "partition" FROM cl UNION ALL SELECT 'dataset_name', dataset_name FROM cl
 UNION ALL SELECT 'quality_status', quality_status FROM cl UNION ALL SELECT 'toxic_status', toxic_status FROM cl) GROUP BY field""")
def s12(spark, d):
    out = k.profile(clips(spark, d).drop("n_chars", "caption"))
    return out.drop("type")


@query("S12_status_distribution", f"""WITH {CLIPS} SELECT 'quality_status' AS field, quality_status AS "value", count(*) AS n FROM cl GROUP BY 2 UNION ALL SELECT 'toxic_status', toxic_status, count(*) FROM cl GROUP BY 2""")
def s12_status(spark, d):
    return k.status_distribution(clips(spark, d))


@query("S12_json_subkeys", """SELECT 'caption' AS field, key, count(*) AS n FROM documents, (VALUES ('lang'), ('size')) k(key) WHERE doc_id % 2 = 0 GROUP BY key
UNION ALL SELECT 'props', 'k', count(*) FROM events""")
def s12_json(spark, d):
    return k.json_subkeys(clips(spark, d), ["caption"]).unionByName(k.json_subkeys(table(spark, d, "events"), ["props"]))


@query("S13_counts", f"""WITH {CLIPS} SELECT 'all' AS what, count(*) AS n FROM cl WHERE "partition" = 'src3' UNION ALL
SELECT 'ready', count(*) FROM cl WHERE path >= 'oss://clips/en' AND quality_status IS NOT NULL""")
def s13(spark, d):
    c1 = k.count_rows(clips(spark, d), "src3").withColumn("what", F.lit("all"))
    return c1.unionByName(k.count_ready(clips(spark, d), None, "oss://clips/en", None, ["quality_status"]).withColumn("what", F.lit("ready")))


@query("A11_load_nested", f"""WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, round(CAST(CAST(v AS FLOAT) AS DOUBLE), 3) AS s0, round(CAST(CAST(k AS FLOAT) AS DOUBLE), 3) AS s1, 'go ' || user_id AS task, user_id % 2 = 0 AS success FROM fr""")
def a11(spark, d):
    ds = frames_events(spark, d)
    # Short logs: the nested form is one record per piece of an episode that fits one message.
    step = F.struct(F.col("frame_index").alias("_f"), F.array(c("observation.state")[0]).alias("joint_position"), F.array(c("observation.state")[1]).alias("gripper_position"))
    joined = ds.frames.join(ds.episodes.select("episode_index", "user_id"), "episode_index")
    nested = joined.withColumn("_b", F.floor(F.col("frame_index") / 4096)).groupBy("episode_index", "user_id", "_b").agg(F.array_sort(F.collect_list(step)).alias("steps"))
    path = F.concat(F.lit("/data/"), F.when(F.col("user_id") % 2 == 0, "success").otherwise("failure"), F.lit("/x"))
    nested = nested.select("episode_index", F.struct(path.alias("file_path")).alias("episode_metadata"), F.concat(F.lit("go "), F.col("user_id").cast("string")).alias("language_instruction"), "steps")
    out = load_episodic_from_nested(nested, "episode_index", ["joint_position", "gripper_position"])
    s = c("observation.state")
    return out.select("episode_index", F.col("step._f").alias("frame_index"), F.round(s[0].cast("double"), 3).alias("s0"), F.round(s[1].cast("double"), 3).alias("s1"), "task", "success")


@query("D10_crop_images", f"""WITH {IMAGES} SELECT i AS "index", (p // 8 - 2) * 5 + (p % 8 - 1) AS pos, x AS pixel FROM px WHERE p // 8 >= 2 AND p // 8 < 6 AND p % 8 >= 1 AND p % 8 < 6""")
def d10(spark, d):
    frames = images(spark, d)
    ds = EpisodicDataset(frames, frames, frames, {"features": {"pixels": {"dtype": "image", "shape": [1, 8, 8]}}})
    out = im.crop_images(ds, {"pixels": (2, 1, 4, 5)}).frames
    return out.select("index", F.posexplode("pixels").alias("_p", "pixel")).select("index", F.col("_p").cast("long").alias("pos"), "pixel")


@query("D10_area_resize", f"""WITH {IMAGES} SELECT i AS "index", (p // 8 // 2) * 4 + (p % 8) // 2 AS pos, avg(x) AS pixel FROM px GROUP BY 1, 2""")
def resize(spark, d):
    out = images(spark, d).select("index", F.posexplode(im.area_resize(c("pixels"), (1, 8, 8), 2)).alias("_p", "pixel"))
    return out.select("index", F.col("_p").cast("long").alias("pos"), "pixel")


@query("X6_image_hook", f"""WITH {IMAGES} SELECT i AS "index", p AS pos, 255 - x AS pixel FROM px""")
def x6(spark, d):
    out = im.image_hook(images(spark, d), ["pixels"], lambda s: s.map(lambda v: 255 - v), T.ArrayType(T.IntegerType()))
    return out.select("index", F.posexplode("pixels").alias("_p", "pixel")).select("index", F.col("_p").cast("long").alias("pos"), "pixel")


@query("P14_random_shift", f"""WITH {IMAGES}, pl AS (SELECT i, CAST(floor({uniform_sql(7, "i", "0")} * 5) AS INTEGER) AS dy, CAST(floor({uniform_sql(7, "i", "1")} * 5) AS INTEGER) AS dx FROM (SELECT DISTINCT i FROM px)),
 t AS (SELECT i, p, dy, dx, greatest(0, least(7, p // 8 + dy - 2)) * 8 + greatest(0, least(7, p % 8 + dx - 2)) AS src FROM (SELECT i, p FROM px) JOIN pl USING (i))
SELECT t.i AS "index", t.p AS pos, dy AS shift_y, dx AS shift_x, px.x AS pixel FROM t JOIN px ON px.i = t.i AND px.p = t.src""")
def p14(spark, d):
    plan = p.random_shift_plan(images(spark, d), 2, 7)
    out = im.shift(c("pixels"), (1, 8, 8), 2, F.col("shift_y"), F.col("shift_x"))
    shifted = plan.select("index", "shift_y", "shift_x", F.posexplode(out).alias("_p", "pixel"))
    return shifted.select("index", F.col("_p").cast("long").alias("pos"), "shift_y", "shift_x", "pixel")


CROPS = f"""pl AS (SELECT i, CAST(floor({uniform_sql(8, "i", "0")} * 3) AS INTEGER) AS y, CAST(floor({uniform_sql(8, "i", "1")} * 4) AS INTEGER) AS x FROM (SELECT DISTINCT i FROM px))"""


@query("P14_random_crop", f"""WITH {IMAGES}, {CROPS} SELECT i AS "index", (p // 8 - pl.y) * 5 + (p % 8 - pl.x) AS pos, px.x AS pixel
FROM px JOIN pl USING (i) WHERE p // 8 BETWEEN pl.y AND pl.y + 5 AND p % 8 BETWEEN pl.x AND pl.x + 4""")
def p14_crop(spark, d):
    """6 x 5 crops of the 8 x 8 images at drawn corners."""
    plan = p.random_crop_plan(images(spark, d), 8, 8, 6, 5, 8)
    at = plan.select("index", "crop_top", "crop_left", F.posexplode("pixels").alias("p", "pixel"))
    y, x = F.floor(F.col("p") / 8) - F.col("crop_top"), F.col("p") % 8 - F.col("crop_left")
    inside = at.withColumns({"y": y, "x": x}).filter("y BETWEEN 0 AND 5 AND x BETWEEN 0 AND 4")
    return inside.select("index", (F.col("y") * 5 + F.col("x")).cast("long").alias("pos"), "pixel")


def repeated_step():
    """Every seventh frame repeats the step four frames before it."""
    return F.when(F.col("frame_index") % 7 == 6, F.col("frame_index") - 4).otherwise(F.col("frame_index"))


#: A step is handled once a row of it is kept.
SIMILAR = f"""WITH RECURSIVE {EVENTS}, q AS (SELECT e, f, v, k, CASE WHEN f % 7 = 6 THEN f - 4 ELSE f END AS s FROM fr),
r(e, f, kept, lv, lk, done) AS (SELECT e, f, true, v, k, [s] FROM q WHERE f = 0
 UNION ALL SELECT y.e, y.f, go, CASE WHEN go THEN v ELSE lv END, CASE WHEN go THEN k ELSE lk END, CASE WHEN go THEN list_append(done, s) ELSE done END
 FROM (SELECT q.*, r.lv, r.lk, r.done, sqrt((q.v - r.lv) * (q.v - r.lv) + (q.k - r.lk) * (q.k - r.lk)) >= 25.0 AND NOT list_contains(r.done, q.s) AS go
       FROM r JOIN q ON q.e = r.e AND q.f = r.f + 1) y)
SELECT e AS episode_index, f AS frame_index FROM r WHERE kept"""


@query("W19_similar_filter", SIMILAR)
def w19(spark, d):
    frames = frames_events(spark, d).frames.withColumn("step", repeated_step())
    return similar.similar_filter(frames, "observation.state", 25.0, step="step").select("episode_index", "frame_index")


def drawn_sql(name: str, n: int, seed: int) -> str:
    """Rows of ``fr`` at ``n`` draws from the newest 5000."""
    return f"""{name} AS (SELECT draw, lo + CAST(floor({uniform_sql(seed, "draw")} * (hi - lo + 1)) AS BIGINT) AS i
  FROM (SELECT max(i) AS hi, greatest(min(i), max(i) - 4999) AS lo FROM fr), range({n}) AS r(draw))"""


@query("P9_sample_transitions", f"""WITH {EVENTS}, {drawn_sql("d", 2000, 3)} SELECT draw, i AS "index", e AS episode_index, v AS reward FROM d JOIN fr USING (i)""")
def p9(spark, d):
    frames = frames_events(spark, d).frames
    return p.sample_transitions(w.next_state(frames, ["observation.state"]), 2000, 5000, 3).select("draw", "index", "episode_index", "reward")


@query("P10_mix_online_offline", f"""WITH {EVENTS}, {drawn_sql("a", 500, 5)}, {drawn_sql("b", 500, 6)}
SELECT draw, 'online' AS source, i AS "index", v AS reward FROM a JOIN fr USING (i) UNION ALL SELECT draw, 'offline', i, NULL FROM b""")
def p10(spark, d):
    t = w.next_state(frames_events(spark, d).frames, ["observation.state"])
    return p.mix_online_offline(t, t.drop("reward"), 1000, 5000, 5).select("draw", "source", "index", "reward")


@query("P11_weighted_subset", f"""WITH {EVENTS}, it AS (SELECT * FROM (VALUES (0, 'brightness', 1.0), (1, 'contrast', 1.0), (2, 'hue', 2.0), (3, 'sharpness', 4.0)) t(k, name, w)),
 r AS (SELECT fr.i, it.k, name, row_number() OVER (PARTITION BY fr.i ORDER BY -ln({uniform_sql(9, "fr.i", "it.k")}) / CAST(w AS DOUBLE), it.k) AS nth FROM fr, it)
SELECT i AS "index", string_agg(name, ',' ORDER BY k) AS plan FROM r WHERE nth <= 2 GROUP BY i""")
def p11(spark, d):
    plan = p.weighted_subset([F.col("index")], ["brightness", "contrast", "hue", "sharpness"], [1.0, 1.0, 2.0, 4.0], 2, 9)
    return frames_events(spark, d).frames.select("index", F.array_join(plan, ",").alias("plan"))


@query("P12_sample_fraction", f"""WITH {EVENTS}, r AS (SELECT e, f, i, n, row_number() OVER (PARTITION BY e ORDER BY {uniform_sql(4, "i")}, i) AS nth FROM fr)
SELECT e AS episode_index, f AS frame_index, i AS "index" FROM r WHERE nth <= greatest(1, floor(n * 0.1))""")
def p12(spark, d):
    ds = frames_events(spark, d)
    return p.sample_fraction_per_episode(ds.frames, ds.episodes, 0.1, 4).select("episode_index", "frame_index", "index")


@query("P13_shuffle", f'WITH {EVENTS} SELECT i AS "index", e AS episode_index FROM fr')
def p13(spark, d):
    return p.shuffle(frames_events(spark, d).frames, 1).select("index", "episode_index")


@query("P15_perturb_labels", f"""WITH {EVENTS}, r AS (SELECT *, {uniform_sql(6, "i")} < 0.2 AS hit FROM fr)
SELECT i AS "index", CASE WHEN hit THEN 'something else' ELSE task END AS task, CASE WHEN hit THEN 0 ELSE v END AS target, hit AS perturbed FROM r""")
def p15(spark, d):
    frames = frames_events(spark, d).frames.withColumn("target", c("next.reward"))
    return p.perturb_labels(frames, 0.2, 6, "task", "something else", ["target"]).select("index", "task", "target", "perturbed")


@query("P16_route_transitions", f"""WITH {EVENTS} SELECT 'online' AS "table", i AS "index" FROM fr WHERE k <= 90 UNION ALL SELECT 'offline', i FROM fr WHERE k <= 90 AND v > 50""")
def p16(spark, d):
    s = c("observation.state")
    rows = frames_events(spark, d).frames.select("index", F.when(s[1] > 90, float("nan")).otherwise(s[1]).alias("state"), (s[0] > 50).alias("is_intervention"))
    online, offline = p.route_transitions(rows, ["state"])
    return online.select(F.lit("online").alias("table"), "index").unionByName(offline.select(F.lit("offline").alias("table"), "index"))


@query("X3_steps", f"""WITH {EVENTS} SELECT e AS episode_index, f AS frame_index, round(v * 2 + 1, 6) AS reward, done OR f + 1 >= 30 AS truncated FROM fr""")
def x3(spark, d):
    run = [
        steps.Step("double", lambda df: df.withColumn("next.reward", c("next.reward") * 2), "reward"),
        steps.Step("offset", lambda df: df.withColumn("next.reward", c("next.reward") + 1), "reward"),
        steps.Step("limit", lambda df: w.time_limit(df, 30, "next.done"), "truncated"),
    ]
    out = steps.run_steps(frames_events(spark, d).frames, run)
    return out.select("episode_index", "frame_index", F.round("`next.reward`", 6).alias("reward"), "truncated")
