from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF
from trajspark.functions import rotation as rot
from trajspark.functions import text as t
from trajspark.operators import catalog as cat
from trajspark.operators import numeric as n
from trajspark.operators import progress as p
from trajspark.operators import sampling as sm
from trajspark.operators import steps
from trajspark.operators import windows as w
from trajspark.operators.similar import similar_filter
from trajspark.streaming import ops


def test_single_stage(spark):
    df = spark.createDataFrame([(0, f, 100) for f in range(100)], "episode_index long, frame_index long, episode_length long")
    got = {r.frame_index: r.tau for r in p.stage_and_tau(df, None, ["task"]).collect()}
    assert got[50] == pytest.approx(50 / 99) and got[99] == 1


def test_stages_and_gaps(spark, blocks):
    df = spark.createDataFrame([(0, f, 120) for f in range(120)], "episode_index long, frame_index long, episode_length long")
    iv = spark.createDataFrame(
        [(0, 0, "reach", 5, 29), (0, 1, "grasp", 30, 49), (0, 2, "lift", 60, 99)],
        "episode_index long, pos long, name string, start_frame long, end_frame long",
    )
    got = {r.frame_index: (r.stage, r.tau, r.stage_tau) for r in p.stage_and_tau(df, iv, ["reach", "grasp", "lift"]).collect()}
    assert got[3] == (0, 0.0, 0.0)
    assert got[40][:2] == (1, pytest.approx(10 / 19))
    assert got[55] == (1, 1.0, 2.0)
    assert got[99][:2] == (2, 1.0) and got[99][2] == pytest.approx(2.999)
    assert got[110] == (2, 0.999, pytest.approx(2.999))


def test_breakpoints():
    assert p.proportions_to_breakpoints([2, 3, 5]) == pytest.approx([0, 0.2, 0.5, 1.0])
    assert p.proportions_to_breakpoints({"a": 0.4, "b": 0.6}, ["b", "a"]) == pytest.approx([0, 0.6, 1.0])
    with pytest.raises(ValueError):
        p.normalize_stage_tau(F.lit(1.0))


def test_weights_missing_column(frames):
    with pytest.raises(ValueError, match="available"):
        p.progress_weights(frames.withColumn("progress_dense", F.lit(1.0)), "progress_sparse", 3)


def test_rotations_round_trip(spark):
    vectors = np.random.default_rng(2).normal(size=(50, 3))
    vectors = [v / np.linalg.norm(v) * a for v, a in zip(vectors, np.linspace(0.01, 3.0, 50))]
    df = spark.createDataFrame([(v.tolist(),) for v in vectors], "v array<double>")
    q = rot.rotvec_to_quat(F.col("v"))
    out = df.select("v", q.alias("q")).select(
        "v", rot.quat_to_rotvec(F.col("q")).alias("a"), rot.quat_to_axis_angle(F.col("q")).alias("b"),
        rot.six_d_to_axis_angle(rot.matrix_to_6d(rot.quat_to_matrix(F.col("q")))).alias("c"))
    for r in out.collect():
        assert np.allclose(r.v, r.a, atol=1e-9) and np.allclose(r.v, r.b, atol=1e-7) and np.allclose(r.v, r.c, atol=1e-3)


def test_normalizers_differ_as_documented(spark):
    df = spark.createDataFrame([([5.0, 3.0],), ([15.0, 3.0],)], "action array<double>")
    stats = {"action": {"min": [0.0, 3.0], "max": [10.0, 3.0], "q01": [0.0, 3.0], "q99": [10.0, 3.0]}}
    spec = {"action": {"dtype": "float64", "shape": [2]}}
    plain = [r.action for r in n.normalize(df, spec, stats, {"ACTION": "QUANTILES"}).collect()]
    assert plain[1][0] == pytest.approx(2.0) and plain[0][1] == -1
    clipped = [r.action for r in n.normalize_clipped(df, "action", stats, "QUANTILES").collect()]
    assert clipped[1][0] == pytest.approx(1.0)
    padded = [r.action for r in n.normalize_padded(df, "action", stats, 2).collect()]
    assert padded[0][1] == 0.0
    with pytest.raises(ValueError):
        n.normalize(df, spec, stats, {"ACTION": "MEAN_STD"})


def test_text_functions(spark):
    row = spark.range(1).select(
        t.mmss_to_seconds(F.lit("02:05")).alias("a"), t.mmss_to_seconds(F.lit("7")).alias("b"), t.seconds_to_mmss(F.lit(125.9)).alias("c"),
        t.file_stem(F.lit("/x/a.b.mp4")).alias("d"), t.file_stem(F.lit("/x/.hidden")).alias("e"),
        t.rescale_points(F.lit("a <point>10, 20</point> b <point>x</point>"), (F.lit(100), F.lit(100))).alias("f"),
        t.prompt(F.lit(" pick_up\nit "), F.array(F.lit(1), F.lit(2))).alias("g"),
        t.parse_caption(F.lit("no json")).alias("h"),
    ).first()
    assert (row.a, row.b, row.c, row.d, row.e) == (125, 7, "02:05", "a.b", ".hidden")
    assert row.f == "a <point>[100.0, 200.0]</point> b <point>[]</point>"
    assert row.g == "Task: pick up it, State: 1 2;\nAction: "
    assert row.h.short_caption == "no json" and row.h.semantic_motion == ""


def test_upsert_modes(spark):
    table = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "path string, n long, s string")
    new = spark.createDataFrame([("a", 5, 0), ("a", 6, 1), ("c", 7, 0), (None, 9, 0)], "path string, n long, seq long")
    got = {r.path: (r.n, r.s) for r in cat.upsert_by_path(table, new, "seq").collect()}
    assert got == {"a": (6, "x"), "b": (2, "y"), "c": (7, None)}
    assert {r.path for r in cat.upsert_by_path(table, new, "seq", "update").collect()} == {"a", "b"}
    with pytest.raises(ValueError):
        cat.upsert_by_path(table, new, "seq", "insert")


def test_sampling_is_repeatable_and_in_range(frames, rows, dataset, blocks):
    draw = lambda: sm.sample_transitions(frames.repartition(4), 500, 40, seed=1).select("draw", "index").collect()
    one = sorted(draw())
    assert one == sorted(draw()) and len(one) == 500
    seen = {r["index"] for r in one}
    assert seen <= set(range(len(rows) - 40, len(rows))) and len(seen) > 30
    part = sm.sample_fraction_per_episode(frames, dataset.episodes, 0.2, 3).collect()
    assert Counter(r.episode_index for r in part) == {0: 12, 1: 1, 2: 1, 3: 4, 4: 1}
    order = [r["index"] for r in sm.shuffle(frames, 1).collect()]
    assert sorted(order) == list(range(len(rows))) and order != sorted(order)


def test_weighted_subset_follows_weights(spark):
    pick = sm.weighted_subset([F.col("id")], ["a", "b", "c"], [1.0, 1.0, 8.0], 1, 2)
    counts = Counter(r[0][0] for r in spark.range(4000).select(pick).collect())
    assert counts["c"] / 4000 == pytest.approx(0.8, abs=0.03)


def test_step_scopes(frames):
    ok = steps.Step("a", lambda df: df.withColumn("reward", F.col("reward") + 1), "reward")
    bad = steps.Step("b", lambda df: df.drop("timestamp"), "reward")
    assert [name for name, _ in steps.step_through(frames, [ok])] == ["input", "a"]
    assert steps.output_schema(frames, [ok])["reward"] == "double"
    with pytest.raises(ValueError):
        steps.run_steps(frames, [bad])


def _stream(spark, frames, folder, cuts):
    low = -1
    for high in [*cuts, 10**9]:
        frames.filter((F.col("frame_index") > low) & (F.col("frame_index") <= high)).coalesce(1).write.mode("append").parquet(f"{folder}/in")
        low = high
    return ops.stream_source(spark, f"{folder}/in", frames.schema)


def _run(spark, stream, folder):
    q = stream.writeStream.format("parquet").option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start(f"{folder}/out")
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/out")


@pytest.mark.parametrize("pad", ["edge", "nearest_requested"])
def test_stream_window_equals_batch(spark, frames, tmp_path, blocks, pad):
    deltas = [-3.0, -1.0, 0.0, 2.0, 4.0]
    folder = str(tmp_path)
    stream = _stream(spark, frames.select("episode_index", "frame_index", "reward", "is_last"), folder, [4, 11, 30])
    got = {(r.episode_index, r.frame_index): (r["values"], r.is_pad) for r in _run(spark, ops.stream_delta_window(stream, "reward", deltas, 1, pad=pad), folder).collect()}
    want = {(r.episode_index, r.frame_index): (r.reward, r.reward_is_pad) for r in w.delta_window(frames, {"reward": deltas}, 1, pad=pad).collect()}
    assert got == want


def test_stream_similar_filter_equals_batch(spark, frames, tmp_path):
    folder = str(tmp_path)
    stream = _stream(spark, frames.select("episode_index", "frame_index", "`observation.state`"), folder, [7, 20])
    got = {(r.episode_index, r.frame_index) for r in _run(spark, ops.stream_similar_filter(stream, "observation.state", 1.0), folder).collect()}
    assert got == {(r.episode_index, r.frame_index) for r in similar_filter(frames, "observation.state", 1.0).collect()}


@pytest.mark.parametrize("extra", [{}, {"end": "is_last"}, {"horizon": 100}])
def test_stream_similar_filter_remembers_steps(spark, frames, tmp_path, extra):
    folder, stepped = str(tmp_path), frames.withColumn("step", F.col("frame_index") % 11)
    stream = _stream(spark, stepped.select("episode_index", "frame_index", "step", "is_last", "`observation.state`"), folder, [7, 20])
    out = _run(spark, ops.stream_similar_filter(stream, "observation.state", 0.5, step="step", **extra), folder)
    want = similar_filter(stepped, "observation.state", 0.5, step="step")
    assert {(r.episode_index, r.frame_index) for r in out.collect()} == {(r.episode_index, r.frame_index) for r in want.collect()}


def test_bounded_queue_equals_simulation(frames, rows, blocks):
    log = frames.withColumn("up", F.col("reward") > 1)
    got = {(r.episode_index, r.frame_index): (r.depth, r.dropped) for r in ops.bounded_queue(log, 3, ["episode_index"], "frame_index", "up").collect()}
    depth = {}
    for r in rows:
        d, up = depth.get(r[0], 0), r[6] > 1
        new = min(3, d + 1) if up else max(0, d - 1)
        assert got[r[0], r[1]] == (new, up and d == 3)
        depth[r[0]] = new


def test_bounded_queue_walks_many_groups_in_small_batches(spark, blocks):
    """Batches that end inside groups, keys of two columns, a null key; no call per group."""
    rng = np.random.default_rng(3)
    rows = [(f"k{g % 7}", g, i, bool(rng.integers(0, 2))) for g in range(40) for i in range(int(rng.integers(1, 25)))]
    log = spark.createDataFrame([*rows, (None, 1, 0, True)], "a string, b long, i long, up boolean").repartition(3)
    out = ops.bounded_queue(log, 2, ["a", "b"], "i", "up")
    assert "FlatMapGroups" not in out._jdf.queryExecution().toString()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = {(r.a, r.b, r.i): (r.depth, r.dropped) for r in out.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    want, depth = {}, {}
    for a, b, i, up in rows:
        d = depth.get(b, 0)
        depth[b] = min(2, d + 1) if up else max(0, d - 1)
        want[a, b, i] = (depth[b], up and d == 2)
    assert got == want


SAMPLE = [
    "W1_J1_training_window", "W13_latched_reference", "W23_temporal_ensemble", "J3_frame_to_episode", "J5_nearest_frame", "J7_subtask_of_frame",
    "D1_delete_episodes", "D11_replay_to_frames", "D13_compile_rollouts", "K2_pack_videos", "P1_progress_weights", "P6_annotations",
    "S1_S2_episode_stats", "S11_eval_summary", "F10_vocabulary", "A9_J6_read_catalog", "N3_normalize_clipped",
]


@pytest.mark.parametrize("name", SAMPLE)
def test_query_equals_sql_on_small_blocks(spark, name):
    from trajspark.plans import load
    from trajspark.plans.check import compare, connect

    queries, oracles = load()
    spark.conf.set("spark.trajspark.blockRows", "8")
    spark.conf.set("spark.trajspark.hotGroupRows", "10")
    ok, note = compare(spark, connect(SF), SF, queries[name], oracles[name])
    assert ok, note


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).limit(5).count() == 5
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_draws_are_uniform_and_the_same_everywhere(spark):
    import hashlib

    from trajspark.functions.columns import hash_uniform

    got = spark.range(20000).select("id", hash_uniform(7, F.col("id"), F.lit(2)).alias("u")).collect()
    for r in got[:200]:
        assert r["u"] == (int(hashlib.md5(f"7:{r['id']}:2".encode()).hexdigest()[:13], 16) + 0.5) / 2**52
    counts = [0] * 20
    for r in got:
        counts[int(r["u"] * 20)] += 1
    assert sum((n - 1000) ** 2 / 1000 for n in counts) < 50  # chi-square with 19 degrees of freedom
    crops = sm.random_crop_plan(spark.range(500).withColumnRenamed("id", "index"), 8, 9, 6, 5, 1).collect()
    assert {r["crop_top"] for r in crops} == {0, 1, 2} and {r["crop_left"] for r in crops} == {0, 1, 2, 3, 4}


def test_shards_compute_their_frames_once(spark):
    from trajspark.plans.stream_queries import shards

    seen = spark.sparkContext.accumulator(0)

    def count(parts):
        for pdf in parts:
            seen.add(len(pdf))
            yield pdf

    rows = spark.range(90).select(F.lit(0).cast("long").alias("episode_index"), F.col("id").alias("frame_index"))
    stream, folder = shards(spark, rows.mapInPandas(count, rows.schema))
    written = spark.read.parquet(f"{folder}/shards")
    assert seen.value == 90 and stream.isStreaming
    assert sorted(r.frame_index for r in written.collect()) == list(range(90))
