from types import SimpleNamespace

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajspark.operators import windows as w
from trajspark.operators.layout import positions, running, shared_folder
from trajspark.operators.similar import similar_filter


def by_episode(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


@pytest.mark.parametrize("method", ["halo", "join"])
def test_delta_window_clamps_and_flags(frames, rows, blocks, method):
    offsets = [-12, -2, 0, 3]
    got = w.delta_window(frames, {"reward": [o / 10 for o in offsets]}, 10, method=method)
    got = {(r.episode_index, r.frame_index): (r.reward, r.reward_is_pad) for r in got.collect()}
    assert len(got) == len(rows)
    for e, eps in by_episode(rows).items():
        for f in range(len(eps)):
            at = [min(len(eps) - 1, max(0, f + o)) for o in offsets]
            assert got[e, f] == ([eps[i][6] for i in at], [i != f + o for i, o in zip(at, offsets)])


def test_delta_window_nearest_requested(frames, rows, blocks):
    offsets = [-4, -1, 0, 2, 6]
    got = w.delta_window(frames, {"reward": [float(o) for o in offsets]}, 1, pad="nearest_requested")
    got = {(r.episode_index, r.frame_index): (r.reward, r.reward_is_pad) for r in got.collect()}
    for e, eps in by_episode(rows).items():
        for f in range(len(eps)):
            values, pads = [], []
            for o in offsets:
                same = [x for x in offsets if x * o > 0 and abs(x) <= abs(o) and 0 <= f + x < len(eps)]
                values.append(eps[f + (max(same, key=abs) if same else 0)][6])
                pads.append(not 0 <= f + o < len(eps))
            assert got[e, f] == (values, pads)


def test_delta_tolerance():
    tol = 1e-4
    assert not w.bad_deltas({"a": [i / 30 for i in range(-10, 10)]}, 30, tol)
    assert not w.bad_deltas({"a": [2 / 30 + tol * 0.9]}, 30, tol)
    assert w.bad_deltas({"a": [2 / 30 + tol * 1.1]}, 30, tol)
    with pytest.raises(ValueError, match="multiple"):
        w.delta_offsets({"a": [0.015]}, 30, tol)
    assert w.deltas_from_indices(["action", "observation.x", "next.reward"], 10, None, [0, 1], [-1, 0]) == {
        "action": [0.0, 0.1],
        "observation.x": [-0.1, 0.0],
    }


def test_running_scans_match_brute_force(frames, rows, blocks):
    v = F.when(F.col("reward") > 2, F.col("reward"))
    got = running(frames, {"s": ("sum", F.col("reward")), "l": ("last", v), "n": ("next", v), "m": ("max", F.col("reward")), "x": ("sum", v)})
    got = {(r.episode_index, r.frame_index): (r.s, r.l, r.n, r.m, r.x) for r in got.collect()}
    for e, eps in by_episode(rows).items():
        reward = [r[6] for r in eps]
        for f in range(len(reward)):
            big = [x for x in reward[: f + 1] if x > 2]
            after = [x for x in reward[f:] if x > 2]
            assert got[e, f] == (sum(reward[: f + 1]), big[-1] if big else None, after[0] if after else None, max(reward[: f + 1]), sum(big) if big else None)


def test_running_exclusive(frames, rows, blocks):
    got = running(frames, {"s": ("sum", F.col("reward"))}, inclusive=False)
    got = {(r.episode_index, r.frame_index): r.s for r in got.collect()}
    for e, eps in by_episode(rows).items():
        for f in range(len(eps)):
            assert got[e, f] == (sum(r[6] for r in eps[:f]) if f else None)


@pytest.mark.parametrize("order", [["timestamp", "index"], ["name"]])
def test_positions_are_dense_for_hot_groups(frames, rows, blocks, order):
    df = frames.withColumn("name", F.format_string("k%05d", "index"))
    got = positions(df, "at", order, ["episode_index"]).select("episode_index", "frame_index", "at").collect()
    assert len(got) == len(rows) and all(r["at"] == r["frame_index"] for r in got)
    whole = positions(df, "at", ["name"]).select("index", "at").collect()
    assert all(r["at"] == r["index"] for r in whole)


def test_action_chunks_drop_short_episodes(frames, rows, blocks):
    got = w.action_chunks(frames, 6, action="observation.state").collect()
    want = {(e, f): [r[5] for r in eps[f : f + 6]] for e, eps in by_episode(rows).items() for f in range(len(eps) - 5)}
    assert {(r.episode_index, r.frame_index): r["chunk"] for r in got} == want


def test_sampler_errors_and_trims(dataset, blocks):
    kept = w.episode_sampler(dataset.frames, dataset.episodes, 2, 3, [0, 2, 4]).collect()
    assert {(r.episode_index, r.frame_index) for r in kept} == {(0, f) for f in range(2, 57)} | {(4, f) for f in range(2, 5)}
    assert [r.episode_index for r in w.skipped_episodes(dataset.episodes, 2, 3).orderBy("episode_index").collect()] == [1, 2]
    with pytest.raises(ValueError):
        w.episode_sampler(dataset.frames, dataset.episodes, -1)


def test_next_state_pattern(spark, blocks):
    """State i/100, done every tenth row: next state is + 0.01, or the same when done."""
    data = [(0, i, i, [i / 100], [2 * i / 100], 3 * i / 100, (i + 1) % 10 == 0) for i in range(100)]
    df = spark.createDataFrame(data, "episode_index long, frame_index long, index long, s array<double>, action array<double>, `next.reward` double, `next.done` boolean")
    for r in w.next_state(df, ["s"]).collect():
        assert r.next_s[0] == pytest.approx(r.s[0] if r.done else r.s[0] + 0.01)
        assert r.action[0] == pytest.approx(2 * r.s[0]) and r.reward == pytest.approx(3 * r.s[0])
        assert r.truncated == r.done and r.stored_truncated is False


def test_rewind_draws_are_valid_and_repeatable(frames, blocks):
    one = w.rewind_indices(frames, 4, 3, 2, seed=5).select("index", "frame_index", "rewind_step", "rewind_frames").collect()
    two = {r["index"]: r.rewind_frames for r in w.rewind_indices(frames.repartition(5), 4, 3, 2, seed=5).collect()}
    for r in one:
        most = max(0, min(3, (r.frame_index - 4) // 2))
        assert (r.rewind_step == 0 and most == 0) or 1 <= r.rewind_step <= most
        assert r.rewind_frames == [r.frame_index - 4 - 2 * i for i in range(1, r.rewind_step + 1)] == two[r["index"]]


def test_similar_filter_compares_to_last_kept(frames, rows, blocks):
    got = {(r.episode_index, r.frame_index) for r in similar_filter(frames, "observation.state", 1.2).collect()}
    want = set()
    for e, eps in by_episode(rows).items():
        last = None
        for r in eps:
            if last is None or np.linalg.norm(np.array(r[5]) - last) >= 1.2:
                want.add((e, r[1]))
                last = np.array(r[5])
    assert got == want


def test_similar_filter_drops_steps_kept_before(frames, rows, blocks):
    stepped = frames.withColumn("step", F.col("frame_index") % 5)
    got = {(r.episode_index, r.frame_index) for r in similar_filter(stepped, "observation.state", 0.7, step="step").collect()}
    want = set()
    for e, eps in by_episode(rows).items():
        last, handled = None, set()
        for r in eps:
            if last is None or (r[1] % 5 not in handled and np.linalg.norm(np.array(r[5]) - last) >= 0.7):
                want.add((e, r[1]))
                last = np.array(r[5])
                handled.add(r[1] % 5)
    assert got == want


def test_similar_filter_must_go(frames, blocks):
    kept = similar_filter(frames.withColumn("go", F.col("frame_index") % 3 == 0), "observation.state", 1e9, "go")
    assert all(r.frame_index % 3 == 0 for r in kept.collect())


def test_motion_score_needs_two_rows(frames, blocks):
    xyz = frames.withColumn("p", F.array(F.col("frame_index").cast("double"), F.lit(0.0), F.lit(0.0)))
    got = {r.episode_index: r.motion_score for r in w.motion_score(xyz, "p").collect()}
    assert got[0] == pytest.approx(1.0) and np.isnan(got[1])


@pytest.mark.parametrize("fps_to", [4, 10, 25])
def test_resample_matches_interp(frames, rows, blocks, fps_to):
    got = {(r.episode_index, r.frame_index): r["observation.state"] for r in w.resample(frames, ["observation.state"], 10, fps_to).collect()}
    count = 0
    for e, eps in by_episode(rows).items():
        n = len(eps)
        m = n if n <= 1 or fps_to == 10 else int(round((n - 1) / 10 * fps_to)) + 1
        count += m
        src, tgt = np.arange(n) / 10, np.arange(m) / fps_to
        for d in range(2):
            want = np.interp(tgt, src, [r[5][d] for r in eps])
            assert np.allclose([got[e, j][d] for j in range(m)], want)
    assert len(got) == count


def test_positions_of_hot_groups(spark):
    from trajspark.operators.layout import positions

    spark.conf.set("spark.trajspark.hotGroupRows", "50")
    try:
        values = ["same"] * 300 + [None] * 200 + [f"v{i}" for i in range(40)]
        rows = [(i % 2 if i % 7 else None, v, i) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, "k long, v string, i long").repartition(3)
        for order, keys in ((["v"], []), (["v", "i"], ["k"]), (["v"], ["k"])):
            got = positions(df, "at", order, keys).collect()
            assert len(got) == len(rows)
            groups = {}
            for r in got:
                groups.setdefault(r["k"] if keys else 0, []).append(r)
            for group in groups.values():
                group.sort(key=lambda r: r["at"])
                assert [r["at"] for r in group] == list(range(len(group)))
                lead = [(r["v"] is not None, r["v"] or "", r["i"] if "i" in order else 0) for r in group]
                assert lead == sorted(lead)
    finally:
        spark.conf.unset("spark.trajspark.hotGroupRows")


def test_last_split_that_rounds_to_nothing_is_skipped():
    from trajspark.operators.algebra import split_plan

    assert list(split_plan(10, {"train": 0.5, "val": 0.05})) == ["train"]
    assert split_plan(10, {"train": 0.5, "val": 0.2})["val"] == range(5, 10)


def test_cluster_needs_a_shared_folder():
    def session(master, named=None):
        conf = SimpleNamespace(get=lambda key, default: named)
        return SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master=master))

    assert shared_folder(session("spark://host:7077", "hdfs://store/cp/")) == "hdfs://store/cp"
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(session(master))
