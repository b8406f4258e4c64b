"""Range, nearest and interval joins against brute force, with ties, overlaps, gaps, nulls and repeated rows."""

import random

import pytest
from pyspark.sql import functions as F

from trajspark.functions.text import frame_instruction
from trajspark.operators import joins as j

INTERVAL_SCHEMA = "episode_index long, pos long, name string, start_frame long, end_frame long"
FRAME_SCHEMA = "episode_index long, frame_index long, name string"


def frame_rows(spark, lengths):
    return spark.createDataFrame([(e, f, f"n{f}") for e, n in enumerate(lengths) for f in range(n)], FRAME_SCHEMA)


def cover(intervals, f):
    """First interval in order that holds ``f``, then the first gap."""
    for _, pos, name, a, b in intervals:
        if a <= f <= b:
            return name, pos, 1.0 if b - a <= 0 else (f - a) / (b - a), False
    for here, after in zip(intervals, intervals[1:]):
        if here[4] + 1 <= f <= after[3] - 1:
            return here[2], here[1], 1.0, True
    return None, None, None, False


@pytest.mark.parametrize("seed", range(3))
def test_subtask_of_frame(spark, blocks, seed):
    """Overlaps, intervals inside others and out of order, single frames, empty intervals, ends past the episode."""
    rng, lengths = random.Random(seed), [70, 1, 33, 12]
    rows = []
    for e, n in enumerate(lengths[:3]):
        for pos in range(rng.randrange(1, 9)):
            a = rng.randrange(-3, n + 2)
            rows.append((e, pos, f"s{pos % 4}", a, a + rng.choice([-2, 0, 1, 5, 20, 100])))
    frames = frame_rows(spark, lengths).withColumnRenamed("name", "_first_name")
    out = j.subtask_of_frame(frames, spark.createDataFrame(rows, INTERVAL_SCHEMA))
    got = {(r.episode_index, r.frame_index): (r.subtask, r.subtask_pos, r.tau, r.in_gap) for r in out.collect()}
    want = {(e, f): cover([r for r in rows if r[0] == e], f) for e, n in enumerate(lengths) for f in range(n)}
    assert got.keys() == want.keys()
    for key, (name, pos, tau, gap) in want.items():
        assert got[key][:2] == (name, pos) and got[key][3] == gap, key
        assert got[key][2] == (None if tau is None else pytest.approx(tau)), key
    assert out.columns == ["episode_index", "frame_index", "_first_name", "subtask", "subtask_pos", "tau", "in_gap"]


def test_subtask_of_frame_empty_and_null(spark, blocks):
    frames = frame_rows(spark, [4]).unionByName(spark.createDataFrame([(None, 2, "x"), (0, None, "y")], FRAME_SCHEMA))
    none = j.subtask_of_frame(frames, spark.createDataFrame([], INTERVAL_SCHEMA))
    assert [r.subtask for r in none.collect()] == [None] * 6
    rows = [(0, 0, "a", 1, 2), (None, 0, "b", 0, 9), (0, 1, "c", None, 9)]
    got = j.subtask_of_frame(frames, spark.createDataFrame(rows, INTERVAL_SCHEMA))
    assert sorted((r.name, r.subtask) for r in got.collect()) == [("n0", None), ("n1", "a"), ("n2", "a"), ("n3", None), ("x", None), ("y", None)]
    assert j.subtask_of_frame(frames.filter("false"), spark.createDataFrame(rows, INTERVAL_SCHEMA)).count() == 0


def test_first_cover_rows_do_not_grow_with_overlaps(spark):
    """2000 nested intervals over one episode: the steps are the ends, and no frame meets more than one of them."""
    n = 2000
    rows = [(0, n - i, "s", i, 2 * n - i) for i in range(n)]
    steps = j.first_cover(spark.createDataFrame(rows, INTERVAL_SCHEMA), "start_frame", "end_frame", F.struct("pos", "name"))
    got = {r._p: r._first for r in steps.collect()}
    assert len(got) == 2 * n
    for p in (0, 1, 777, n - 1, n + 2, 2 * n, 2 * n + 1):
        best = min((r[1] for r in rows if r[3] <= p <= r[4]), default=None)
        assert (got[p].pos if got[p] else None) == best


def test_carry_steps_keeps_values_over_frames(spark, blocks):
    """A struct of a step's columns reaches all frames up to the next step; a step of nulls ends it."""
    steps = spark.createDataFrame([(0, 2, "a"), (0, 5, None), (0, 15, "b"), (1, 1, "c")], "episode_index long, _p long, _first string")
    got = j.carry_steps(frame_rows(spark, [20, 3]), steps, {"_w": F.struct("_first")})
    want = [(0, f, "b" if f >= 15 else "a" if 2 <= f < 5 else None) for f in range(20)] + [(1, 0, None), (1, 1, "c"), (1, 2, "c")]
    assert sorted((r.episode_index, r.frame_index, r._w._first if r._w else None) for r in got.collect()) == want


def test_interval_joins_keep_no_list_on_frames(spark):
    rows = [(0, 0, "a", 1, 2)]
    plan = j.subtask_of_frame(frame_rows(spark, [4]), spark.createDataFrame(rows, INTERVAL_SCHEMA))._jdf.queryExecution().toString()
    assert "collect_list" not in plan and "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_frame_to_episode(spark, blocks):
    """Empty ranges, gaps between ranges, repeated, unknown, negative and null indices."""
    ranges = [(0, 3, 10), (1, 10, 10), (2, 10, 11), (3, 15, 40), (4, 40, 41)]
    episodes = spark.createDataFrame(ranges, "episode_index long, dataset_from_index long, dataset_to_index long")
    asked = [(i,) for i in range(-2, 50)] + [(20,)] * 30 + [(None,)]
    got = j.frame_to_episode(spark.createDataFrame(asked, "index long"), episodes)
    want = sorted((-99 if i is None else i, next((e for e, a, b in ranges if i is not None and a <= i < b), 0)) for (i,) in asked)
    assert sorted((-99 if r["index"] is None else r["index"], r.episode_index) for r in got.collect()) == want
    assert [r.episode_index for r in j.frame_to_episode(spark.createDataFrame([(5,)], "index long"), episodes.filter("false")).collect()] == [0]


@pytest.mark.parametrize("seed", range(3))
def test_nearest_frame(spark, blocks, seed):
    """Frames at equal times, queries half way between two, repeated, null and NaN times, null keys, a key without frames."""
    rng = random.Random(seed)
    frames, queries = [], []
    for e in (0, 1, 2):
        frames += [(e, f, rng.randrange(0, 60) / 4) for f in range(25)]
        queries += [(e, rng.randrange(-8, 140) / 8) for _ in range(20)]
    frames += [(None, 0, 1.0), (0, 99, None), (0, 98, float("nan"))]
    queries += [(7, 1.0), (None, 1.0), (0, None), (0, float("nan"))] + [(1, 3.0)] * 12
    asked = [(i, e, at, f"q{i}") for i, (e, at) in enumerate(queries)]
    fr = spark.createDataFrame(frames, "episode_index long, frame_index long, timestamp double")
    qs = spark.createDataFrame(asked, "id long, episode_index int, query_time double, timestamp string")
    out = j.nearest_frame(qs, fr, 0.5, "id")
    assert out.schema["episode_index"].dataType.typeName() == "integer"
    got = {r.id: (r.nearest_frame, r.distance, r.is_violation, r.timestamp) for r in out.collect()}
    for i, e, at, text in asked:
        near = [
            (abs(t - at), t, f) for k, f, t in frames
            if None not in (k, t, at, e) and k == e and abs(t - at) < 0.5
        ]
        want = (min(near)[2], min(near)[0], False, text) if near else (None, None, True, text)
        assert got[i] == want, (i, e, at)
    assert len(got) == len(asked)


def test_frame_instruction(spark, blocks):
    """First match of each key in order, overlapping ranges, an empty text that does not fall through, and whole episodes."""
    rows = [
        (0, 0, "instruction", None, "do it"), (0, 1, "subtask_generation", "20 30", "late"), (0, 2, "subtask_generation", "5 25", "early"),
        (0, 3, "subtask_generation", "8 8", "point"), (0, 4, "subtask_generation", "2 2", "alone"), (0, 5, "distribute", "24 500", "rest"),
        (0, 6, "subtask_generation", "0 2", ""), (0, 7, "distribute", "0 1", "first"), (0, 8, "other", None, "no"), (1, 0, "distribute", None, "one"),
    ]
    lengths = [40, 3, 2]
    ins = spark.createDataFrame(rows, "episode_index long, pos long, key string, frame_range string, text string")
    got = {(r.episode_index, r.frame_index): r.instruction for r in frame_instruction(frame_rows(spark, lengths), ins).collect()}
    order = ["subtask_generation", "subtask_generation_zh", "distribute", "distribute_zh"]
    for e, n in enumerate(lengths):
        for f in range(n):
            live = {}
            for k, _, key, span, text in rows:
                a, b = map(int, span.split()) if span else (0, n)
                if k == e and (a <= f < b or f == a):
                    live.setdefault(key, text)
            first = next((live[k] for k in order if live.get(k)), None)
            want = "\n" + first if first else live.get("instruction", "")
            assert got[e, f] == want, (e, f)
