import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from trajspark.operators import algebra as a
from trajspark.operators import packing as k
from trajspark.operators import schema as b
from trajspark.operators import stats as s
from trajspark.sources import dataset_io as io


def check_invariants(ds, lengths):
    frames = sorted(ds.frames.select("episode_index", "frame_index", "index").collect(), key=lambda r: r["index"])
    assert [r["index"] for r in frames] == list(range(sum(lengths)))
    assert [(r.episode_index, r.frame_index) for r in frames] == [(e, f) for e, n in enumerate(lengths) for f in range(n)]
    eps = ds.episodes.orderBy("episode_index").collect()
    assert [r.length for r in eps] == lengths
    ends = np.cumsum(lengths).tolist()
    assert [r.dataset_to_index for r in eps] == ends and [r.dataset_from_index for r in eps] == [0, *ends[:-1]]


def test_delete_renumbers(dataset, lengths, blocks):
    out = a.delete_episodes(dataset, [0, 2])
    check_invariants(out, [1, 23, 8])
    assert out.info["splits"] == {"train": "0:3"}
    # Episodes 1, 3 use task_1, episode 4 task_0: first seen first.
    assert [r.task for r in out.tasks.orderBy("task_index").collect()] == ["task_1", "task_0"]


@pytest.mark.parametrize("ids", [[], [99], [0, 1, 2, 3, 4]])
def test_delete_errors(dataset, ids):
    with pytest.raises(ValueError):
        a.delete_episodes(dataset, ids)


def test_delete_recombines_stats(dataset):
    features = {"observation.state": dataset.features["observation.state"]}
    ds = dataset.with_(episode_stats=s.episode_stats(dataset.frames, features))
    out = a.delete_episodes(ds, [0])
    direct = s.dataset_quantiles(out.frames, features).orderBy("dim").collect()
    for got, want in zip(out.stats.orderBy("dim").collect(), direct):
        assert got["count"] == want["count"] and got["mean"] == pytest.approx(want["mean"]) and got["std"] == pytest.approx(want["std"])


def test_split_rules(dataset, blocks):
    parts = a.split(dataset, {"train": 0.6, "none": 0.1, "val": 0.2})
    assert set(parts) == {"train", "val"}
    check_invariants(parts["train"], [60, 1, 5])
    check_invariants(parts["val"], [23, 8])
    with pytest.raises(ValueError):
        a.split_plan(5, {"a": 0.7, "b": 0.7})
    with pytest.raises(ValueError):
        a.split_plan(5, {"a": [0, 1], "b": [1, 2]})
    with pytest.raises(ValueError):
        a.split_plan(5, {"a": []})
    assert a.split_plan(5, {"a": [3, 0], "b": [4]}) == {"a": [0, 3], "b": [4]}


def test_merge_twice(dataset, lengths, blocks):
    one = a.merge([dataset, dataset])
    check_invariants(one, lengths * 2)
    check_invariants(a.merge([one, dataset]), lengths * 3)
    assert one.tasks.count() == 2
    with pytest.raises(ValueError, match="fps"):
        a.merge([dataset, dataset.with_(info={**dataset.info, "fps": 30})])


def test_modify_tasks(dataset):
    out = a.modify_tasks(dataset, None, {1: "zz", 3: "aa"})
    got = {r.episode_index: r.tasks for r in out.episodes.collect()}
    assert got == {0: ["task_0"], 1: ["zz"], 2: ["task_0"], 3: ["aa"], 4: ["task_0"]}
    assert [r.task for r in out.tasks.orderBy("task_index").collect()] == ["aa", "task_0", "zz"]
    with pytest.raises(ValueError):
        a.modify_tasks(dataset)
    with pytest.raises(ValueError):
        a.modify_tasks(dataset, episode_tasks={77: "x"})


def test_register_tasks_rejects_duplicates(dataset):
    with pytest.raises(ValueError):
        a.register_tasks(dataset.tasks, ["x", "x"])
    got = a.register_tasks(dataset.tasks, ["task_1", "new"]).orderBy("task_index").collect()
    assert [(r.task_index, r.task) for r in got] == [(0, "task_0"), (1, "task_1"), (2, "new")]


def test_feature_edits(dataset):
    one = {"dtype": "float64", "shape": [1]}
    out = b.modify_features(dataset, {"half": (F.col("reward") / 2, one)}, ["observation.state"])
    assert "half" in out.frames.columns and "observation.state" not in out.features
    for bad in (["nope"], ["timestamp"]):
        with pytest.raises(ValueError):
            b.remove_features(dataset, bad)
    with pytest.raises(ValueError):
        b.add_features(dataset, {"reward": (F.lit(1.0), one)})
    with pytest.raises(ValueError):
        b.add_features(dataset, {"x": (F.lit(1.0), {"dtype": "float64"})})
    with pytest.raises(ValueError):
        b.modify_features(dataset)


def test_vector_specs_merge():
    one = {"action": {"dtype": "float32", "shape": [2], "names": ["a", "b"]}}
    two = {"action": {"dtype": "float32", "shape": [2], "names": ["b", "c"]}}
    assert b.merge_vector_specs(one, two)["action"] == {"dtype": "float32", "shape": [3], "names": ["a", "b", "c"]}
    with pytest.raises(ValueError):
        b.merge_vector_specs(one, {"action": {"dtype": "int64", "shape": [1], "names": ["a"]}})


def test_schema_rules():
    with pytest.raises(ValueError):
        b.feature_type("a/b", {"dtype": "float32", "shape": [1]})
    with pytest.raises(ValueError):
        b.feature_type("a", {"dtype": "float32", "shape": [1, 2, 3, 4, 5, 6]})
    assert b.feature_type("v", {"dtype": "video", "shape": [3, 8, 8]}) is None


def greedy(sizes, cap):
    out, group, held = [], 0, None
    for s_ in sizes:
        if held is not None and held + s_ > cap:
            group, held = group + 1, 0
        held = (held or 0) + s_
        out.append(group)
    return out


@pytest.mark.parametrize("kind", ["random", "equal", "huge"])
def test_pack_groups_equals_greedy_fold(spark, blocks, kind):
    rng = np.random.default_rng(3)
    sizes = {"random": rng.integers(1, 40, 200), "equal": np.full(200, 7), "huge": rng.integers(90, 300, 60)}[kind].tolist()
    df = spark.createDataFrame([(i, s_) for i, s_ in enumerate(sizes)], "episode_index long, bytes long").repartition(3)
    got = [r.group_no for r in k.pack_groups(df, "episode_index", {"bytes": 100}).orderBy("episode_index").collect()]
    assert got == greedy(sizes, 100)


@pytest.mark.parametrize("seed", range(3))
def test_pack_groups_several_caps_and_keys(spark, blocks, seed):
    rng = np.random.default_rng(seed)
    rows, want = [], {}
    for key, n in (("a", 90), ("b", 1), ("c", 33)):
        # Zeros, tiny and giant items in turn: pointers skip blocks and many items wait for one.
        sizes = np.where(rng.random(n) < 0.1, rng.integers(200, 900, n), rng.integers(0, 3, n))
        counts = rng.integers(0, 5, n)
        group, held, number = -1, (0, 0), []
        for s_, x in zip(sizes.tolist(), counts.tolist(), strict=True):
            if group < 0 or held[0] + s_ > 500 or held[1] + x > 40:
                group, held = group + 1, (0, 0)
            held = (held[0] + s_, held[1] + x)
            number.append(group)
        want |= {(key, i): g for i, g in enumerate(number)}
        rows += [(key, i, s_, x) for i, (s_, x) in enumerate(zip(sizes.tolist(), counts.tolist(), strict=True))]
    df = spark.createDataFrame(rows, "k string, at long, bytes long, x long").repartition(3)
    got = {(r["k"], r["at"]): r["g"] for r in k.pack_groups(df, "at", {"bytes": 500, "x": 40}, "g", ["k"]).collect()}
    assert got == want
    assert k.pack_groups(df.filter("1 = 0"), "at", {"bytes": 500}, "g").count() == 0


def test_pack_groups_of_many_tiny_items(spark):
    """A million items in one group and in small ones; every task of the packing gets two blocks at most."""
    spark.conf.set("spark.trajspark.blockRows", "50000")
    try:
        items = spark.range(1_000_000).select(F.col("id").alias("at"), F.lit(1).alias("bytes"))
        for cap, groups in ((10_000_000, 1), (999, 1002)):
            out = k.pack_groups(items, "at", {"bytes": cap}, "g")
            found = out.agg(F.max("g"), F.count("g"), F.sum((F.col("g") != F.floor(F.col("at") / cap)).cast("int"))).first()
            assert tuple(found) == (groups - 1, 1_000_000, 0)
    finally:
        spark.conf.unset("spark.trajspark.blockRows")


def test_many_small_files(spark, dataset, tmp_path):
    """Each episode is a file: a few tasks list their folders, and an append goes through its rows four times."""
    n, root = 40, str(tmp_path / "ds")
    rows = spark.range(n).select(
        F.col("id").alias("episode_index"), F.lit(0).cast("long").alias("frame_index"), F.col("id").alias("index"), F.lit(0).cast("long").alias("task_index"), F.lit(0.0).cast("float").alias("timestamp")
    )
    episodes = spark.range(n).select(
        F.col("id").alias("episode_index"), F.lit(1).cast("long").alias("length"), F.col("id").alias("dataset_from_index"), (F.col("id") + 1).alias("dataset_to_index")
    )
    io.write_dataset(dataset.with_(frames=rows, episodes=episodes, info={"fps": 10}), root, max_mb=0.5, bytes_per_frame=600_000)
    assert len(list((tmp_path / "ds" / "data").rglob("part-*.parquet"))) == n
    sc = spark.sparkContext
    conf, group = "spark.sql.sources.parallelPartitionDiscovery.parallelism", f"listing {root}"
    before = spark.conf.get(conf)
    sc.setJobGroup(group, group)
    read = io.read_dataset(spark, root)
    sc.setLocalProperty("spark.jobGroup.id", None)
    tracker = sc.statusTracker()
    tasks = [tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    assert 1 <= max(tasks) <= 2 * sc.defaultParallelism < n
    assert read.frames.count() == n and spark.conf.get(conf) == before

    seen = sc.accumulator(0)

    def count(parts):
        for pdf in parts:
            seen.add(len(pdf))
            yield pdf

    recorded = spark.range(n).select((F.col("id") % 10).alias("key"), F.col("id").alias("t"), F.concat(F.lit("new_"), F.col("id") % 3).alias("task"))
    grown = io.append_dataset(spark, root, recorded.mapInPandas(count, recorded.schema), "key", ["t"])
    assert seen.value <= 4 * n
    assert [r[0] for r in grown.frames.orderBy("index").select("index").collect()] == list(range(2 * n))
    assert [tuple(r) for r in grown.tasks.orderBy("task_index").collect()] == [(0, "task_0"), (1, "task_1"), (2, "new_0"), (3, "new_1"), (4, "new_2")]


def test_round_trip_append_publish(spark, dataset, lengths, tmp_path, blocks):
    root = str(tmp_path / "ds")
    ds = io.write_dataset(dataset, root, max_mb=0.001, bytes_per_frame=40)
    check_invariants(ds, lengths)
    files = ds.episodes.select("`data/chunk_index`", "`data/file_index`").distinct().count()
    assert files > 1
    rows = spark.createDataFrame([("k", i, "new task", float(i)) for i in range(12)], "key string, t long, task string, reward double")
    grown = io.append_dataset(spark, root, rows, "key", ["t"])
    check_invariants(grown, [*lengths, 12])
    assert grown.tasks.count() == 3
    last = grown.episodes.orderBy(F.col("episode_index").desc()).first()
    assert last["data/file_index"] == files
    assert io.validate_files(spark, root).count() > 0
    io.publish_names(spark, root)
    assert io.validate_files(spark, root).count() == 0
    some = io.read_dataset(spark, root, [1, 3])
    assert sorted((r.episode_index, r.n) for r in some.frames.groupBy("episode_index").agg(F.count("*").alias("n")).collect()) == [(1, 1), (3, 23)]
    assert json.loads((tmp_path / "ds/meta/info.json").read_text())["total_frames"] == sum(lengths) + 12


def test_named_file_of_several_tasks(spark, dataset, tmp_path):
    """Blocks of an episode in one file come from several tasks; reading that episode takes all their parts."""
    root = str(tmp_path / "ds")
    spark.conf.set("spark.trajspark.blockRows", "7")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        io.write_dataset(dataset, root, max_mb=0.001, bytes_per_frame=40)
        io.publish_names(spark, root)
        assert list((tmp_path / "ds/data").rglob("file-*-1.parquet"))
        assert io.read_dataset(spark, root, [0, 3]).frames.groupBy("episode_index").count().orderBy("episode_index").collect() == [(0, 60), (3, 23)]
    finally:
        spark.conf.unset("spark.trajspark.blockRows")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_versions():
    with pytest.raises(ValueError):
        io.check_version({"codebase_version": "v2.1"})
    io.check_version({"codebase_version": "v3.0"})


def test_convert_legacy(spark, frames, lengths, tmp_path):
    root, pdf = tmp_path / "old", frames.toPandas()
    (root / "meta").mkdir(parents=True)
    (root / "data/chunk-000").mkdir(parents=True)
    episodes, stats = [], []
    for e, part in pdf.groupby("episode_index"):
        part.sort_values("frame_index").drop(columns=["index"]).to_parquet(root / f"data/chunk-000/episode_{e:06d}.parquet")
        x = np.stack(part["observation.state"])
        episodes.append({"episode_index": int(e), "tasks": [f"task_{e % 2}"], "length": len(part)})
        one = {"min": x.min(0), "max": x.max(0), "mean": x.mean(0), "std": x.std(0)}
        stats.append({"episode_index": int(e), "stats": {"observation.state": {**{n: v.tolist() for n, v in one.items()}, "count": [len(x)]}}})
    (root / "meta/episodes.jsonl").write_text("\n".join(map(json.dumps, episodes)))
    (root / "meta/episodes_stats.jsonl").write_text("\n".join(map(json.dumps, stats)))
    (root / "meta/tasks.jsonl").write_text("\n".join(json.dumps({"task_index": i, "task": f"task_{i}"}) for i in range(2)))
    info = {"codebase_version": "v2.1", "fps": 10.0, "total_chunks": 1, "features": {"observation.state": {"dtype": "float64", "shape": [2], "names": None}}}
    (root / "meta/info.json").write_text(json.dumps(info))
    ds = io.convert_legacy(spark, str(root), str(tmp_path / "new"), max_mb=0.01)
    check_invariants(ds, lengths)
    assert ds.info["fps"] == 10 and "total_chunks" not in ds.info
    x = np.stack(pdf["observation.state"])
    got = {r.dim: r for r in ds.stats.collect()}
    for d in range(2):
        assert got[d]["mean"] == pytest.approx(x[:, d].mean()) and got[d]["std"] == pytest.approx(x[:, d].std())
    (root / "meta/episodes.jsonl").write_text("\n".join(map(json.dumps, episodes[:-1])))
    with pytest.raises(ValueError, match="differ"):
        io.convert_legacy(spark, str(root), str(tmp_path / "bad"))


def test_filter_episodes_by_table_keeps_one_copy_of_the_ids(spark, frames, dataset):
    """Repeated ids, a null id, a table without ``index`` and a long list; no copies of the ids for salts."""
    ids = spark.createDataFrame([(1,), (3,), (3,), (None,), (99,)], "episode_index long")
    out = b.filter_episodes(frames, ids)
    assert sorted(r.episode_index for r in out.collect()) == [1] + [3] * 23
    assert "Generate" not in out._jdf.queryExecution().toString()
    some = b.filter_episodes(dataset.episodes, [1, 3, *range(100, 101 + b.SHORT_LIST)])
    assert sorted(r.episode_index for r in some.collect()) == [1, 3]


def test_pack_videos_query_numbers_files_over_chunks(spark, monkeypatch):
    """More files than a chunk holds: the query's file number goes on, as in its SQL."""
    from types import SimpleNamespace

    from trajspark.plans import dataset_queries as q

    episodes = spark.range(1003).select(F.col("id").alias("episode_index"), F.lit(600).cast("long").alias("length"))
    monkeypatch.setattr(q, "frames_events", lambda spark, d: SimpleNamespace(episodes=episodes))
    got = {r.episode_index: r.file_index for r in q.k2(spark, "").collect()}
    assert got == {e: e for e in range(1003)}


def test_convert_legacy_opens_the_files_once_for_their_sizes(spark, tmp_path, monkeypatch):
    """The sizes of the episodes are kept, so their plan reads no files; an episode without metadata is still an error."""
    from trajspark.plans import io_queries as q

    root = q.older_layout(spark, "/root/testdata/sf0.001")
    seen, real = [], io.pack_files
    monkeypatch.setattr(io, "pack_files", lambda df, *args, **kw: seen.append(df) or real(df, *args, **kw))
    io.convert_legacy(spark, root, str(tmp_path / "out"), max_mb=0.5)
    assert f"{root}/data" not in seen[0]._jdf.queryExecution().toString() and not seen[0].inputFiles()
