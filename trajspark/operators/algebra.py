"""Whole-dataset operators: delete, split, merge, relabel, append, convert.

Every edit is planned on the episode table and reaches the frames through one join on ``(episode, block)``.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from trajspark.dataset import CHUNK_FILES, EpisodicDataset
from trajspark.functions.columns import c
from trajspark.operators.layout import EPISODE, FRAME, dictionary_join, join_episodes, look_around, positions, running, set_checkpoint_dir
from trajspark.operators.schema import compat_problems
from trajspark.operators.stats import combine_stats, episode_stats

log = logging.getLogger(__name__)


# ---------------------------------------------------------------- re-indexing


def lay_out(episodes: DataFrame, first_index: int = 0) -> DataFrame:
    """Global half-open ranges from dense ``episode_index`` and ``length``."""
    summed = running(episodes.drop("dataset_from_index", "dataset_to_index"), {"_end": ("sum", F.col("length"))}, keys=(), order=EPISODE)
    return summed.withColumns(
        {
            "dataset_from_index": (F.col("_end") - F.col("length") + first_index).cast("long"),
            "dataset_to_index": (F.col("_end") + first_index).cast("long"),
        }
    ).drop("_end")


def renumber(episodes: DataFrame) -> DataFrame:
    """Dense new numbers in old order; the old number stays as ``_old``."""
    kept = episodes.withColumnRenamed(EPISODE, "_old")
    return lay_out(positions(kept, EPISODE, ["_old"]))


def used_tasks(frames: DataFrame, tasks: DataFrame) -> DataFrame:
    """Tasks still used, numbered by first appearance; ``_old`` is the previous number."""
    seen = frames.groupBy("task_index").agg(F.min("index").alias("_seen"))
    named = seen.join(tasks.select("task_index", "task"), "task_index").withColumnRenamed("task_index", "_old")
    return positions(named, "task_index", ["_seen"]).drop("_seen")


def reindex(ds: EpisodicDataset, episodes: DataFrame) -> EpisodicDataset:
    """Dataset on the given episodes, with dense numbers, rebuilt tasks and recombined statistics."""
    numbered = renumber(episodes)
    plan = numbered.select(
        F.col("_old").alias(EPISODE), F.col(EPISODE).alias("_new"), F.col("dataset_from_index").alias("_from"), F.col("length").alias("_length")
    )
    frames = join_episodes(ds.frames, plan, length="_length")
    tasks = used_tasks(frames, ds.tasks)
    remap = tasks.select(F.col("_old").alias("task_index"), F.col("task_index").alias("_task"))
    frames = dictionary_join(frames, remap, "task_index", ["index"], "inner")
    out = {EPISODE: F.col("_new"), "index": F.col("_from") + F.col(FRAME), "task_index": F.col("_task")}
    frames = frames.withColumns(out).select(*[c(n) for n in ds.frames.columns])

    per_episode = stats = None
    if ds.episode_stats is not None:
        moved = ds.episode_stats.join(plan.select(EPISODE, "_new"), EPISODE)
        known = list(ds.features) or None
        per_episode = moved.withColumn(EPISODE, F.col("_new")).drop("_new")
        per_episode = per_episode.filter(F.col("feature").isin(known)) if known else per_episode
        stats = combine_stats(per_episode)
    return ds.with_(
        frames=frames,
        episodes=numbered.drop("_old"),
        tasks=tasks.select("task_index", "task"),
        stats=stats,
        episode_stats=per_episode,
    )


def _check_ids(ds: EpisodicDataset, ids: Sequence[int]) -> int:
    """Number of episodes; raises when an id is unknown. Reads one column of the episode table."""
    ids = {int(i) for i in ids}
    row = ds.episodes.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(EPISODE).isin(list(ids)), 1)).alias("known")
    ).first()
    if row["known"] != len(ids):
        known = {r[0] for r in ds.episodes.filter(F.col(EPISODE).isin(list(ids))).select(EPISODE).collect()}
        raise ValueError(f"unknown episodes: {sorted(ids - known)}")
    return row["n"]


def delete_episodes(ds: EpisodicDataset, ids: Sequence[int]) -> EpisodicDataset:
    """Drop episodes; the rest is renumbered densely in old order."""
    if not ids:
        raise ValueError("no episodes to delete")
    total = _check_ids(ds, ids)
    left = total - len(set(ids))
    if left == 0:
        raise ValueError("cannot delete all episodes")
    out = reindex(ds, ds.episodes.filter(~F.col(EPISODE).isin([int(i) for i in ids])))
    return _with_totals(out, "train")


def _with_totals(ds: EpisodicDataset, split_name: str) -> EpisodicDataset:
    """Totals and splits of ``info`` from the tables."""
    row = ds.episodes.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("rows")).first()
    totals = {"total_episodes": row["n"], "total_frames": row["rows"], "total_tasks": ds.tasks.count()}
    return ds.with_(info={**ds.info, **totals, "splits": {split_name: f"0:{row['n']}"}})


def split_plan(total: int, parts: Mapping[str, float | Sequence[int]]) -> dict[str, range | list[int]]:
    """Episode ids per split.

    Fractions take ``int(total * f)`` consecutive episodes each, splits for which that is 0 are skipped, and the last split
    takes everything left; id lists must be non-empty, disjoint and valid.
    """
    if not parts:
        raise ValueError("no splits given")
    if all(isinstance(v, float) for v in parts.values()):
        if sum(parts.values()) > 1.0 + 1e-9:
            raise ValueError("fractions sum to more than 1")
        out, start, names = {}, 0, list(parts)
        for name in names:
            size = int(total * parts[name])
            if size > 0 and name == names[-1]:
                size = total - start
            if size <= 0:
                log.warning("split %s is empty and is skipped", name)
                continue
            out[name] = range(start, start + size)
            start += size
        return out
    seen: set[int] = set()
    for name, ids in parts.items():
        if not ids:
            raise ValueError(f"split {name} has no episodes")
        if seen & set(ids):
            raise ValueError(f"split {name} shares episodes {sorted(seen & set(ids))}")
        bad = [i for i in ids if not 0 <= i < total]
        if bad:
            raise ValueError(f"split {name} has unknown episodes {bad}")
        seen |= set(ids)
    return {k: sorted(v) for k, v in parts.items()}


def split(ds: EpisodicDataset, parts: Mapping[str, float | Sequence[int]]) -> dict[str, EpisodicDataset]:
    """One re-indexed dataset per split."""
    total = ds.episodes.count()
    out = {}
    for name, ids in split_plan(total, parts).items():
        e = F.col(EPISODE)
        mask = e.between(ids.start, ids.stop - 1) if isinstance(ids, range) else e.isin(list(ids))
        part = reindex(ds, ds.episodes.filter(mask))
        out[name] = _with_totals(part, name)
    return out


# ---------------------------------------------------------------- merge


def merge(members: Sequence[EpisodicDataset]) -> EpisodicDataset:
    """Concatenate compatible datasets: offsets for episodes and indices, one task dictionary in first-seen order."""
    if not members:
        raise ValueError("nothing to merge")
    problems = compat_problems([m.info for m in members])
    if problems:
        raise ValueError("; ".join(problems))

    def stacked(table: str) -> DataFrame:
        out = None
        for i, m in enumerate(members):
            part = getattr(m, table).withColumn("_source", F.lit(i))
            out = part if out is None else out.unionByName(part, allowMissingColumns=True)
        return out

    episodes = stacked("episodes")
    # One row per source dataset.
    sizes = episodes.groupBy("_source").agg(F.count(F.lit(1)).alias("_n"), F.sum("length").alias("_rows"))
    before = Window.orderBy("_source").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_source",
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_episodes_before"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_rows_before"),
    )
    named = stacked("tasks").groupBy("task").agg(F.min(F.struct("_source", "task_index")).alias("_seen"))
    named = named.select("task", F.col("_seen._source").alias("_s"), F.col("_seen.task_index").alias("_t"))
    tasks = positions(named, "task_index", ["_s", "_t"]).select("task_index", "task")
    remap = stacked("tasks").join(tasks.withColumnRenamed("task_index", "_new_task"), "task").select("_source", "task_index", "_new_task")

    frames = dictionary_join(stacked("frames"), offsets, "_source", [EPISODE, FRAME], "inner")
    frames = dictionary_join(frames, remap, ["_source", "task_index"], [EPISODE, FRAME], "inner")
    frames = frames.withColumns(
        {
            EPISODE: F.col(EPISODE) + F.col("_episodes_before"),
            "index": F.col("index") + F.col("_rows_before"),
            "task_index": F.col("_new_task"),
        }
    ).select(*[c(n) for n in members[0].frames.columns])
    moved = dictionary_join(episodes, offsets, "_source", [EPISODE], "inner")
    moved = moved.withColumns(
        {
            EPISODE: F.col(EPISODE) + F.col("_episodes_before"),
            "dataset_from_index": F.col("dataset_from_index") + F.col("_rows_before"),
            "dataset_to_index": F.col("dataset_to_index") + F.col("_rows_before"),
        }
    ).drop("_episodes_before", "_rows_before", "_source")

    per_episode = stats = None
    if all(m.episode_stats is not None for m in members):
        parts = dictionary_join(stacked("episode_stats"), offsets, "_source", [EPISODE], "inner")
        per_episode = parts.withColumn(EPISODE, F.col(EPISODE) + F.col("_episodes_before")).drop("_source", "_episodes_before", "_rows_before")
    if all(m.stats is not None for m in members):
        stats = combine_stats(stacked("stats"))
    return _with_totals(EpisodicDataset(frames, moved, tasks, dict(members[0].info), stats, per_episode), "train")


def shift_file_ids(episodes: DataFrame, plan: DataFrame, key: str) -> DataFrame:
    """Source file numbers to destination numbers, with the time already in the destination file added.

    ``plan`` holds ``_source, chunk, file, to_chunk, to_file, time_before`` per source file.
    """
    names = [f"videos/{key}/chunk_index", f"videos/{key}/file_index"]
    mapped = plan.select(
        "_source", F.col("chunk").alias(names[0]), F.col("file").alias(names[1]), "to_chunk", "to_file", "time_before"
    )
    joined = dictionary_join(episodes, mapped, ["_source", *names], [EPISODE], "inner")
    times = [f"videos/{key}/from_timestamp", f"videos/{key}/to_timestamp"]
    return joined.withColumns(
        {names[0]: F.col("to_chunk"), names[1]: F.col("to_file"), **{t: c(t) + F.col("time_before") for t in times}}
    ).drop("to_chunk", "to_file", "time_before")


def merge_shards(shards: DataFrame, chunk_files: int = CHUNK_FILES) -> DataFrame:
    """Offsets of conversion shards: ``shard_index`` (dense), ``n_files``, ``n_frames``, ``n_episodes`` per row."""
    done = running(shards, {f"_{n}": ("sum", c(n)) for n in ("n_files", "n_frames", "n_episodes")}, keys=(), order="shard_index")
    first = F.col("_n_files") - F.col("n_files")
    return done.select(
        "shard_index",
        first.cast("long").alias("first_file"),
        F.floor(first / chunk_files).alias("first_chunk_index"),
        (first % chunk_files).cast("long").alias("first_file_index"),
        (F.col("_n_frames") - F.col("n_frames")).cast("long").alias("frame_offset"),
        (F.col("_n_episodes") - F.col("n_episodes")).cast("long").alias("episode_offset"),
    )


# ---------------------------------------------------------------- tasks


def modify_tasks(ds: EpisodicDataset, new_task: str | None = None, episode_tasks: Mapping[int, str] | None = None) -> EpisodicDataset:
    """One task per episode: its override, else the default, else its first original task; sorted new dictionary."""
    if new_task is None and episode_tasks is None:
        raise ValueError("give a new task or tasks per episode")
    if episode_tasks:
        _check_ids(ds, list(episode_tasks))
    spark = ds.frames.sparkSession
    rows = [(int(k), v) for k, v in (episode_tasks or {}).items()]
    overrides = spark.createDataFrame(rows, f"{EPISODE} long, _override string")
    original = F.get(F.col("tasks"), 0) if "tasks" in ds.episodes.columns else F.lit(None).cast("string")
    default = F.lit(new_task) if new_task is not None else original
    episodes = ds.episodes.join(overrides, EPISODE, "left").withColumn("_task", F.coalesce("_override", default)).drop("_override")
    if new_task is None and not episodes.filter(F.col("_task").isNull()).isEmpty():
        raise ValueError("an episode has no task and no default was given")
    texts = episodes.select(F.col("_task").alias("task")).distinct()
    tasks = positions(texts, "task_index", ["task"])
    numbered = dictionary_join(episodes, tasks.withColumnRenamed("task", "_task").withColumnRenamed("task_index", "_ti"), "_task", [EPISODE], "inner")
    plan = numbered.select(EPISODE, "_ti", F.col("length").alias("_length"))
    frames = join_episodes(ds.frames, plan, length="_length").withColumn("task_index", F.col("_ti"))
    if "task" in ds.frames.columns:
        frames = join_episodes(frames.drop("task"), numbered.select(EPISODE, F.col("_task").alias("task"), "length"), length="length")
    return ds.with_(
        frames=frames.select(*[c(n) for n in ds.frames.columns]),
        episodes=numbered.withColumn("tasks", F.array("_task")).drop("_task", "_ti"),
        tasks=tasks.select("task_index", "task"),
    )


def register_tasks(tasks: DataFrame, texts: Sequence[str] | DataFrame) -> DataFrame:
    """Dictionary with unseen texts appended; a text given twice in one call raises."""
    if not isinstance(texts, DataFrame):
        if len(set(texts)) != len(texts):
            raise ValueError("tasks are not unique")
        texts = tasks.sparkSession.createDataFrame([(t, i) for i, t in enumerate(texts)], "task string, _order long")
    elif "_order" not in texts.columns:
        raise ValueError("a table of tasks needs an _order column")
    new = texts.join(tasks.select("task"), "task", "left_anti")
    size = tasks.agg(F.coalesce(F.max("task_index") + 1, F.lit(0)).alias("_next"))
    first = size.first()["_next"]
    numbered = positions(new, "_at", ["_order"]).select((F.col("_at") + first).alias("task_index"), "task")
    return tasks.select("task_index", "task").unionByName(numbered)


# ---------------------------------------------------------------- append and rebuild


def new_episode_parts(
    ds: EpisodicDataset, rows: DataFrame, key: str, order: Sequence[str]
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(frames, episodes, tasks) for recorded rows, numbered to follow ``ds``.

    ``rows`` has one episode per ``key``, a ``task`` text and the feature columns; ``timestamp`` is ``frame_index / fps``
    unless given. The episodes keep ``key``.
    """
    last = ds.episodes.agg(F.coalesce(F.max(EPISODE) + 1, F.lit(0)), F.coalesce(F.max("dataset_to_index"), F.lit(0))).first()
    first_episode, first_index = int(last[0]), int(last[1])
    framed = positions(rows, FRAME, order, [key])
    # The lengths and the texts seen are kept: each use would go through all rows again.
    set_checkpoint_dir(rows)
    lengths = rows.groupBy(c(key)).agg(F.count(F.lit(1)).alias("length")).checkpoint()
    laid = lay_out(positions(lengths, EPISODE, [key]), first_index)
    plan = laid.select(c(key), F.col(EPISODE).alias("_e"), "dataset_from_index", "length")
    framed = join_episodes(framed, plan, keys=(key,)).withColumns(
        {EPISODE: F.col("_e") + first_episode, "index": F.col("dataset_from_index") + F.col(FRAME)}
    )
    seen = framed.groupBy("task").agg(F.min("index").alias("_order")).checkpoint()
    tasks = register_tasks(ds.tasks, seen)
    framed = dictionary_join(framed, tasks, "task", ["index"], "inner")
    if "timestamp" not in rows.columns:
        framed = framed.withColumn("timestamp", (F.col(FRAME) / F.lit(float(ds.fps))).cast("float"))
    frames = framed.select(*[c(n) for n in ds.frames.columns if n in framed.columns])
    return frames, laid.withColumn(EPISODE, F.col(EPISODE) + first_episode), tasks


def append_episodes(ds: EpisodicDataset, rows: DataFrame, key: str, order: Sequence[str], features: Mapping | None = None) -> EpisodicDataset:
    """Append many recorded episodes: assign all index columns, register tasks, extend the statistics."""
    new_frames, new_episodes, tasks = new_episode_parts(ds, rows, key, order)
    per_episode = stats = None
    if ds.episode_stats is not None:
        added = episode_stats(new_frames, features or ds.user_features())
        per_episode = ds.episode_stats.unionByName(added, allowMissingColumns=True)
        stats = combine_stats(per_episode)
    return ds.with_(
        frames=ds.frames.unionByName(new_frames, allowMissingColumns=True),
        episodes=ds.episodes.unionByName(new_episodes.drop(key), allowMissingColumns=True),
        tasks=tasks,
        stats=stats,
        episode_stats=per_episode,
    )


def replay_to_frames(transitions: DataFrame, fps: float, order: str = "index") -> DataFrame:
    """Episodes from a flat log in insertion order: an episode ends at ``done or truncated``; leftovers form a last one."""
    ended = F.coalesce(c("done"), F.lit(False)) | F.coalesce(c("truncated"), F.lit(False))
    flagged = look_around(transitions.withColumn("_end", ended), {"_prev": (F.col("_end"), -1)}, keys=(), order=order)
    starts = F.coalesce(F.col("_prev"), F.lit(False)) | (c(order) == 0)
    scanned = running(
        flagged.withColumn("_start", starts),
        {"_count": ("sum", F.col("_start").cast("long")), "_from": ("last", F.when(F.col("_start"), c(order)))},
        keys=(),
        order=order,
    )
    frame = c(order) - F.col("_from")
    return scanned.withColumns(
        {EPISODE: F.col("_count") - 1, FRAME: frame, "timestamp": frame / F.lit(float(fps))}
    ).drop("_end", "_prev", "_start", "_count", "_from")


def compile_rollouts(steps: DataFrame, fps: float, observation: Sequence[str], first_index: int = 0, length: str = "n_steps") -> DataFrame:
    """Rollout steps to frames: rows up to the first done, then one row with the following observation.

    ``steps`` has ``episode_index``, ``step`` and the number of steps per episode. The other keys of the extra row repeat
    those of the last kept row; a rollout without done keeps all its rows.
    """
    ends = steps.groupBy(EPISODE).agg(F.min(F.when(F.col("done"), F.col("step"))).alias("_done"), (F.max("step") + 1).alias(length))
    ends = ends.withColumn("_last", F.coalesce("_done", F.col(length) - 1))
    sized = lay_out(ends.withColumn("length", F.col("_last") + 2), first_index).select(EPISODE, "_last", length, "dataset_from_index")
    looks = {f"_next{i}": (F.struct(c(o).alias("v")), 1) for i, o in enumerate(observation)}
    base = look_around(steps.drop(length), looks, order="step")
    kept = join_episodes(base, sized, length=length, order="step").filter(F.col("step") <= F.col("_last"))
    twice = F.when(F.col("step") == F.col("_last"), F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    both = kept.withColumn("_pad", F.explode(twice))
    frame = (F.col("step") + F.col("_pad")).cast("long")
    observed = {o: F.when(F.col("_pad") == 1, F.coalesce(c(f"_next{i}")["v"], c(o))).otherwise(c(o)) for i, o in enumerate(observation)}
    out = both.withColumns({**observed, FRAME: frame, "index": F.col("dataset_from_index") + frame, "timestamp": frame / F.lit(float(fps))})
    return out.drop("_pad", "_last", "step", length, "dataset_from_index", *looks)


def images_to_external(ds: EpisodicDataset, keys: Sequence[str], ids: Sequence[int], file_plan: DataFrame | None = None) -> EpisodicDataset:
    """Selected episodes without their image columns; the file locators of ``file_plan`` join the episode table."""
    _check_ids(ds, ids)
    picked = ds.with_(frames=ds.frames.drop(*keys), info={**ds.info, "features": {
        k: ({**v, "dtype": "video"} if k in keys else v) for k, v in ds.features.items()
    }})
    episodes = ds.episodes.filter(F.col(EPISODE).isin([int(i) for i in ids]))
    if file_plan is not None:
        episodes = episodes.join(file_plan, EPISODE)
    return reindex(picked, episodes)


def dataset_info(ds: EpisodicDataset, file_bytes: int | None = None) -> DataFrame:
    """Totals and means in one aggregate over the episode table."""
    n, frames = F.count(F.lit(1)), F.sum("length")
    return ds.episodes.agg(
        n.alias("total_episodes"),
        frames.cast("long").alias("total_frames"),
        (frames / n).alias("mean_frames"),
        (frames / n / F.lit(float(ds.fps))).alias("mean_seconds"),
        F.lit(float(ds.fps)).alias("fps"),
        F.lit(file_bytes).cast("long").alias("bytes"),
        F.lit(len(ds.features)).cast("long").alias("n_features"),
    )


# ---------------------------------------------------------------- sets


def union_sorted(parts: Sequence[DataFrame], order: str = "index") -> DataFrame:
    """Shards put together in index order; the sort is range-partitioned."""
    return union_all(parts).orderBy(c(order))


def union_all(parts: Sequence[DataFrame]) -> DataFrame:
    """Concatenate batches; columns only some have are null in the others."""
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part, allowMissingColumns=True)
    return out


def common_features(specs: Sequence[Mapping[str, Mapping]]) -> list[str]:
    return [n for n in specs[0] if all(n in s for s in specs)]


def unused_tasks(frames: DataFrame, tasks: DataFrame) -> DataFrame:
    used = frames.select("task_index").distinct()
    return tasks.join(used, "task_index", "left_anti")


def episodes_to_keep(episodes: DataFrame, dropped: DataFrame) -> DataFrame:
    return episodes.join(dropped.select(EPISODE).distinct(), EPISODE, "left_anti")


