"""Packing episodes into files and batches, ranges and shards (K1-K6)."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.dataset import CHUNK_FILES
from trajspark.functions.columns import block_of, c
from trajspark.operators.layout import EPISODE, block_rows, positions, running, set_checkpoint_dir

MB = 1024 * 1024
#: Stands for "after the last item".
FAR = 1 << 62


def _steps(to: np.ndarray):
    """Pointer doubling over local pointers ``to`` (len(to) is the way out): yields the pointers after 1, 2, 4, … steps."""
    out = len(to)
    jump = np.append(to, out)
    while True:
        yield jump
        if (jump == out).all():
            return
        jump = jump[jump]


def _leave(to: np.ndarray, beyond: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per item, where the chain of ``to`` first leads out of the block (from ``beyond``), and its items up to there."""
    last, hops = np.append(np.arange(len(to)), -1), np.append(np.ones(len(to), np.int64), 0)
    for jump in _steps(to):
        last = np.where(jump == len(to), last, last[jump])
        hops = hops + hops[jump]
    return beyond[last[:-1]], hops[:-1]


def _chain(to: np.ndarray, start: int) -> np.ndarray:
    """Marks of the items that the chain of ``to`` visits from ``start``."""
    marks = np.zeros(len(to) + 1, bool)
    marks[start] = True
    for jump in _steps(to):
        marks[jump[np.flatnonzero(marks)]] = True
    return marks[:-1]


def _local(pdf: pd.DataFrame, order: str) -> tuple[np.ndarray, np.ndarray]:
    """Pointers of a sorted block as local places, len(block) beyond it, and as they are."""
    at, beyond = pdf[order].to_numpy(np.int64), pdf["_next"].to_numpy(np.int64)
    return np.minimum(beyond - at[0], len(at)), beyond


def _block_pairs(blocks: DataFrame, cap: int, keys: Sequence[str]) -> DataFrame:
    """For each block ``_q``, the blocks ``_b`` in which the sums its items wait for (own start + cap) may be passed.

    Both run upwards, so all blocks together have at most three such pairs per block. One row per block is scanned.
    """
    spread = [
        F.struct(F.col("_hi").alias("v"), F.lit(0).alias("kind"), F.col("_block").alias("b")),
        F.struct(F.col("_lo").alias("v"), F.lit(1).alias("kind"), F.col("_block").alias("b")),
        F.struct((F.col("_lo") + cap).alias("v"), F.lit(2).alias("kind"), F.col("_block").alias("b")),
        F.struct((F.col("_hi") + cap).alias("v"), F.lit(3).alias("kind"), F.col("_block").alias("b")),
    ]
    key_cols = [c(k) for k in keys]
    marks = blocks.select(*key_cols, F.explode(F.array(*spread)).alias("m")).select(*key_cols, "m.*")
    window = Window.partitionBy(*key_cols).orderBy("v", "kind", "b")
    found = marks.withColumns(
        {
            "first": F.first(F.when(F.col("kind") == 0, F.col("b")), ignorenulls=True).over(window.rowsBetween(1, Window.unboundedFollowing)),
            "last": F.last(F.when(F.col("kind") == 1, F.col("b")), ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0)),
        }
    )
    ranges = found.groupBy(*key_cols, F.col("b").alias("_q")).agg(
        F.max(F.when(F.col("kind") == 2, F.col("first"))).alias("first"), F.max(F.when(F.col("kind") == 3, F.col("last"))).alias("last")
    )
    ranges = ranges.filter("first <= last")
    return ranges.select(*key_cols, "_q", F.explode(F.sequence("first", "last")).alias("_b"))


def _next_starts(table: DataFrame, order: str, caps: Sequence[int], keys: Sequence[str]) -> DataFrame:
    """Add ``_next``: the first item after each that no longer fits in a group opened at it, FAR where all fit.

    Blocks meet only the blocks in which their items' sums run full, so a task gets two blocks whatever the weights are.
    """
    key_cols = [c(k) for k in keys]
    out = T.StructType([*(table.schema[k] for k in keys), T.StructField(order, T.LongType()), T.StructField("_next", T.LongType())])

    def finder(cap: int):
        def find(asked: pd.DataFrame, items: pd.DataFrame) -> pd.DataFrame:
            items = items.sort_values("_at")
            sums = items["_sum"].to_numpy(np.int64)
            wait = asked["_from"].to_numpy(np.int64) + cap
            here = (wait >= items["_from"].iloc[0] if len(items) else wait < wait) & (wait < (sums[-1] if len(sums) else 0))
            found = asked[here]
            to = items["_at"].to_numpy(np.int64)[np.searchsorted(sums, wait[here], side="right")] if len(items) else np.empty(0, np.int64)
            rows = found[list(keys)].copy()
            rows[order] = found["_at"].astype(np.int64)
            rows["_next"] = np.maximum(to, found["_at"].to_numpy(np.int64) + 1)
            return rows

        return find

    parts = []
    for k, cap in enumerate(caps):
        rows = table.select(*key_cols, "_block", c(order).alias("_at"), (F.col(f"_p{k}") - F.col(f"_w{k}")).alias("_from"), F.col(f"_p{k}").alias("_sum"))
        blocks = rows.groupBy(*key_cols, "_block").agg(F.min("_from").alias("_lo"), F.max("_sum").alias("_hi"))
        pairs = _block_pairs(blocks, cap, keys)
        group = [*keys, "_q", "_b"]
        asked = rows.drop("_sum").withColumnRenamed("_block", "_q").join(pairs, [*keys, "_q"])
        items = rows.withColumnRenamed("_block", "_b").join(pairs, [*keys, "_b"])
        # Both sides come from one table: new names keep their columns apart.
        left, right = (side.select(*[c(n).alias(n) for n in side.columns]) for side in (asked, items))
        parts.append(left.groupBy(*map(c, group)).cogroup(right.groupBy(*map(c, group))).applyInPandas(finder(cap), out))
    found = reduce(DataFrame.unionByName, parts)
    if len(parts) > 1:
        found = found.groupBy(*key_cols, c(order)).agg(F.min("_next").alias("_next"))
    return table.join(found, [*keys, order], "left").withColumn("_next", F.coalesce("_next", F.lit(FAR)))


def _reached(pointers: DataFrame, rounds: int, keys: Sequence[str]) -> DataFrame:
    """All items on the chain of ``pointers`` (keys, _at, _to) from item 0, by doubling: each round joins pointers to themselves."""
    marked = pointers.filter("_at = 0").select(*map(c, keys), "_at")
    for _ in range(rounds):
        ahead = marked.join(pointers, [*keys, "_at"]).select(*map(c, keys), F.col("_to").alias("_at")).filter(F.col("_at") < FAR)
        marked = marked.union(ahead).distinct().checkpoint()
        then = pointers.select(*map(c, keys), F.col("_at").alias("_to"), F.col("_to").alias("_then"))
        pointers = pointers.join(then, [*keys, "_to"], "left").select(*map(c, keys), "_at", F.coalesce("_then", F.lit(FAR)).alias("_to")).checkpoint()
    return marked


def pack_groups(df: DataFrame, order: str, caps: Mapping[str, int], out: str = "group_no", keys: Sequence[str] = ()) -> DataFrame:
    """Greedy packing in order: a new group opens when an item would push any integer weight above its cap.

    The groups are a linked list: an item points to the first one that no longer fits in a group opened at it. Pointers come
    from running sums, which blocks of items look up in each other; within a block they are followed at once, so a block
    has one pointer per item that leads out of it. The blocks' first starts are the items that such pointers reach from item
    0; they are marked by pointer doubling, in as many rounds as the number of blocks has binary digits. From its first start
    a block marks the others and numbers them. No task gets more than two blocks, however many items a group holds; only
    scans of one row per block are not spread. ``order`` must be dense per ``keys``; weights must not be negative.
    """
    size = block_rows(df)
    set_checkpoint_dir(df)
    key_cols, weights = [c(k) for k in keys], {f"_w{i}": c(w).cast("long") for i, w in enumerate(caps)}
    slim = df.select(*key_cols, c(order).cast("long").alias(order), *[w.alias(n) for n, w in weights.items()])
    summed = running(slim, {f"_p{i}": ("sum", c(f"_w{i}")) for i in range(len(caps))}, keys=keys, order=order)
    table = summed.withColumn("_block", block_of(c(order), size)).checkpoint()
    table = _next_starts(table, order, [int(x) for x in caps.values()], keys).select(*key_cols, "_block", c(order), "_next").checkpoint()

    at = T.StructField("_at", T.LongType())
    key_fields = [table.schema[k] for k in keys]

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        to, beyond = _local(pdf, order)
        leave, hops = _leave(to, beyond)
        return pdf[[*keys, "_block"]].assign(_at=pdf[order], _to=leave, _hops=hops)

    longs = [T.StructField(n, T.LongType()) for n in ("_block", "_at", "_to", "_hops")]
    solved = table.groupBy(*key_cols, "_block").applyInPandas(solve, T.StructType([*key_fields, *longs])).checkpoint()
    blocks = table.agg(F.max("_block")).first()[0] or 0
    firsts = solved.filter("_at = 0")
    if blocks:
        goals = solved.select(*key_cols, F.col("_to").alias("_at")).filter(F.col("_at") < FAR).union(firsts.select(*key_cols, "_at")).distinct()
        pointers = solved.join(goals, [*keys, "_at"], "left_semi").select(*key_cols, "_at", "_to").checkpoint()
        firsts = _reached(pointers, int(blocks).bit_length(), keys).join(solved, [*keys, "_at"])
    opened = table.select(*key_cols, "_block").distinct().join(firsts.select(*key_cols, "_block", "_at", "_hops"), [*keys, "_block"], "left")
    before = Window.partitionBy(*key_cols).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    opened = opened.withColumn("_opened", F.coalesce(F.sum("_hops").over(before), F.lit(0)))
    opened = opened.select(*key_cols, "_block", F.coalesce("_at", F.lit(-1)).alias("_first"), "_opened")

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        to, _ = _local(pdf, order)
        start = int(pdf["_first"].iloc[0])
        marks = _chain(to, start - int(pdf[order].iloc[0])) if start >= 0 else np.zeros(len(pdf), bool)
        return pdf[[*keys, order]].assign(**{out: pdf["_opened"].to_numpy(np.int64) - 1 + np.cumsum(marks)})

    numbered_schema = T.StructType([*key_fields, T.StructField(order, T.LongType()), T.StructField(out, T.LongType())])
    numbered = table.join(opened, [*keys, "_block"]).groupBy(*key_cols, "_block").applyInPandas(number, numbered_schema)
    return df.join(numbered, [*keys, order])


def pack_files(
    episodes: DataFrame,
    size_bytes: str,
    max_mb: float,
    chunk_files: int = CHUNK_FILES,
    order: str = EPISODE,
    names: tuple[str, str] = ("data/chunk_index", "data/file_index"),
) -> DataFrame:
    """Chunk and file number per episode: a file is closed before the episode that would bring it to ``max_mb`` or more."""
    packed = pack_groups(episodes, order, {size_bytes: math.ceil(max_mb * MB) - 1}, "_file")
    return packed.withColumns(
        {names[0]: F.floor(F.col("_file") / chunk_files), names[1]: F.col("_file") % chunk_files}
    ).drop("_file")


def pack_videos(episodes: DataFrame, key: str, duration: str, size_bytes: str, max_mb: float, chunk_files: int = CHUNK_FILES) -> DataFrame:
    """``pack_files`` for one camera, with the time range of each episode inside its file."""
    names = (f"videos/{key}/chunk_index", f"videos/{key}/file_index")
    packed = pack_files(episodes, size_bytes, max_mb, chunk_files, names=names)
    # Running time per file = running time over all episodes minus its value where the file starts.
    packed = running(packed, {"_until": ("sum", c(duration))}, keys=(), order=EPISODE)
    packed = packed.withColumn("_from", F.col("_until") - c(duration))
    starts = packed.groupBy(c(names[0]), c(names[1])).agg(F.min("_from").alias("_start"))
    joined = packed.join(starts, list(names))
    return joined.withColumns(
        {f"videos/{key}/from_timestamp": F.col("_from") - F.col("_start"), f"videos/{key}/to_timestamp": F.col("_until") - F.col("_start")}
    ).drop("_from", "_until", "_start")


def episode_batches(
    episodes: DataFrame,
    mb_per_frame: float,
    max_mb: float,
    max_episodes: int | None = None,
    max_frames: int | None = None,
    order: str = EPISODE,
) -> DataFrame:
    """Batch number per episode under an estimated size (closed at >=), an episode count and a frame count (closed at >)."""
    frames_at_limit = math.ceil(max_mb / mb_per_frame)
    while (frames_at_limit - 1) * mb_per_frame >= max_mb:
        frames_at_limit -= 1
    caps = {"length": min(frames_at_limit - 1, max_frames if max_frames is not None else frames_at_limit - 1)}
    df = episodes
    if max_episodes is not None:
        df, caps = df.withColumn("_one", F.lit(1).cast("long")), {**caps, "_one": max_episodes}
    return pack_groups(df, order, caps, "batch").drop("_one")


def range_boundaries(df: DataFrame, key: str, n: int, interval: int) -> list:
    """Boundary keys for ``n`` workers from every ``interval``-th key in order; the last one gets U+FFFF appended.

    ``positions`` ranks the keys without a single-task sort; only the chosen boundaries reach the driver.
    """
    ranked = positions(df.select(c(key)).filter(c(key).isNotNull()), "_at", [key])
    marks = ranked.filter(F.col("_at") % interval == 0).withColumn("_m", (F.col("_at") / interval).cast("long"))
    total = marks.count()
    if total == 0:
        return []
    if total <= n + 1:
        wanted = list(range(total))
    else:
        wanted = [0] + [int((i + 1) * (total - 1) / n) for i in range(n - 1)] + [total - 1]
    found = {r["_m"]: r[key] for r in marks.filter(F.col("_m").isin(wanted)).collect()}
    picked = [found[w] for w in wanted]
    picked[-1] = picked[-1] + "\uffff"
    return picked


def shard(df: DataFrame, key: str, world: int, rank: int) -> DataFrame:
    """Round robin over a dense id: ``ids[rank::world]``."""
    return df.filter(F.pmod(c(key), F.lit(world)) == rank)


def path_range(df: DataFrame, key: str, gte: str | None = None, lt: str | None = None) -> DataFrame:
    """Half-open key range."""
    out = df if gte is None else df.filter(c(key) >= gte)
    return out if lt is None else out.filter(c(key) < lt)


def top_rows(df: DataFrame, order: Sequence[str], n: int) -> DataFrame:
    """The first ``n`` rows; Spark keeps ``n`` per task before merging."""
    if n <= 0:
        raise ValueError("n must be positive")
    return df.orderBy(*[c(o) for o in order]).limit(n)
