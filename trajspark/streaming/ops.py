"""Streaming twins of the window, filter, statistics and writing operators.

State is kept per (episode, block) where the operator only looks around a bounded number of rows, so one very long
episode does not end in one task. Rows may arrive in any order inside the look-around. There is no event-time rule in the
semantics themselves; where an episode never announces its end, a processing-time timeout closes it.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from trajspark.functions.columns import c
from trajspark.operators.layout import EPISODE, FRAME, block_rows, with_halo
from trajspark.operators.similar import keep_flags
from trajspark.operators.stats import (
    BINS,
    EDGE,
    array_features,
    bin_counts,
    bin_of,
    flat_vector,
    name_slots,
    numeric_slots,
    stats_from_bins,
)
from trajspark.operators.windows import AGGREGATES, STREAM_LOOK_AROUND, delta_offsets
from trajspark.operators.windows import time_limit as stream_time_limit  # noqa: F401 - stateless, works on streams

STATE = T.StructType([T.StructField("blob", T.BinaryType())])


def stream_source(spark: SparkSession, path: str, schema: T.StructType, files_per_trigger: int = 1) -> DataFrame:
    """Frame shards in file order, a bounded number per micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def _load(state: GroupState, fresh):
    return pickle.loads(state.get[0]) if state.exists else fresh


def _save(state: GroupState, value) -> None:
    state.update((pickle.dumps(value),))


# ---------------------------------------------------------------- T1, T2


def _window_of(rows: Mapping[int, object], frame: int, last: int | None, offsets: Sequence[int], pad: str):
    """Values and pad flags of one frame from the rows at hand."""
    values, flags = [], []
    for o in offsets:
        missing = frame + o < 0 or (last is not None and frame + o > last)
        if pad == "edge":
            at = max(0, frame + o) if last is None else min(last, max(0, frame + o))
        else:
            missing = missing or abs(o) > STREAM_LOOK_AROUND
            inward = [x for x in offsets if x * o > 0 and abs(x) <= min(abs(o), STREAM_LOOK_AROUND)]
            real = [x for x in inward if 0 <= frame + x and (last is None or frame + x <= last)]
            at = frame + (max(real, key=abs) if real else 0)
        values.append(rows[at])
        flags.append(missing)
    return values, flags


def stream_delta_window(
    stream: DataFrame,
    key: str,
    deltas: Sequence[float],
    fps: float,
    end: str = "is_last",
    pad: str = "edge",
    tol: float = 1e-4,
    timeout_ms: int | None = None,
) -> DataFrame:
    """``delta_window`` of one key on a stream: a frame is emitted as soon as all rows of its window are known.

    ``end`` marks the last row of an episode. Each block keeps the rows still needed by frames not yet emitted. With
    ``timeout_ms`` an episode without news for that long ends at its newest row.
    """
    offsets = delta_offsets({key: deltas}, fps, tol)[key]
    reach = [o for o in offsets if pad == "edge" or abs(o) <= STREAM_LOOK_AROUND]
    before, after = max([-o for o in reach] + [0]), max([o for o in reach] + [0])
    size = block_rows(stream, max(before, after, 1))
    slim = stream.select(EPISODE, FRAME, c(key).alias("_v"), c(end).alias("_end"))
    wide, _, _ = with_halo(slim, before, after)
    kind = stream.schema[key].dataType
    schema = T.StructType(
        [
            T.StructField(EPISODE, T.LongType()),
            T.StructField(FRAME, T.LongType()),
            T.StructField("values", T.ArrayType(kind)),
            T.StructField("is_pad", T.ArrayType(T.BooleanType())),
        ]
    )

    def step(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        episode, block = group
        rows, last, todo = _load(state, ({}, None, block * size))
        for pdf in parts:
            for f, v, e in zip(pdf[FRAME], pdf["_v"], pdf["_end"]):
                rows[int(f)] = v.tolist() if isinstance(v, np.ndarray) else v
                if e:
                    last = int(f)
        if state.hasTimedOut and rows and last is None:
            last = max(rows)
        out, stop = [], (block + 1) * size
        while todo < stop and todo in rows and (last is None or todo <= last):
            low, high = max(0, todo - before), todo + after if last is None else min(last, todo + after)
            if any(i not in rows for i in range(low, high + 1)):
                break
            out.append((episode, todo, *_window_of(rows, todo, last, offsets, pad)))
            todo += 1
        if todo >= stop or (last is not None and todo > last):
            state.remove()
        else:
            _save(state, ({f: v for f, v in rows.items() if f >= todo - before}, last, todo))
            if timeout_ms is not None:
                state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame(out, columns=schema.names)

    timeout = GroupStateTimeout.ProcessingTimeTimeout if timeout_ms is not None else GroupStateTimeout.NoTimeout
    grouped = wide.groupBy(EPISODE, "_block")
    return grouped.applyInPandasWithState(step, schema, STATE, "append", timeout)


def stream_velocity(stream: DataFrame, state: str, dt: float, end: str = "is_last") -> DataFrame:
    """Finite difference on a stream: a window of the previous and the current row, then plain columns."""
    pairs = stream_delta_window(stream, state, [-1.0, 0.0], 1, end)
    now, prev = F.col("values")[1], F.col("values")[0]
    v = F.zip_with(now, prev, lambda x, p: (x - p) / F.lit(dt))
    return pairs.select(EPISODE, FRAME, now.alias(state), v.alias("velocity"))


# ---------------------------------------------------------------- T3, T4


def stream_similar_filter(
    stream: DataFrame,
    vector: str,
    atol: float,
    must_go: str | None = None,
    step: str = FRAME,
    end: str | None = None,
    horizon: int | None = None,
    timeout_ms: int | None = None,
) -> DataFrame:
    """Drop observations closer than ``atol`` to the last kept one of their episode, or of a step kept before.

    The rule is a chain, so an episode's rows of one micro-batch are handled in order by one task; the trigger bounds them.
    The state holds the kept steps. It is removed after a row with ``end`` set, or ``timeout_ms`` after the last row; with
    ``horizon`` steps more than that below the newest kept one are forgotten, and the state is bounded.
    """
    slim = stream.select(
        EPISODE,
        FRAME,
        c(vector).cast("array<double>").alias("_v"),
        (c(must_go) if must_go else F.lit(False)).alias("_m"),
        c(step).cast("long").alias("_s"),
        (F.coalesce(c(end), F.lit(False)) if end else F.lit(False)).alias("_end"),
    )
    schema = T.StructType([T.StructField(EPISODE, T.LongType()), T.StructField(FRAME, T.LongType())])

    def run(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        last, handled = _load(state, (None, set()))
        pdf = pd.concat(list(parts)).sort_values(FRAME)
        kept, last = keep_flags(np.stack(pdf["_v"].to_numpy()), pdf["_s"].to_numpy(), pdf["_m"].to_numpy(), last, handled, atol)
        if pdf["_end"].any():
            state.remove()
        else:
            if horizon is not None:
                newest = max(handled)
                handled = {s for s in handled if s >= newest - horizon}
            _save(state, (last, handled))
            if timeout_ms is not None:
                state.setTimeoutDuration(timeout_ms)
        yield pd.DataFrame({EPISODE: group[0], FRAME: pdf[FRAME].to_numpy()[kept]})

    timeout = GroupStateTimeout.NoTimeout if timeout_ms is None else GroupStateTimeout.ProcessingTimeTimeout
    return slim.groupBy(EPISODE).applyInPandasWithState(run, schema, STATE, "append", timeout)


def stream_merge_chunks(stream: DataFrame, fn: str = "weighted_average", latest: str = "latest") -> DataFrame:
    """Queue after every chunk arrival: ``episode_index, arrival, timestep, action``.

    Timesteps at or before the latest executed one are dropped, which is the only rule for late data; the last row per
    timestep equals the batch operator.
    """
    old, new = AGGREGATES[fn]
    slim = stream.select(EPISODE, "arrival", "timestep", c(latest).alias("_latest"), c("action").cast("array<double>").alias("action"))
    schema = T.StructType(
        [
            T.StructField(EPISODE, T.LongType()),
            T.StructField("arrival", T.LongType()),
            T.StructField("timestep", T.LongType()),
            T.StructField("action", T.ArrayType(T.DoubleType())),
        ]
    )

    def step(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        queue, newest, part = _load(state, ({}, None, {}))
        out = []
        for arrival, chunk in pd.concat(list(parts)).sort_values(["arrival", "timestep"]).groupby("arrival"):
            if newest is not None and arrival != newest:
                # A missing arrival means a chunk whose actions were all late: its queue is empty.
                queue, part = (part if arrival == newest + 1 else {}), {}
            newest = arrival
            for t, gone, action in zip(chunk["timestep"], chunk["_latest"], chunk["action"]):
                if t > gone:
                    a = np.asarray(action, float)
                    part[t] = queue[t] * old + a * new if t in queue else a
                    out.append((group[0], arrival, t, part[t].tolist()))
        _save(state, (queue, newest, part))
        yield pd.DataFrame(out, columns=schema.names)

    return slim.groupBy(EPISODE).applyInPandasWithState(step, schema, STATE, "append", GroupStateTimeout.NoTimeout)


# ---------------------------------------------------------------- T5


def stream_episode_writer(
    stream: DataFrame, root: str, key: str, order: Sequence[str], end: str, checkpoint: str, **trigger
) -> StreamingQuery:
    """Append episodes to a written dataset once their end has arrived.

    Every micro-batch is staged under its number, then the complete episodes not yet in the dataset are appended. Source
    keys are kept in the episode table, so a batch that runs twice appends nothing twice.
    """
    from trajspark.sources.dataset_io import append_dataset, read_episodes

    staging = f"{root}/_staging"

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{staging}/batch={number}")
        staged = spark.read.parquet(staging).drop("batch")
        complete = staged.groupBy(c(key)).agg(F.max(c(end)).alias("_done")).filter("_done").select(c(key))
        table = read_episodes(spark, root)
        if "source_key" in table.columns:
            done = table.filter(F.col("source_key").isNotNull()).select(F.col("source_key").alias(key))
            complete = complete.join(done, key, "left_anti")
        if complete.isEmpty():
            return
        rows = staged.join(complete, key, "left_semi")
        append_dataset(spark, root, rows, key, order, key_column="source_key")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(**trigger).start()


# ---------------------------------------------------------------- T6


def merge_bins(old: DataFrame, values: DataFrame) -> DataFrame:
    """Add ``(slot, value)`` rows to bins ``(slot, bin, n, s1, s2, lo, hi)``.

    When a range grows, an old bin moves to the new bin its centre falls in, and its sums are taken to the new low end.
    """
    seen = values.groupBy("slot").agg(F.min("value").alias("lo"), F.max("value").alias("hi"))
    ranges = seen.unionByName(old.select("slot", "lo", "hi").distinct()).groupBy("slot").agg(F.min("lo").alias("_lo"), F.max("hi").alias("_hi"))
    added = bin_counts(values.join(ranges.select("slot", F.col("_lo").alias("lo"), F.col("_hi").alias("hi")), "slot"), ["slot"])
    moved = old.join(ranges, "slot")
    width = (F.col("hi") - F.col("lo") + 2 * EDGE) / BINS
    centre = F.col("lo") - EDGE + (F.col("bin") + 0.5) * width
    off = F.col("lo") - F.col("_lo")
    grown = (F.col("_lo") != F.col("lo")) | (F.col("_hi") != F.col("hi"))
    kept = moved.select(
        "slot",
        F.when(grown, bin_of(centre, F.col("_lo"), F.col("_hi"))).otherwise(F.col("bin")).alias("bin"),
        "n",
        (F.col("s1") + F.col("n") * off).alias("s1"),
        (F.col("s2") + 2 * off * F.col("s1") + F.col("n") * off * off).alias("s2"),
        F.col("_lo").alias("lo"),
        F.col("_hi").alias("hi"),
    )
    return kept.unionByName(added).groupBy("slot", "bin").agg(
        *[F.sum(x).alias(x) for x in ("n", "s1", "s2")], F.min("lo").alias("lo"), F.max("hi").alias("hi")
    )


def stream_running_stats(stream: DataFrame, features: Mapping[str, Mapping], state_dir: str, checkpoint: str, **trigger) -> StreamingQuery:
    """Running statistics with range growth: one table of bins per micro-batch, built from the previous one.

    Each batch is reduced to bins on the map side before anything is merged. ``running_stats`` reads the newest table.
    """
    features = array_features(stream, features)

    def update(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        values = batch.select(F.posexplode(flat_vector(features)).alias("slot", "value"))
        kind = "slot int, bin int, n bigint, s1 double, s2 double, lo double, hi double"
        old = spark.read.schema(kind).parquet(f"{state_dir}/bins-{number - 1}") if number > 0 else spark.createDataFrame([], kind)
        merge_bins(old, values).write.mode("overwrite").parquet(f"{state_dir}/bins-{number}")

    return stream.writeStream.foreachBatch(update).option("checkpointLocation", checkpoint).trigger(**trigger).start()


def running_stats(spark: SparkSession, state_dir: str, number: int, features: Mapping[str, Mapping]) -> DataFrame:
    """Statistics after micro-batch ``number``; fewer than two rows raise."""
    stats = stats_from_bins(spark.read.parquet(f"{state_dir}/bins-{number}"), ["slot"])
    if not stats.filter(F.col("count") < 2).isEmpty():
        raise ValueError("running statistics need at least two rows")
    return name_slots(stats, numeric_slots(features))


# ---------------------------------------------------------------- T7


def stream_rollout_returns(stream: DataFrame) -> DataFrame:
    """Sum and maximum of reward and any success per episode up to its first done, updated every micro-batch."""
    schema = T.StructType(
        [
            T.StructField(EPISODE, T.LongType()),
            T.StructField("sum_reward", T.DoubleType()),
            T.StructField("max_reward", T.DoubleType()),
            T.StructField("success", T.BooleanType()),
        ]
    )

    def step(group: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        total, top, won, done = _load(state, (0.0, -np.inf, False, False))
        pdf = pd.concat(list(parts)).sort_values("step")
        if not done:
            ends = np.flatnonzero(pdf["done"].to_numpy())
            live = pdf.iloc[: ends[0] + 1] if len(ends) else pdf
            total, top = total + float(live["reward"].sum()), max(top, float(live["reward"].max()))
            won, done = won or bool(live["success"].any()), len(ends) > 0
        _save(state, (total, top, won, done))
        yield pd.DataFrame([(group[0], total, top, won)], columns=schema.names)

    slim = stream.select(EPISODE, "step", "reward", "done", "success")
    return slim.groupBy(EPISODE).applyInPandasWithState(step, schema, STATE, "update", GroupStateTimeout.NoTimeout)


def stream_fps(stream: DataFrame, keys: Sequence[str], ts: str, window: str, lateness: str) -> DataFrame:
    """Observed rate per key and event-time window; the watermark is ours, so the delay is an argument.

    In append mode the newest windows never close at the end of input; update mode gives them too, the last row counts.
    """
    windowed = stream.withWatermark(ts, lateness).groupBy(F.window(c(ts), window), *[c(k) for k in keys])
    span = F.max(F.unix_micros(c(ts))) - F.min(F.unix_micros(c(ts)))
    out = windowed.agg(F.count(F.lit(1)).alias("n"), (span / 1e6).alias("_span"))
    rate = F.when(F.col("_span") > 1e-6, (F.col("n") - 1) / F.col("_span")).otherwise(F.lit(0.0))
    return out.select(F.col("window.start").alias("window_start"), *[c(k) for k in keys], "n", rate.alias("avg_fps"))


# ---------------------------------------------------------------- T8


def bounded_queue(log: DataFrame, capacity: int, keys: Sequence[str], order: str, arrives: str) -> DataFrame:
    """Queue depth after every event of a log, and whether the event pushed an item out.

    An arrival adds one up to ``capacity``, a departure takes one down to zero. Both are clamped shifts, and clamped shifts
    compose to clamped shifts, so each block of events is first reduced to one (shift, low, high), the few results are
    chained per key, and the blocks are then filled in from their known depth. A key of one block starts at 0 and is
    filled in at once. ``order`` is dense per key; rows with a null key are left out.
    """
    size, by = block_rows(log), [*keys, "_block"]
    slim = log.select(*[c(k) for k in keys], F.floor(c(order) / size).alias("_block"), c(order), c(arrives))
    slim = slim.dropna(subset=by)
    fields, long = [log.schema[k] for k in keys], T.LongType()

    def firsts(pdf: pd.DataFrame, names: Sequence[str], before: tuple | None) -> tuple[list[bool], tuple]:
        """Flags of the rows that open a group of sorted rows, and the last group; a batch may go on with the one before."""
        groups = list(zip(*(pdf[n] for n in names)))
        return [g != b for g, b in zip(groups, [before, *groups])], groups[-1]

    def reduce(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, shift, low, high = None, 0, 0, capacity
        for pdf in parts:
            if pdf.empty:
                continue
            out, before = [], now
            opens, now = firsts(pdf, by, before)
            for group, new, up in zip(zip(*(pdf[n] for n in by)), opens, pdf[arrives].tolist()):
                if new:
                    if before is not None:
                        out.append((*before, shift, low, high))
                    before, shift, low, high = group, 0, 0, capacity
                d = 1 if up else -1
                shift, low, high = shift + d, min(capacity, max(0, low + d)), min(capacity, max(0, high + d))
            yield pd.DataFrame(out, columns=summary.names)
        if now is not None:
            yield pd.DataFrame([(*now, shift, low, high)], columns=summary.names)

    def chain(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, depth = None, 0
        for pdf in parts:
            if pdf.empty:
                continue
            opens, now = firsts(pdf, keys, now)
            out = []
            for new, s, low, high in zip(opens, pdf["_s"].tolist(), pdf["_lo"].tolist(), pdf["_hi"].tolist()):
                depth = 0 if new else depth
                out.append(depth)
                depth = min(high, max(low, depth + s))
            yield pdf.assign(_from=out)[starts.names]

    def fill(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, depth = None, 0
        for pdf in parts:
            if pdf.empty:
                continue
            opens, now = firsts(pdf, by, now)
            depths, drops = [], []
            for new, start, up in zip(opens, pdf["_from"].tolist(), pdf[arrives].tolist()):
                depth = start if new else depth
                drops.append(bool(up) and depth == capacity)
                depth = min(capacity, depth + 1) if up else max(0, depth - 1)
                depths.append(depth)
            yield pdf.assign(depth=depths, dropped=drops)[result.names]

    summary = T.StructType([*fields, *[T.StructField(n, long) for n in ("_block", "_s", "_lo", "_hi")]])
    starts = T.StructType([*fields, T.StructField("_block", long), T.StructField("_from", long)])
    result = T.StructType([*fields, log.schema[order], T.StructField("depth", long), T.StructField("dropped", T.BooleanType())])
    # Groups may be many and small: a task sorts its rows and walks through them, without a call per group.
    several = slim.filter(F.col("_block") > 0).select(*[c(k) for k in keys]).distinct()
    blocks = slim.join(several, list(keys), "left_semi").repartition(*[c(n) for n in by]).sortWithinPartitions(*[c(n) for n in by], c(order))
    reduced = blocks.mapInPandas(reduce, summary).repartition(*[c(k) for k in keys]).sortWithinPartitions(*[c(n) for n in by])
    chained = reduced.mapInPandas(chain, starts)
    ready = slim.join(chained, by, "left").withColumn("_from", F.coalesce("_from", F.lit(0).cast("long")))
    return ready.repartition(*[c(n) for n in by]).sortWithinPartitions(*[c(n) for n in by], c(order)).mapInPandas(fill, result)
