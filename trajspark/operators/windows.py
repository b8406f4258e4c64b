"""Windowed reads and analytic windows over the frames of an episode."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from trajspark.functions.columns import block_of, c, doubles, hash_uniform, norm, vsub
from trajspark.operators.layout import (
    EPISODE,
    FRAME,
    block_rows,
    drop_halo,
    join_episodes,
    look_around,
    running,
    with_halo,
)

STREAM_LOOK_AROUND = 100  # fixed value: rows the streaming reader can look back or ahead
MANY_OFFSETS = 64


# ---------------------------------------------------------------- delta windows


def bad_deltas(deltas: Mapping[str, Sequence[float]], fps: float, tol: float = 1e-4) -> dict[str, list[float]]:
    """Deltas that are not a multiple of 1/fps within ``tol`` seconds."""
    bad = {k: [d for d in ds if abs(d * fps - round(d * fps)) / fps > tol] for k, ds in deltas.items()}
    return {k: v for k, v in bad.items() if v}


def delta_offsets(deltas: Mapping[str, Sequence[float]], fps: float, tol: float = 1e-4) -> dict[str, list[int]]:
    """Seconds to row offsets, rounding half to even; raises with the list of offenders."""
    bad = bad_deltas(deltas, fps, tol)
    if bad:
        raise ValueError(f"deltas that are not a multiple of 1/{fps} s: {bad}")
    return {k: [round(d * fps) for d in ds] for k, ds in deltas.items()}


def deltas_from_indices(
    names: Sequence[str], fps: float, reward: Sequence[int] | None, action: Sequence[int] | None, observation: Sequence[int] | None
) -> dict[str, list[float]]:
    """Deltas in seconds from per-class index lists."""
    out = {}
    for name in names:
        picked = reward if name == "next.reward" else action if name == "action" else None
        if picked is None and name.startswith("observation."):
            picked = observation
        if picked is not None:
            out[name] = [i / fps for i in picked]
    return out


def delta_window(
    frames: DataFrame,
    deltas: Mapping[str, Sequence[float]],
    fps: float,
    tol: float = 1e-4,
    pad: str = "edge",
    method: str = "auto",
) -> DataFrame:
    """Replace each key by the array of its values at ``frame + round(delta * fps)`` and add ``{key}_is_pad``.

    ``pad='edge'`` clamps to the first / last frame of the episode. ``pad='nearest_requested'`` repeats the value of the
    farthest requested offset that still exists in that direction (the current frame if none does) and looks at most
    100 rows away. Up to 64 distinct offsets of moderate reach are read with ``lag`` / ``lead`` inside halo blocks: one
    shuffle of the frames. Beyond that the offsets are exploded and joined on ``(episode, frame)``.
    """
    offsets = delta_offsets(deltas, fps, tol)
    distinct = sorted({o for os in offsets.values() for o in os})
    if pad not in ("edge", "nearest_requested"):
        raise ValueError(f"unknown pad mode {pad!r}")
    if pad == "nearest_requested":
        return _window_nearest(frames, offsets)
    reach = max((abs(o) for o in distinct), default=0)
    if method == "auto":
        method = "join" if len(distinct) > MANY_OFFSETS or 4 * reach > max(block_rows(frames), 4 * MANY_OFFSETS) else "halo"
    return _window_join(frames, offsets) if method == "join" else _window_halo(frames, offsets)


def _shift(value: Column, by: int, window) -> Column:
    wrapped = F.struct(value.alias("v"))
    return wrapped if by == 0 else (F.lag(wrapped, -by) if by < 0 else F.lead(wrapped, by)).over(window)


def _window_halo(frames: DataFrame, offsets: Mapping[str, Sequence[int]]) -> DataFrame:
    every = [o for os in offsets.values() for o in os]
    wide, window, keep = with_halo(frames, max([-o for o in every] + [0]), max([o for o in every] + [0]))
    whole = window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    scratch, results = {}, {}
    for n, (key, os) in enumerate(offsets.items()):
        # A row whose look-back leaves the episode sits in the block that starts with the first frame, so the first row
        # of the block is the clamped one; the same holds for the last frame.
        scratch[f"_first{n}"] = F.first(F.struct(c(key).alias("v"))).over(whole)
        scratch[f"_last{n}"] = F.last(F.struct(c(key).alias("v"))).over(whole)
        for o in sorted(set(os)):
            scratch[f"_at{n}_{o}"] = _shift(c(key), o, window)
        edge = {o: c(f"_first{n}") if o < 0 else c(f"_last{n}") for o in os}
        results[key] = F.array(*[F.coalesce(c(f"_at{n}_{o}"), edge[o])["v"] for o in os])
        results[f"{key}_is_pad"] = F.array(*[c(f"_at{n}_{o}").isNull() for o in os])
    return drop_halo(wide.withColumns(scratch).filter(keep).withColumns(results).drop(*scratch), keep)


def _window_nearest(frames: DataFrame, offsets: Mapping[str, Sequence[int]]) -> DataFrame:
    near = {k: [o for o in os if abs(o) <= STREAM_LOOK_AROUND] for k, os in offsets.items()}
    every = [o for os in near.values() for o in os]
    wide, window, keep = with_halo(frames, max([-o for o in every] + [0]), max([o for o in every] + [0]))
    scratch, results = {}, {}
    for n, (key, os) in enumerate(offsets.items()):
        for o in sorted({*near[key], 0}):
            scratch[f"_at{n}_{o}"] = _shift(c(key), o, window)

        def value(o: int, n: int = n, reach: Sequence[int] = tuple(near[key])) -> Column:
            inward = sorted({x for x in reach if x * o > 0 and abs(x) <= abs(o)}, key=abs, reverse=True)
            return F.coalesce(*[c(f"_at{n}_{x}") for x in inward], c(f"_at{n}_0"))["v"]

        def missing(o: int, n: int = n, reach: Sequence[int] = tuple(near[key])) -> Column:
            return c(f"_at{n}_{o}").isNull() if o in reach else F.lit(True)

        results[key] = F.array(*[value(o) for o in os])
        results[f"{key}_is_pad"] = F.array(*[missing(o) for o in os])
    return drop_halo(wide.withColumns(scratch).filter(keep).withColumns(results).drop(*scratch), keep)


def _window_join(frames: DataFrame, offsets: Mapping[str, Sequence[int]]) -> DataFrame:
    lengths = frames.groupBy(EPISODE).agg((F.max(FRAME) + 1).alias("_length"))
    sized = join_episodes(frames, lengths, length="_length")
    ids = sized.select(EPISODE, FRAME, "_length")
    out = sized.drop("_length")
    for key, os in offsets.items():
        asked = ids.select(EPISODE, FRAME, "_length", F.posexplode(F.array(*[F.lit(o) for o in os])).alias("_pos", "_o"))
        target = F.greatest(F.lit(0), F.least(F.col("_length") - 1, F.col(FRAME) + F.col("_o")))
        asked = asked.select(
            EPISODE, FRAME, "_pos", target.alias("_target"), (target != F.col(FRAME) + F.col("_o")).alias("_pad")
        )
        source = frames.select(EPISODE, F.col(FRAME).alias("_target"), c(key).alias("_value"))
        found = asked.join(source, [EPISODE, "_target"])
        # One group holds exactly one frame's offsets, so its size is the number of offsets.
        packed = found.groupBy(EPISODE, FRAME).agg(
            F.array_sort(F.collect_list(F.struct("_pos", F.struct(F.col("_value").alias("v")).alias("_s"), "_pad"))).alias("_w")
        )
        packed = packed.select(
            EPISODE,
            FRAME,
            F.transform("_w", lambda x: x["_s"]["v"]).alias(key),
            F.transform("_w", lambda x: x["_pad"]).alias(f"{key}_is_pad"),
        )
        out = out.drop(key).join(packed, [EPISODE, FRAME])
    return out


def symmetric_offsets(n_obs: int, gap: int) -> list[int]:
    half = n_obs // 2
    return [gap * i for i in range(-half, half + 1)]


def symmetric_window(frames: DataFrame, n_obs: int, gap: int, length: str = "episode_length") -> DataFrame:
    """Add ``obs_indices`` (clamped frame numbers around each frame) and ``obs_out_of_bounds`` flags."""
    asked = F.transform(F.array(*[F.lit(o).cast("long") for o in symmetric_offsets(n_obs, gap)]), lambda o: c(FRAME) + o)
    clamp = F.transform(asked, lambda i: F.greatest(F.lit(0).cast("long"), F.least(c(length) - 1, i)))
    flags = F.zip_with(asked, clamp, lambda a, b: F.when(a == b, 0).otherwise(1))
    return frames.withColumns({"obs_indices": clamp, "obs_out_of_bounds": flags})


def rewind_indices(
    frames: DataFrame, n_obs: int, max_steps: int, gap: int, step: int | None = None, seed: int = 0
) -> DataFrame:
    """Add ``rewind_step`` and ``rewind_frames``: reversed history before the earliest observed frame.

    Without ``step`` the length is drawn from ``1..max`` by a hash of the global index, so a retry draws the same.
    """
    earliest = c(FRAME) - F.lit((n_obs // 2) * gap)
    possible = F.when(earliest <= 0, 0).otherwise(F.least(F.lit(max_steps), F.floor(earliest / gap)))
    if step is None:
        chosen = 1 + F.floor(hash_uniform(seed, c("index")) * possible)
    else:
        chosen = F.least(F.lit(step), possible)
    chosen = F.when(possible <= 0, 0).otherwise(chosen).cast("int")
    steps = F.when(chosen > 0, F.sequence(F.lit(1), chosen)).otherwise(F.array().cast("array<int>"))
    history = F.transform(steps, lambda i: F.greatest(F.lit(0), earliest - i * gap))
    return frames.withColumns({"rewind_step": chosen, "rewind_frames": history.cast("array<bigint>")})


def history_window(frames: DataFrame, key: str, n: int) -> DataFrame:
    """The last ``n`` values; before ``n`` exist the first one is repeated."""
    return delta_window(frames, {key: [float(k) for k in range(1 - n, 1)]}, fps=1).drop(f"{key}_is_pad")


def action_chunks(
    frames: DataFrame, horizon: int, delta_dims: Sequence[int] | None = None, action: str = "action", state: str = "observation.state"
) -> DataFrame:
    """All windows of exactly ``horizon`` actions inside an episode, one row per start frame.

    With ``delta_dims`` the state at the start of the window is subtracted from those dimensions.
    """
    wide, window, keep = with_halo(frames, 0, horizon - 1)
    rows = window.rowsBetween(0, horizon - 1)
    out = wide.withColumn("chunk", F.collect_list(c(action)).over(rows))
    out = drop_halo(out, keep).filter(F.size("chunk") == horizon)
    if delta_dims:
        dims = F.array(*[F.lit(d) for d in delta_dims])

        def shift(row: Column) -> Column:
            return F.transform(row, lambda x, i: F.when(F.array_contains(dims, i), x - c(state)[i]).otherwise(x))

        out = out.withColumn("chunk", F.transform("chunk", shift))
    return out.select(EPISODE, FRAME, "chunk")


# ---------------------------------------------------------------- samplers and orders


def episode_sampler(
    frames: DataFrame,
    episodes: DataFrame,
    drop_first: int = 0,
    drop_last: int = 0,
    ids: Sequence[int] | None = None,
    shuffle_seed: int | None = None,
) -> DataFrame:
    """Frames left after trimming both ends of every episode; episodes shorter than the trims vanish."""
    if drop_first < 0 or drop_last < 0:
        raise ValueError("drop_first and drop_last must not be negative")
    chosen = episodes.select(EPISODE, F.col("length").alias("_length"))
    if ids is not None:
        chosen = chosen.filter(F.col(EPISODE).isin(list(ids)))
    kept = join_episodes(frames, chosen, length="_length")
    kept = kept.filter((F.col(FRAME) >= drop_first) & (F.col(FRAME) < F.col("_length") - drop_last)).drop("_length")
    if shuffle_seed is not None:
        kept = kept.orderBy(F.xxhash64(F.lit(shuffle_seed), F.col("index")), F.col("index"))
    return kept


def skipped_episodes(episodes: DataFrame, drop_first: int, drop_last: int) -> DataFrame:
    """Episodes the sampler cannot draw from."""
    return episodes.filter(F.col("length") <= drop_first + drop_last).select(EPISODE, "length")


def strided_indices(frames: DataFrame, gap: int, stride: int = 1, length: str = "episode_length") -> DataFrame:
    """Keep every ``stride``-th frame and the last one; ``visit_order`` lists ``0, g, 2g, …, 1, g+1, …`` without a sort."""
    f, n = c(FRAME), c(length)
    kept = frames.filter((f % stride == 0) | (f == n - 1)) if stride > 1 else frames
    r, full, rest = f % gap, F.floor(n / gap), n % gap
    order = r * full + F.least(r, rest) + F.floor(f / gap)
    return kept.withColumn("visit_order", order.cast("long"))


# ---------------------------------------------------------------- neighbours


def next_state(
    frames: DataFrame,
    state_keys: Sequence[str],
    done: str | None = "next.done",
    action: str = "action",
    reward: str = "next.reward",
) -> DataFrame:
    """(s, a, r, s', done, truncated): the next row's state, or the own state when done or at the episode end.

    ``truncated`` equals ``done`` as computed; ``stored_truncated`` is the constant false that loading keeps.
    """
    looks = {f"_next{i}": (F.struct(c(k).alias("v")), 1) for i, k in enumerate(state_keys)}
    wide = look_around(frames, looks)
    is_last = c("_next0").isNull()
    ended = c(done) if done is not None and done in frames.columns else is_last
    extra = [c(n) for n in frames.columns if n.startswith("complementary_info.")]
    nexts = [
        F.when(ended | is_last, c(k)).otherwise(c(f"_next{i}")["v"]).alias(f"next_{k}") for i, k in enumerate(state_keys)
    ]
    return wide.select(
        "index",
        EPISODE,
        FRAME,
        *[c(k) for k in state_keys],
        c(action).alias("action"),
        c(reward).cast("double").alias("reward"),
        *nexts,
        ended.alias("done"),
        ended.alias("truncated"),
        F.lit(False).alias("stored_truncated"),
        *extra,
    )


def finite_difference(frames: DataFrame, state: str, dt: float, velocity: str = "velocity") -> DataFrame:
    """Velocity ``(x - previous) / dt``, zero on the first frame; the state becomes ``concat(x, v)``."""
    wide = look_around(frames, {"_prev": (c(state), -1)})
    v = F.zip_with(c(state), F.coalesce(c("_prev"), c(state)), lambda x, p: (x - p) / F.lit(dt))
    return wide.withColumn(velocity, v).withColumn(state, F.concat(c(state), c(velocity))).drop("_prev")


def time_limit(frames: DataFrame, max_steps: int, truncated: str | None = None) -> DataFrame:
    """``truncated`` is true from step ``max_steps`` on; the dense frame number is the step counter."""
    before = c(truncated) if truncated else F.lit(False)
    return frames.withColumn("truncated", (c(FRAME) + 1 >= max_steps) | before)


def jump_check(frames: DataFrame, position: str, low: Sequence[float], high: Sequence[float], max_step: float) -> DataFrame:
    """Clip a position to bounds and flag steps longer than ``max_step``; flagged rows are the violations."""
    bounds = F.zip_with(doubles(*low), doubles(*high), lambda a, b: F.struct(a.alias("lo"), b.alias("hi")))
    clipped = F.zip_with(c(position), bounds, lambda x, b: F.greatest(b["lo"], F.least(b["hi"], x)))
    wide = look_around(frames.withColumn("_clipped", clipped), {"_prev": (c("_clipped"), -1)})
    step = F.coalesce(norm(vsub(c("_clipped"), c("_prev"))), F.lit(0.0))
    return wide.withColumns({"step": step, "is_jump": step > max_step}).withColumn(position, c("_clipped")).drop("_clipped", "_prev")


def latched_reference(frames: DataFrame, enabled: str, pose: str, step: str | None = None) -> DataFrame:
    """Hold the pose seen at each rising edge of ``enabled`` and the last command while disabled.

    ``reference`` is the latched pose; ``command`` is ``reference + step`` while enabled, the last such command while
    disabled, and before any enabled row the pose of the first frame.
    """
    wide = look_around(frames, {"_was": (c(enabled), -1)})
    edge = c(enabled) & ~F.coalesce(c("_was"), F.lit(False))
    held = running(wide, {"reference": ("last", F.when(edge, c(pose))), "_first": ("last", F.when(c(FRAME) == 0, c(pose)))})
    moved = c("reference") if step is None else F.zip_with(c("reference"), c(step), lambda a, b: a + b)
    held = held.withColumn("_command", F.when(c(enabled), moved))
    held = running(held, {"command": ("last", c("_command"))})
    return held.withColumn("command", F.coalesce(c("command"), c("_first"))).drop("_was", "_first", "_command")


def forward_fill_downsample(frames: DataFrame, key: str, k: int, out: str | None = None) -> DataFrame:
    """Every ``k``-th value, repeated until the next kept one: a look back of at most ``k - 1`` rows."""
    wide, window, keep = with_halo(frames, k - 1, 0)
    kept = F.last(F.when(c(FRAME) % k == 0, F.struct(c(key).alias("v"))), ignorenulls=True)
    return drop_halo(wide.withColumn(out or key, kept.over(window.rowsBetween(1 - k, 0))["v"]), keep)


def motion_score(frames: DataFrame, position: str) -> DataFrame:
    """Mean step length per episode over the first three dimensions; NaN under two rows or three dimensions."""
    xyz = F.slice(c(position), 1, 3)
    wide = look_around(frames.select(EPISODE, FRAME, xyz.alias("_p")), {"_prev": (c("_p"), -1)})
    step = F.when(F.size("_p") >= 3, norm(vsub(c("_p"), c("_prev"))))
    return wide.groupBy(EPISODE).agg(F.coalesce(F.avg(step), F.lit(float("nan"))).alias("motion_score"))


def resample(frames: DataFrame, keys: Sequence[str], fps_from: float, fps_to: float, length: str = "episode_length") -> DataFrame:
    """Linear interpolation of vector columns onto another frame rate.

    Each source frame emits the target frames between itself and the next one, so no join on positions is needed and a
    long episode is spread like its frames are.
    """
    if abs(fps_from - fps_to) < 1e-6:
        return frames.select(EPISODE, FRAME, *[c(k) for k in keys])
    ratio = Fraction(fps_from).limit_denominator(10**6) / Fraction(fps_to).limit_denominator(10**6)
    a, b = ratio.numerator, ratio.denominator  # source position of target j is j * a / b
    wide = look_around(frames, {f"_n{i}": (c(k), 1) for i, k in enumerate(keys)})
    f, n = c(FRAME), c(length)
    n_to = F.when(n <= 1, n).otherwise(F.rint((n - 1) / F.lit(float(fps_from)) * F.lit(float(fps_to))).cast("long") + 1)
    first = F.expr(f"(`{FRAME}` * {b}L + {a - 1}L) div {a}L")
    following = F.expr(f"((`{FRAME}` + 1L) * {b}L + {a - 1}L) div {a}L") - 1
    last = F.when(f == n - 1, n_to - 1).otherwise(F.least(following, n_to - 1))
    targets = F.when(first <= last, F.sequence(first, last))
    wide = wide.withColumn("_j", F.explode(targets))
    wide = wide.withColumn("_share", (F.col("_j") * a - f * b) / F.lit(float(b)))
    w = F.col("_share")
    out = []
    for i, k in enumerate(keys):
        ahead = F.coalesce(c(f"_n{i}"), c(k))
        out.append(F.zip_with(c(k), ahead, lambda x, y: x + (y - x) * w).alias(k))
    return wide.select(EPISODE, F.col("_j").alias(FRAME), *out)


def interpolate_progress(frames: DataFrame, value: str, out: str = "progress") -> DataFrame:
    """Fill gaps linearly by frame number; ends are held; an episode without a finite value stays NaN."""
    v = c(value).cast("double")
    known = F.when(v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), F.struct(c(FRAME).alias("f"), v.alias("v")))
    wide = running(frames, {"_b": ("last", known), "_a": ("next", known)})
    b, a = c("_b"), c("_a")
    lerp = b["v"] + (a["v"] - b["v"]) * (c(FRAME) - b["f"]) / (a["f"] - b["f"])
    filled = F.when(a.isNull(), b["v"]).when(b.isNull() | (a["f"] == b["f"]), a["v"]).otherwise(lerp)
    return wide.withColumn(out, F.coalesce(filled, F.lit(float("nan"))).cast("float")).drop("_a", "_b")


# ---------------------------------------------------------------- action chunks in time


def chunk_timestamps(chunks: DataFrame, t0: str, i0: str, dt: float, actions: str = "actions") -> DataFrame:
    """One row per action of a chunk with its timestamp and timestep."""
    rest = [c(n) for n in chunks.columns if n not in (t0, i0, actions)]
    rows = chunks.select(*rest, c(t0), c(i0), F.posexplode(c(actions)).alias("pos", "action"))
    return rows.select(
        *rest, "pos", (c(t0) + F.col("pos") * dt).alias("timestamp"), (c(i0) + F.col("pos")).alias("timestep"), "action"
    )


# How an old and a new action for the same timestep are combined, as (weight of old, weight of new).
AGGREGATES = {"weighted_average": (0.3, 0.7), "latest_only": (0.0, 1.0), "average": (0.5, 0.5), "conservative": (0.7, 0.3)}


def merge_overlapping_chunks(
    actions: DataFrame, fn: str = "weighted_average", keys: Sequence[str] = (EPISODE,), latest: str | None = None
) -> DataFrame:
    """Fold the actions predicted for one timestep in arrival order.

    ``actions`` has ``keys``, ``arrival`` (0, 1, … per key), ``timestep`` and ``action`` (vector). Rows at or before the
    ``latest`` executed timestep are dropped. The queue becomes the incoming chunk, so a timestep the previous chunk did
    not cover starts afresh. A timestep is only predicted by chunks within one horizon of it, which bounds the groups.
    """
    old, new = AGGREGATES[fn]
    live = actions.filter(c("timestep") > c(latest)) if latest else actions
    grouped = live.groupBy(*[c(k) for k in keys], "timestep").agg(
        F.array_sort(F.collect_list(F.struct("arrival", "action"))).alias("_all")
    )
    first = F.element_at("_all", 1)
    fold = F.aggregate(
        F.slice("_all", 2, F.greatest(F.size("_all") - 1, F.lit(0))),
        first,
        lambda acc, x: F.struct(
            x["arrival"].alias("arrival"),
            F.when(x["arrival"] > acc["arrival"] + 1, x["action"])
            .otherwise(F.zip_with(acc["action"], x["action"], lambda p, q: p * old + q * new))
            .alias("action"),
        ),
    )
    return grouped.select(*[c(k) for k in keys], "timestep", fold.alias("_r")).select(
        *[c(k) for k in keys], "timestep", F.col("_r.arrival").alias("arrival"), F.col("_r.action").alias("action")
    )


def action_queue(chunks: DataFrame, mode: str, keys: Sequence[str] = (EPISODE,)) -> DataFrame:
    """What the queue holds after the last chunk.

    ``chunks`` has ``keys``, ``arrival`` (0, 1, … per key), ``actions``, ``delay`` and ``consumed`` (actions taken between
    the previous arrival and this one). ``replace`` keeps the newest chunk without its first ``delay`` actions; ``append``
    joins all chunks and drops what was consumed.
    """
    key_cols = [c(k) for k in keys]
    if mode == "replace":
        newest = chunks.groupBy(*key_cols).agg(F.max_by(F.struct("actions", "delay"), "arrival").alias("_n"))
        rows = newest.select(*key_cols, F.col("_n.delay").alias("_d"), F.posexplode("_n.actions").alias("_at", "action"))
        kept = rows.filter(F.col("_at") >= F.col("_d"))
        return kept.select(*key_cols, (F.col("_at") - F.col("_d")).cast("long").alias("pos"), "action")
    if mode != "append":
        raise ValueError(f"unknown queue mode {mode!r}")
    sized = chunks.withColumn("_size", F.size("actions").cast("long"))
    laid = running(sized, {"_end": ("sum", c("_size"))}, keys=keys, order="arrival")
    # The first chunk is taken as it is: nothing was in the queue to consume before it.
    taken = F.when(c("arrival") == 0, 0).otherwise(c("consumed"))
    laid = join_episodes(
        laid,
        sized.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("_chunks"), F.sum(taken).cast("long").alias("_taken")),
        length="_chunks",
        keys=keys,
        order="arrival",
    )
    rows = laid.select(*key_cols, (F.col("_end") - F.col("_size")).alias("_from"), "_taken", F.posexplode("actions").alias("_at", "action"))
    at = F.col("_from") + F.col("_at") - F.col("_taken")
    return rows.filter(at >= 0).select(*key_cols, at.cast("long").alias("pos"), "action")


def temporal_ensemble(chunks: DataFrame, coeff: float, keys: Sequence[str] = (EPISODE,), start: str = FRAME) -> DataFrame:
    """One action per timestep: the mean of all chunk predictions for it, weights ``exp(-coeff * i)``, oldest ``i = 0``."""
    rows = chunks.select(*[c(k) for k in keys], c(start).alias("_from"), F.posexplode("chunk").alias("_at", "_action"))
    rows = rows.withColumn("timestep", F.col("_from") + F.col("_at"))
    window = Window.partitionBy(*[c(k) for k in keys], "timestep").orderBy("_from")
    rows = rows.withColumn("_w", F.exp(F.lit(-coeff) * (F.row_number().over(window) - 1)))
    values = rows.select(*[c(k) for k in keys], "timestep", "_w", F.posexplode("_action").alias("dim", "_x"))
    return values.groupBy(*[c(k) for k in keys], "timestep", "dim").agg(
        (F.sum(F.col("_w") * F.col("_x")) / F.sum("_w")).alias("value")
    )
