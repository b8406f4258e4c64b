"""Normalisation and numeric transforms (N1-N16). Every function is one projection; statistics are plan literals."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from trajspark.functions import rotation
from trajspark.functions.columns import c, doubles

Stats = Mapping[str, Mapping[str, Sequence[float]]]

# Statistics each mode needs.
MODE_STATS = {"MEAN_STD": ("mean", "std"), "MIN_MAX": ("min", "max"), "QUANTILES": ("q01", "q99"), "QUANTILE10": ("q10", "q90")}
EPS = 1e-8


def stats_literals(stats: DataFrame) -> dict[str, dict[str, list[float]]]:
    """Long statistics table to ``{feature: {stat: [per dim]}}``; as many rows as there are numbers in a frame."""
    out: dict[str, dict[str, list]] = {}
    names = [n for n in stats.columns if n not in ("feature", "dim")]
    for row in sorted(stats.collect(), key=lambda r: (r["feature"], r["dim"])):
        for n in names:
            if row[n] is not None:
                out.setdefault(row["feature"], {}).setdefault(n, []).append(row[n])
    return out


def feature_kind(name: str, spec: Mapping) -> str | None:
    """VISUAL, ENV, STATE, ACTION or REWARD by dtype and name."""
    if spec["dtype"] in ("image", "video"):
        return "VISUAL"
    if name == "observation.environment_state":
        return "ENV"
    if name.startswith("observation"):
        return "STATE"
    if name.startswith("action"):
        return "ACTION"
    return "REWARD" if name == "next.reward" else None


def _modes(features: Mapping[str, Mapping], by_kind: Mapping[str, str], keys: Sequence[str] | None) -> dict[str, str]:
    out = {}
    for name, spec in features.items():
        mode = by_kind.get(feature_kind(name, spec), "IDENTITY")
        if mode != "IDENTITY" and (keys is None or name in keys):
            if mode not in MODE_STATS:
                raise ValueError(f"unsupported normalisation mode {mode}")
            out[name] = mode
    return out


def _bounds(name: str, mode: str, stats: Stats) -> tuple[list[float], list[float]]:
    a, b = MODE_STATS[mode]
    if a not in stats[name] or b not in stats[name]:
        raise ValueError(f"mode {mode} needs {a} and {b} of {name!r}")
    return list(stats[name][a]), list(stats[name][b])


def _per_entry(df: DataFrame, name: str, constants: Sequence[Sequence[float]], fn) -> Column:
    """``fn(x, *constants of that dim)`` on every entry of a vector, or on a scalar."""
    if not isinstance(df.schema[name].dataType, T.ArrayType):
        return fn(c(name).cast("double"), *[F.lit(float(k[0])) for k in constants])
    table = [doubles(*k) for k in constants]
    return F.transform(c(name), lambda x, i: fn(x.cast("double"), *[F.get(k, i) for k in table]))


def normalize(
    frames: DataFrame, features: Mapping[str, Mapping], stats: Stats, by_kind: Mapping[str, str], keys: Sequence[str] | None = None, eps: float = EPS
) -> DataFrame:
    """Mode per feature kind; ``MEAN_STD`` adds ``eps`` to the deviation, the ranges map to [-1, 1] without clipping."""
    out = {}
    for name, mode in _modes(features, by_kind, keys).items():
        if name not in stats:
            continue
        lo, hi = _bounds(name, mode, stats)
        if mode == "MEAN_STD":
            out[name] = _per_entry(frames, name, [lo, [s + eps for s in hi]], lambda x, m, s: (x - m) / s)
        else:
            span = [(h - l) if h != l else eps for l, h in zip(lo, hi)]
            out[name] = _per_entry(frames, name, [lo, span], lambda x, l, d: 2 * (x - l) / d - 1)
    return frames.withColumns(out)


def unnormalize(
    frames: DataFrame, features: Mapping[str, Mapping], stats: Stats, by_kind: Mapping[str, str], keys: Sequence[str] | None = None, eps: float = EPS
) -> DataFrame:
    """Inverse of ``normalize`` up to ``eps``: ``MEAN_STD`` multiplies by the plain deviation."""
    out = {}
    for name, mode in _modes(features, by_kind, keys).items():
        if name not in stats:
            continue
        lo, hi = _bounds(name, mode, stats)
        if mode == "MEAN_STD":
            out[name] = _per_entry(frames, name, [lo, hi], lambda x, m, s: x * s + m)
        else:
            span = [(h - l) if h != l else eps for l, h in zip(lo, hi)]
            out[name] = _per_entry(frames, name, [lo, span], lambda x, l, d: (x + 1) / 2 * d + l)
    return frames.withColumns(out)


def normalize_clipped(frames: DataFrame, name: str, stats: Stats, mode: str, eps: float = EPS) -> DataFrame:
    """Denominators of at least ``eps``; the quantile modes clip first. Nested vectors (chunks) are mapped row by row."""
    if mode == "IDENTITY":
        return frames
    lo, hi = _bounds(name, mode, stats)
    if mode == "MEAN_STD":
        table = (lo, [max(s, eps) for s in hi])
    else:
        table = (lo, [max(h - l, eps) for l, h in zip(lo, hi)])
    a, d, top = doubles(*table[0]), doubles(*table[1]), doubles(*hi)
    clip = mode in ("QUANTILES", "QUANTILE10")

    def entry(x: Column, i: Column) -> Column:
        x = x.cast("double")
        if clip:
            x = F.greatest(F.get(a, i), F.least(F.get(top, i), x))
        scaled = (x - F.get(a, i)) / F.get(d, i)
        return scaled if mode == "MEAN_STD" else 2 * scaled - 1

    kind = frames.schema[name].dataType
    if isinstance(kind.elementType, T.ArrayType):
        return frames.withColumn(name, F.transform(c(name), lambda row: F.transform(row, entry)))
    return frames.withColumn(name, F.transform(c(name), entry))


def normalize_padded(frames: DataFrame, name: str, stats: Stats, dim: int) -> DataFrame:
    """Min-max where a zero range gives 0; statistics are cut or padded with 0 / 1 to ``dim``."""
    lo = (list(stats[name]["min"]) + [0.0] * dim)[:dim]
    hi = (list(stats[name]["max"]) + [1.0] * dim)[:dim]
    span = [h - l for l, h in zip(lo, hi)]
    scaled = lambda x, l, d: F.when(d == 0, 0.0).otherwise(2 * (x - l) / d - 1)
    return frames.withColumn(name, _per_entry(frames, name, [lo, span], scaled))


def swap_stats(stats: Stats, new: Stats, visual: Sequence[str] = (), visual_stats: Mapping[str, Sequence[float]] | None = None) -> dict:
    """Statistics with new constants; cameras may be overridden by fixed ones. The transform is simply built again."""
    out = {**stats, **new}
    if visual_stats is not None:
        out.update({v: {**out.get(v, {}), **visual_stats} for v in visual})
    return out


def discretize(x: Column, bins: int = 256) -> Column:
    """Bin on [-1, 1]: below the range -1, at or above its end the last bin."""
    return F.when(x < -1, -1).otherwise(F.least(F.lit(bins - 1), F.floor((x + 1) * (bins / 2)))).cast("int")


def parse_dims(ranges: str) -> list[tuple[int, int]]:
    """``"0:6,7:23"`` to half-open ranges."""
    return [tuple(int(x) for x in part.split(":")) for part in ranges.split(",")]


def select_dims(vector: Column, ranges: str) -> Column:
    return F.concat(*[F.slice(vector, a + 1, b - a) for a, b in parse_dims(ranges)])


def select_stat_dims(stats: Stats, name: str, ranges: str) -> dict:
    picked = [i for a, b in parse_dims(ranges) for i in range(a, b)]
    cut = {k: [v[i] for i in picked] if len(v) > 1 or k != "count" else list(v) for k, v in stats[name].items()}
    return {**stats, name: cut}


def map_action_to_deltas(frames: DataFrame, action: str = "action", gripper: bool = True) -> DataFrame:
    names = ["delta_x", "delta_y", "delta_z", *(["gripper"] if gripper else [])]
    return frames.withColumns({n: c(action)[i] for i, n in enumerate(names)})


def delta_to_target(frames: DataFrame, scale: float = 1.0, noise: float = 1e-3) -> DataFrame:
    """Scaled targets without rotation; ``enabled`` when the step is longer than the noise threshold."""
    d = [c("delta_x"), c("delta_y"), c("delta_z")]
    size = F.sqrt(d[0] * d[0] + d[1] * d[1] + d[2] * d[2])
    targets = {f"target_{a}": v * scale for a, v in zip("xyz", d)}
    zeros = {f"target_w{a}": F.lit(0.0) for a in "xyz"}
    return frames.withColumns({"enabled": size > noise, **targets, **zeros, "gripper_vel": c("gripper").cast("double")}).drop(
        "delta_x", "delta_y", "delta_z", "gripper"
    )


def pose_features(frames: DataFrame, pose: str) -> DataFrame:
    """Rotation views of a 6-number pose (xyz + rotation vector)."""
    q = rotation.rotvec_to_quat(F.slice(c(pose), 4, 3))
    wide = frames.withColumn("quat", q)
    return wide.withColumns(
        {
            "rotvec": rotation.quat_to_rotvec(c("quat")),
            "axis_angle": rotation.quat_to_axis_angle(c("quat")),
            "rot6d": rotation.matrix_to_6d(rotation.quat_to_matrix(c("quat"))),
        }
    )


def gripper_penalty(state: Column, action: Column, largest: float, penalty: float) -> Column:
    """Penalty for closing a closed or opening an open gripper."""
    s, a = state / largest, action / largest
    wasted = ((s < 0.5) & (a > 0.5)) | ((s > 0.75) & (a < 0.5))
    return F.when(wasted, float(penalty)).otherwise(0.0)


def apply_interventions(
    frames: DataFrame, gripper: bool = True, terminate_on_success: bool = True, action: str = "action", teleop: str = "teleop_action"
) -> DataFrame:
    """Replace the action where ``is_intervention``; ``teleop_action`` is a struct or a vector, missing entries are 0 (gripper 1)."""
    kind = frames.schema[teleop].dataType
    if isinstance(kind, T.StructType):
        names = ["delta_x", "delta_y", "delta_z", *(["gripper"] if gripper else [])]
        parts = [F.coalesce(c(teleop)[n], F.lit(1.0 if n == "gripper" else 0.0)) if n in kind.names else F.lit(1.0 if n == "gripper" else 0.0) for n in names]
        given = F.array(*parts)
    else:
        given = c(teleop)
    flag = F.coalesce(c("is_intervention"), F.lit(False)) & c(teleop).isNotNull()
    success = F.coalesce(c("success"), F.lit(False))
    done = F.coalesce(c("terminate_episode"), F.lit(False)) | (F.lit(terminate_on_success) & success)
    return frames.withColumns({action: F.when(flag, given).otherwise(c(action)), "done": done, "reward": success.cast("double")})


def success_from_score(frames: DataFrame, score: str, threshold: float = 0.5, reward: float = 1.0, terminate: bool = True) -> DataFrame:
    """On success set the reward, and done if asked; otherwise keep the incoming values."""
    hit = c(score) > threshold
    done = F.when(hit & F.lit(terminate), True).otherwise(c("done"))
    return frames.withColumns({"reward": F.when(hit, float(reward)).otherwise(c("reward")), "done": done})


def gripper_velocity_to_position(position: Column, velocity: Column, speed: float, low: float, high: float, discrete: bool = False) -> Column:
    """New gripper position; discrete velocities 0 / 1 / 2 mean -high / 0 / +high."""
    v = (velocity - 1) * high if discrete else velocity
    return F.greatest(F.lit(float(low)), F.least(F.lit(float(high)), position + v * speed))


def remap_teleop_log(log: DataFrame, platform: str) -> DataFrame:
    """Axis swap and signs of a phone log, zero while disabled; the gripper is read from the platform's buttons."""
    on = c("enabled")
    pos, rot = c("pos"), rotation.quat_to_rotvec(c("rot"))
    gate = lambda v: F.when(on, v).otherwise(0.0)
    button = lambda n: F.coalesce(c("raw_inputs")[n], F.lit(0.0))
    grip = button("a3") if platform == "ios" else button("reservedButtonA") - button("reservedButtonB")
    return log.withColumns(
        {
            "target_x": gate(-pos[1]),
            "target_y": gate(pos[0]),
            "target_z": gate(pos[2]),
            "target_wx": gate(rot[1]),
            "target_wy": gate(rot[0]),
            "target_wz": gate(-rot[2]),
            "gripper_vel": grip,
        }
    ).drop("pos", "rot", "raw_inputs")


def binarize_gripper(x: Column) -> Column:
    return F.when(x > 0.5, 1.0).otherwise(-1.0)


# Gripper ranges in metres and radians.
LINEAR_OPEN, LINEAR_CLOSED = 0.01844, 0.05800
ANGLE_LOW, ANGLE_HIGH = 0.4, 1.5
JOINT_LOW, JOINT_HIGH = -0.6213, 1.4910
ARM_LENGTH, HORN_RADIUS = 0.036, 0.022


def rescale(x: Column, old: tuple[float, float], new: tuple[float, float]) -> Column:
    return (x * (old[1] - old[0]) + old[0] - new[0]) / (new[1] - new[0])


def gripper_linear_to_angular(x: Column) -> Column:
    """Normalised linear opening to normalised angle through the horn linkage."""
    p = x * (LINEAR_CLOSED - LINEAR_OPEN) + LINEAR_OPEN
    sine = (HORN_RADIUS**2 + p * p - ARM_LENGTH**2) / (2 * HORN_RADIUS * p)
    angle = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), sine)))
    return (angle - ANGLE_LOW) / (ANGLE_HIGH - ANGLE_LOW)


def gripper_from_angular(x: Column) -> Column:
    return rescale(x, (ANGLE_LOW, ANGLE_HIGH), (JOINT_LOW, JOINT_HIGH))


def gripper_from_angular_inverse(x: Column) -> Column:
    return rescale(x, (JOINT_LOW, JOINT_HIGH), (ANGLE_LOW, ANGLE_HIGH))


