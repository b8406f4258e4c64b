"""Rotation columns as native arithmetic on arrays (N9); quaternions are (x, y, z, w)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from trajspark.functions.columns import norm

# Thresholds under which a rotation counts as none.
SMALL_ANGLE = 1e-8
SMALL_SINE = 1e-10
NORM_EPS = 1e-6


def _let(value: Column, fn) -> Column:
    """``fn`` of a value that is computed once, so that chained conversions do not multiply the expression."""
    return F.get(F.transform(F.array(value), fn), 0)


def _scale(v: Column, k: Column) -> Column:
    return F.transform(v, lambda x: x * k)


def _zeros(n: int) -> Column:
    return F.array(*[F.lit(0.0)] * n)


def rotvec_to_quat(v: Column) -> Column:
    def turned(u: Column) -> Column:
        return F.concat(_scale(u["v"], F.sin(u["a"] / 2) / u["a"]), F.array(F.cos(u["a"] / 2)))

    none = F.array(*[F.lit(x) for x in (0.0, 0.0, 0.0, 1.0)])
    with_angle = F.struct(v.alias("v"), norm(v).alias("a"))
    return _let(with_angle, lambda u: F.when(u["a"] < SMALL_ANGLE, none).otherwise(turned(u)))


def _axis_angle(q: Column, w: Column, small: float, none) -> Column:
    parts = F.struct(F.slice(q, 1, 3).alias("v"), w.alias("w"), F.sqrt(F.greatest(F.lit(0.0), 1.0 - w * w)).alias("s"))
    return _let(parts, lambda u: F.when(u["s"] <= small, none(u["v"])).otherwise(_scale(u["v"], 2.0 * F.acos(u["w"]) / u["s"])))


def quat_to_rotvec(q: Column) -> Column:
    """Shortest rotation: the sign is flipped when w is negative; small angles are linearised."""

    def shortest(x: Column) -> Column:
        same = _scale(x, F.when(x[3] < 0, -1.0).otherwise(1.0))
        return _axis_angle(same, F.least(F.lit(1.0), F.abs(x[3])), SMALL_ANGLE, lambda v: _scale(v, F.lit(2.0)))

    return _let(q, shortest)


def quat_to_axis_angle(q: Column) -> Column:
    """w is clamped to [-1, 1] and keeps its sign; rotations without an axis give zeros."""
    clamp = lambda x: F.greatest(F.lit(-1.0), F.least(F.lit(1.0), x[3]))
    return _let(q, lambda x: _axis_angle(x, clamp(x), SMALL_SINE, lambda v: _zeros(3)))


def matrix_to_6d(m: Column) -> Column:
    """First two columns of a 3 x 3 matrix given as rows."""
    return _let(m, lambda x: F.array(*[x[r][k] for k in (0, 1) for r in (0, 1, 2)]))


def quat_to_matrix(q: Column) -> Column:
    def rows(v: Column) -> Column:
        x, y, z, w = v[0], v[1], v[2], v[3]
        return F.array(
            F.array(1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)),
            F.array(2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)),
            F.array(2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)),
        )

    return _let(q, rows)


def _unit(v: Column) -> Column:
    return _let(F.struct(v.alias("v"), (norm(v) + F.lit(NORM_EPS)).alias("n")), lambda u: _scale(u["v"], 1 / u["n"]))


def _cross(a: Column, b: Column) -> Column:
    return F.array(a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0])


def six_d_to_axis_angle(v: Column) -> Column:
    """Gram-Schmidt on the two columns, then angle from the trace and axis from the antisymmetric part.

    Half turns, where that part vanishes, take the axis from the diagonal.
    """

    def orthogonal(x: Column, b1: Column) -> Column:
        dot = b1[0] * x[3] + b1[1] * x[4] + b1[2] * x[5]
        return _unit(F.array(*[x[3 + i] - dot * b1[i] for i in range(3)]))

    def angle_of(b1: Column, b2: Column, b3: Column) -> Column:
        cosine = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (b1[0] + b2[1] + b3[2] - 1) / 2))
        turn = F.array(b2[2] - b3[1], b3[0] - b1[2], b1[1] - b2[0])
        size = F.array(*[F.sqrt(F.greatest(F.lit(0.0), (d + 1) / 2)) for d in (b1[0], b2[1], b3[2])])
        flip = lambda s: F.when(s < 0, -1.0).otherwise(1.0)
        half = F.array(size[0], size[1] * flip(b1[1] + b2[0]), size[2] * flip(b1[2] + b3[0]))
        parts = F.struct(F.acos(cosine).alias("a"), turn.alias("t"), half.alias("h"))

        def pick(u: Column) -> Column:
            sine = F.sin(u["a"])
            general = _scale(u["t"], u["a"] / (2 * sine))
            return F.when(F.abs(sine) > 1e-6, general).when(u["a"] < 1.0, _zeros(3)).otherwise(_scale(u["h"], u["a"]))

        return _let(parts, pick)

    def columns(x: Column) -> Column:
        return _let(
            _unit(F.slice(x, 1, 3)),
            lambda b1: _let(orthogonal(x, b1), lambda b2: _let(_cross(b1, b2), lambda b3: angle_of(b1, b2, b3))),
        )

    return _let(v, columns)


def pose6_to_pos_quat(p: Column) -> Column:
    """xyz + rotation vector to xyz + quaternion."""
    return F.concat(F.slice(p, 1, 3), rotvec_to_quat(F.slice(p, 4, 3)))


def two_arm_state(left: Column, left_grip: Column, right: Column, right_grip: Column) -> Column:
    """16 numbers: position, quaternion and gripper of the left, then of the right arm; null for malformed poses."""
    ok = (F.size(left) == 6) & (F.size(right) == 6)
    state = F.concat(pose6_to_pos_quat(left), F.array(left_grip), pose6_to_pos_quat(right), F.array(right_grip))
    return F.when(ok, state.cast("array<float>"))
