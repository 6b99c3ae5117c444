"""Rotation and pose algebra as column expressions.

Quaternions are xyzw unless said otherwise, matrices row-major arrays of 9, homogeneous matrices
arrays of 16, and a 6D rotation is the first two rows of the matrix.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import Column
from pyspark.sql import functions as F

from .vectors import ColumnLike, dot, doubles, lerp, let, minus, norm, part, scaled

MIN_NORM, MAX_NORM = 0.5, 1.5


def _of(v: ColumnLike, n: int) -> list[Column]:
    return [F.get(doubles(v), F.lit(i)) for i in range(n)]


def bound(f):
    """Binds arguments that are expressions (plain column names need none) before f repeats them."""

    @wraps(f)
    def call(*args, **more):
        at = [i for i, a in enumerate(args) if isinstance(a, Column)]
        if not at:
            return f(*args, **more)
        return let(lambda *given: f(*[given[at.index(i)] if i in at else a for i, a in enumerate(args)], **more), *[args[i] for i in at])

    return call


@bound
def quat_valid(q: ColumnLike) -> Column:
    n = norm(q)
    return F.coalesce((n >= MIN_NORM) & (n <= MAX_NORM), F.lit(False))


@bound
def quat_unit(q: ColumnLike) -> Column:
    return scaled(q, 1 / norm(q))


@bound
def quat_unit_wxyz(q: ColumnLike) -> Column:
    """Unit quaternion (wxyz) with w >= 0; nearly zero ones become the identity."""
    n = norm(q)
    sign = F.when(F.get(doubles(q), F.lit(0)) < 0, -1.0).otherwise(1.0)
    return F.when(n < 1e-12, F.array(*[F.lit(x) for x in (1.0, 0.0, 0.0, 0.0)])).otherwise(scaled(q, sign / n))


@bound
def wxyz(q: ColumnLike) -> Column:
    x, y, z, w = _of(q, 4)
    return F.array(w, x, y, z)


@bound
def xyzw(q: ColumnLike) -> Column:
    w, x, y, z = _of(q, 4)
    return F.array(x, y, z, w)


@bound
def quat_matrix(q: ColumnLike) -> Column:
    x, y, z, w = _of(q, 4)
    return F.array(
        1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w),
        2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w),
        2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y),
    )


@bound
def matrix_quat(m: ColumnLike) -> Column:
    """Unit quaternion of a rotation matrix, from its largest component."""
    a, b, c, d, e, f, g, h, i = _of(m, 9)
    one = F.lit(1.0)
    cases = (
        (a + e + i, F.array(h - f, c - g, d - b, one + a + e + i)),
        (a, F.array(one + a - e - i, b + d, c + g, h - f)),
        (e, F.array(b + d, one - a + e - i, f + h, c - g)),
        (i, F.array(c + g, f + h, one - a - e + i, d - b)),
    )
    top = F.greatest(*[k for k, _ in cases])
    q = F.when(cases[0][0] == top, cases[0][1])
    for k, v in cases[1:]:
        q = q.when(k == top, v)
    return quat_unit(q)


def matrix_rot6d(m: ColumnLike) -> Column:
    return part(doubles(m), 0, 6)


def quat_rot6d(q: ColumnLike) -> Column:
    return matrix_rot6d(quat_matrix(q))


@bound
def cross(a: ColumnLike, b: ColumnLike) -> Column:
    a0, a1, a2 = _of(a, 3)
    b0, b1, b2 = _of(b, 3)
    return F.array(a1 * b2 - a2 * b1, a2 * b0 - a0 * b2, a0 * b1 - a1 * b0)


@bound
def rot6d_matrix(r: ColumnLike) -> Column:
    """Gram-Schmidt on the two rows, and their cross product."""
    x, b = quat_unit(part(doubles(r), 0, 3)), part(doubles(r), 3, 6)

    def rows(x: Column, b: Column) -> Column:
        y = quat_unit(minus(b, scaled(x, dot(x, b))))
        return let(lambda y: F.concat(x, y, cross(x, y)), y)

    return let(rows, x, b)


@bound
def quat_rotvec(q: ColumnLike) -> Column:
    """Axis times angle, the angle 2 atan2(|v|, w)."""
    v, w = part(doubles(q), 0, 3), F.get(doubles(q), F.lit(3))
    return let(lambda v, n: scaled(v, F.when(n < 1e-12, F.lit(2.0)).otherwise(2 * F.atan2(n, w) / n)), v, norm(v))


@bound
def rotvec_quat(v: ColumnLike) -> Column:
    return let(lambda a: F.concat(scaled(v, F.when(a < 1e-12, F.lit(0.5)).otherwise(F.sin(a / 2) / a)), F.array(F.cos(a / 2))), norm(v))


@bound
def slerp(a: ColumnLike, b: ColumnLike, f: Column) -> Column:
    """Shortest path; nearly equal rotations by a normalised line."""
    d = dot(a, b)
    b = F.when(d < 0, scaled(b, F.lit(-1.0))).otherwise(doubles(b))
    d = F.least(F.abs(d), F.lit(1.0))
    theta = F.acos(d)
    s = F.sin(theta)
    arc = F.zip_with(doubles(a), b, lambda x, y: x * F.sin((1 - f) * theta) / s + y * F.sin(f * theta) / s)
    return quat_unit(F.when(d > 0.9995, lerp(a, b, f)).otherwise(arc))


@bound
def transposed(m: ColumnLike) -> Column:
    a, b, c, d, e, f, g, h, i = _of(m, 9)
    return F.array(a, d, g, b, e, h, c, f, i)


@bound
def product(m: ColumnLike, n: ColumnLike) -> Column:
    x, y = _of(m, 9), _of(n, 9)
    return F.array(*[x[3 * r] * y[c] + x[3 * r + 1] * y[3 + c] + x[3 * r + 2] * y[6 + c] for r in range(3) for c in range(3)])


@bound
def rotated(m: ColumnLike, v: ColumnLike) -> Column:
    x, y = _of(m, 9), _of(v, 3)
    return F.array(*[x[3 * r] * y[0] + x[3 * r + 1] * y[1] + x[3 * r + 2] * y[2] for r in range(3)])


def euler_matrix(e: ColumnLike, order: str = "xyz", degrees: bool = True) -> Column:
    """Matrix of Euler angles: lower-case orders turn about fixed axes, upper-case about moving ones."""
    angles = [F.radians(x) if degrees else x for x in _of(e, len(order))]
    zero, one = F.lit(0.0), F.lit(1.0)

    def about(axis: str, t: Column) -> Column:
        c, s = F.cos(t), F.sin(t)
        rows = {"x": (one, zero, zero, zero, c, -s, zero, s, c), "y": (c, zero, s, zero, one, zero, -s, zero, c), "z": (c, -s, zero, s, c, zero, zero, zero, one)}
        return F.array(*rows[axis])

    out = None
    for axis, t in zip(order.lower(), angles):
        turn = about(axis, t)
        out = turn if out is None else product(out, turn) if order.isupper() else product(turn, out)
    return out


@bound
def matrix_euler(m: ColumnLike, degrees: bool = True) -> Column:
    """Angles about fixed x, y, z."""
    a, _, _, d, _, _, g, h, i = _of(m, 9)
    angles = F.array(F.atan2(h, i), F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -g))), F.atan2(d, a))
    return F.transform(angles, F.degrees) if degrees else angles


@bound
def homogeneous(t: ColumnLike, m: ColumnLike) -> Column:
    x, y = _of(t, 3), _of(m, 9)
    return F.array(*[v for r in range(3) for v in (*y[3 * r : 3 * r + 3], x[r])], *[F.lit(v) for v in (0.0, 0.0, 0.0, 1.0)])


def homogeneous_parts(h: ColumnLike) -> tuple[Column, Column]:
    x = _of(h, 16)
    return F.array(x[3], x[7], x[11]), F.array(*[x[4 * r + c] for r in range(3) for c in range(3)])


def inverse_pose(t: ColumnLike, m: ColumnLike) -> tuple[Column, Column]:
    back = transposed(m)
    return scaled(rotated(back, t), F.lit(-1.0)), back


def relative_pose(t: ColumnLike, m: ColumnLike, t0: ColumnLike, m0: ColumnLike) -> tuple[Column, Column]:
    """T0^-1 T as translation and matrix."""
    back = transposed(m0)
    return rotated(back, minus(t, t0)), product(back, m)


def composed_pose(t0: ColumnLike, m0: ColumnLike, t: ColumnLike, m: ColumnLike) -> tuple[Column, Column]:
    return F.zip_with(rotated(m0, t), doubles(t0), lambda a, b: a + b), product(m0, m)


def pose_parts(v: ColumnLike, kind: str) -> tuple[Column, Column]:
    """Translation and matrix of a flat pose: xyz_rot6d, xyz_rotvec, xyz_quat, or matrix (4 x 4)."""
    if kind == "matrix":
        return homogeneous_parts(v)
    t = part(doubles(v), 0, 3)
    if kind == "xyz_rot6d":
        return t, rot6d_matrix(part(doubles(v), 3, 9))
    if kind == "xyz_rotvec":
        return t, quat_matrix(rotvec_quat(part(doubles(v), 3, 6)))
    if kind == "xyz_quat":
        return t, quat_matrix(quat_unit(part(doubles(v), 3, 7)))
    raise ValueError(f"unknown pose format {kind!r}")


def flat_pose(t: Column, m: Column, kind: str) -> Column:
    if kind == "matrix":
        return homogeneous(t, m)
    if kind == "xyz_rot6d":
        return F.concat(t, matrix_rot6d(m))
    if kind == "xyz_rotvec":
        return F.concat(t, quat_rotvec(matrix_quat(m)))
    if kind == "xyz_quat":
        return F.concat(t, matrix_quat(m))
    raise ValueError(f"unknown pose format {kind!r}")


def converted_pose(v: ColumnLike, kind: str, to: str) -> Column:
    return flat_pose(*pose_parts(v, kind), to)


def relative_flat(v: ColumnLike, reference: ColumnLike, kind: str) -> Column:
    return flat_pose(*relative_pose(*pose_parts(v, kind), *pose_parts(reference, kind)), kind)


def absolute_flat(v: ColumnLike, reference: ColumnLike, kind: str) -> Column:
    return flat_pose(*composed_pose(*pose_parts(reference, kind), *pose_parts(v, kind)), kind)


def euler_eef9d(xyz: ColumnLike, euler: ColumnLike, correction: list[float], order: str = "XYZ", degrees: bool = False) -> Column:
    """xyz and 6D rotation of an Euler pose whose frame is turned by a fixed matrix on the right."""
    turn = F.array(*[F.lit(float(x)) for x in correction])
    return F.concat(doubles(xyz), matrix_rot6d(product(euler_matrix(euler, order, degrees), turn)))
