"""Column functions against numpy."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetrace.functions import rotations as R
from kinetrace.functions import scalars as S
from kinetrace.functions import vectors as V


def one(spark, value, columns, schema):
    return spark.createDataFrame([value], schema).select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).first()


def quats(n, seed):
    q = np.random.default_rng(seed).normal(size=(n, 4))
    return q / np.linalg.norm(q, axis=1, keepdims=True)


def matrix(q):
    x, y, z, w = q
    return np.array([[1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w)], [2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)], [2 * (x * z - y * w), 2 * (y * z + x * w), 1 - 2 * (x * x + y * y)]])


def test_layout(spark):
    v = [1.0, 2.0, 3.0, 4.0]
    got = one(spark, (v, ["a", "b", "c", "d"]), [V.part("v", 1, 3), V.padded("v", 6), V.pad_mask("v", 6), V.last_n("v", 2), V.last_n("v", 9), V.gather("v", [3, 0]), V.reordered("n", "v", ["d", "a"]), V.reordered("n", "v", ["z"])], "v array<double>, n array<string>")
    assert list(got) == [[2, 3], [1, 2, 3, 4, 0, 0], [1, 1, 1, 1, 0, 0], [3, 4], v, [4, 1], [4, 1], [None]]
    assert V.ranges({"a": 2, "b": 3}) == {"a": (0, 2), "b": (2, 5)} and V.element_names({"a": 2}) == ["a_0", "a_1"]
    assert V.dimensions({"a": 2, "b": 3}, ["b"]) == 8
    chunk = one(spark, ([[1.0], [2.0]],), [V.padded_chunk("c", 3, 2), V.chunk_mask("c", 3, 2)], "c array<array<double>>")
    assert list(chunk) == [[[1, 0], [2, 0], [0, 0]], [[1, 0], [1, 0], [0, 0]]]


def test_normalisation(spark):
    lo, hi, mean, std = [0.0, 1.0, 5.0], [10.0, 3.0, 5.0], [5.0, 0.0, 1.0], [2.0, 1.0, 0.0]
    rng = np.random.default_rng(0)
    v = (np.array(lo) + rng.random(3) * (np.array(hi) - lo)).tolist()
    p = {"min": "lo", "max": "hi", "mean": "mean", "std": "std"}
    cols = [V.min_max("v", "lo", "hi"), V.min_max_back(V.min_max("v", "lo", "hi"), "lo", "hi"), V.mean_std_back(V.mean_std("v", "mean", "std"), "mean", "std"), V.sin_cos("v"), V.state_group("big", p, "min_max"), V.state_group("big", p, "mean_std"), V.min_max_back("big", "lo", "hi")]
    got = one(spark, (v, lo, hi, mean, std, [99.0, -99.0, 7.0]), cols, "v array<double>, lo array<double>, hi array<double>, mean array<double>, std array<double>, big array<double>")
    assert got.c0[2] == 0 and all(-1 <= x <= 1 for x in got.c0)
    assert np.allclose(got.c1[:2], v[:2]) and np.allclose(got.c2, v)
    assert np.allclose(got.c3, np.concatenate([np.sin(v), np.cos(v)]))
    assert got.c4 == [1, -1, 0] and got.c5 == [47, -99, 7] and got.c6[:2] == [10, 1]
    with pytest.raises(ValueError):
        V.state_group("v", p, "other")


def test_actions_round_trip(spark):
    chunk = [[1.0, 2.0], [3.0, 5.0]]
    p = {"min": "lo", "max": "hi"}
    back = V.action_group_back(V.action_group("c", p, "min_max", "ref"), p, "min_max", "ref")
    got = one(spark, (chunk, [1.0, 1.0], [-5.0, -5.0], [5.0, 5.0]), [back], "c array<array<double>>, ref array<double>, lo array<double>, hi array<double>")
    assert np.allclose(got.c0, chunk)


def test_rotations(spark):
    for a, b in zip(quats(6, 1), quats(6, 2)):
        t, t0 = np.random.default_rng(3).normal(size=(2, 3))
        cols = [R.quat_matrix("a"), R.matrix_quat(R.quat_matrix("a")), R.rot6d_matrix(R.quat_rot6d("a")), R.rotvec_quat(R.quat_rotvec("a")), R.slerp("a", "b", F.lit(0.3)), R.product(R.quat_matrix("a"), R.quat_matrix("b")), R.matrix_euler(R.quat_matrix("a")), R.euler_matrix(R.matrix_euler(R.quat_matrix("a")))]
        rel = R.relative_pose("t", R.quat_matrix("a"), "t0", R.quat_matrix("b"))
        back = R.composed_pose("t0", R.quat_matrix("b"), *rel)
        got = one(spark, (a.tolist(), b.tolist(), t.tolist(), t0.tolist()), [*cols, rel[0], rel[1], back[0], back[1]], "a array<double>, b array<double>, t array<double>, t0 array<double>")
        m, n = matrix(a), matrix(b)
        same = lambda x, q: np.allclose(x, q) or np.allclose(x, -q)
        assert np.allclose(got.c0, m.ravel()) and same(got.c1, a) and np.allclose(got.c2, m.ravel()) and same(got.c3, a)
        d = abs(a @ b)
        assert abs(abs(np.array(got.c4) @ a) - math.cos(0.3 * math.acos(d))) < 1e-9
        assert np.allclose(got.c5, (m @ n).ravel()) and np.allclose(got.c7, m.ravel())
        assert np.allclose(got.c8, n.T @ (t - t0)) and np.allclose(got.c9, (n.T @ m).ravel())
        assert np.allclose(got.c10, t) and np.allclose(got.c11, m.ravel())


@pytest.mark.parametrize("kind", ["xyz_rot6d", "xyz_rotvec", "xyz_quat", "matrix"])
def test_pose_formats(spark, kind):
    q = quats(1, 5)[0]
    pose = [0.1, 0.2, 0.3, *q.tolist()]
    flat = R.converted_pose("p", "xyz_quat", kind)
    back = R.converted_pose(flat, kind, "xyz_rot6d")
    got = one(spark, (pose,), [back], "p array<double>")
    assert np.allclose(got.c0, [0.1, 0.2, 0.3, *matrix(q).ravel()[:6]])


def test_pose_conversions_do_not_repeat_norms(spark):
    """Repeated in the expression, a norm would be computed for each mention, in powers of the depth."""
    df = spark.createDataFrame([([0.1] * 9,)], "p array<double>")
    for kind, to, most in (("xyz_rot6d", "matrix", 4), ("xyz_rot6d", "xyz_rotvec", 8), ("xyz_rotvec", "xyz_rot6d", 2)):
        plan = df.select(R.converted_pose("p", kind, to))._jdf.queryExecution().analyzed().toString()
        assert 1 <= plan.upper().count("SQRT(") <= most


def test_euler_orders(spark):
    def about(axis, t):
        c, s = math.cos(t), math.sin(t)
        return np.array({"x": [[1, 0, 0], [0, c, -s], [0, s, c]], "y": [[c, 0, s], [0, 1, 0], [-s, 0, c]], "z": [[c, -s, 0], [s, c, 0], [0, 0, 1]]}[axis])

    e = [0.3, -0.5, 1.1]
    got = one(spark, (e,), [R.euler_matrix("e", "xyz", False), R.euler_matrix("e", "XYZ", False)], "e array<double>")
    x, y, z = about("x", e[0]), about("y", e[1]), about("z", e[2])
    assert np.allclose(got.c0, (z @ y @ x).ravel()) and np.allclose(got.c1, (x @ y @ z).ravel())


def test_canonical_wxyz(spark):
    got = one(spark, ([-0.5, 0.5, 0.5, 0.5], [0.0, 0.0, 0.0, 0.0]), [R.quat_unit_wxyz("a"), R.quat_unit_wxyz("z"), R.quat_valid("z")], "a array<double>, z array<double>")
    assert list(got) == [[0.5, -0.5, -0.5, -0.5], [1, 0, 0, 0], False]


def test_scalars(spark):
    got = one(spark, (2.5, 0, 7, "Pick up, the CAN!", "episode_000042.parquet"), [S.half_even("x"), S.chosen_time("h", "b"), S.chosen_time("h", "b", "bag"), S.instruction("t"), S.trailing_number("f"), S.resolve(F.lit("GR1"), {"gr1": "robot_one"}), S.resolve(F.lit("Robot_One"), {"gr1": "robot_one"}), S.resolve(F.lit("?"), {"gr1": "robot_one"}), S.clamp_to_video(F.lit(9.0), F.lit(30), 10.0)], "x double, h long, b long, t string, f string")
    assert list(got) == [2.0, 7, 7, "pick up the can", 42, "robot_one", "robot_one", None, 2.95]
    assert S.to_ns(0.5e-9) == 0 and S.to_ns(0.05) == 50_000_000
    names = one(spark, (["a", "b"], ["b", "a"], ["a", "a"]), [S.no_mismatch("x", "y"), S.no_mismatch("z", "x")], "x array<string>, y array<string>, z array<string>")
    assert list(names) == [True, False]
    assert one(spark, (["r2", None, "r1", "r2"], []), [S.sorted_reasons("r"), S.status("r", "w"), S.status("w", "w"), S.status("w", "r")], "r array<string>, w array<string>")[:] == (["r1", "r2"], "REJECT", "PASS", "PASS_WITH_WARNING")
