"""Images, records, the legacy plan, statistics files, and the command line."""

import json
import math
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinetrace import cli
from kinetrace.functions import vectors
from kinetrace.operators import etl, images, records
from kinetrace.plans import dataset_stats, legacy
from kinetrace.sources import config, episodes


def test_image_headers(spark):
    jpeg = b"\xff\xd8\xff\xe0" + struct.pack(">H", 4) + b"xx" + b"\xff\xc0" + struct.pack(">HBHHB", 11, 8, 16, 24, 3) + b"\0" * 9
    png = b"\x89PNG\r\n\x1a\n" + struct.pack(">I4sIIBB", 13, b"IHDR", 7, 5, 8, 2) + b"\0" * 8
    df = spark.createDataFrame([(1, bytearray(jpeg)), (2, bytearray(png)), (3, bytearray(jpeg[:9])), (4, None)], "id int, image binary")
    got = {r.id: tuple(r.shape) if r.decoded else None for r in images.with_shapes(df).collect()}
    assert got == {1: (16, 24, 3), 2: (5, 7, 3), 3: None, 4: None}


def test_image_transforms():
    x = np.random.default_rng(0).integers(0, 256, (20, 30, 3)).astype(np.uint8)
    box = images.letterbox(x, 40, 40, 7)
    assert box.shape == (40, 40, 3) and (box[0] == 7).all() and not (box[20] == 7).all()
    assert (images.resized(x, 20, 30) == x).all()
    assert images.cropped(x, 0.5).shape == (10, 15, 3) and (images.cropped(x, 0.5, 3) == images.cropped(x, 0.5, 3)).all()
    assert images.even(x[:19, :29]).shape == (18, 28, 3)
    assert (images.jittered(x, 1) == x).all() and (images.jittered(x, 1, 0.3, 0.3, 0.3) == images.jittered(x, 1, 0.3, 0.3, 0.3)).all()


def test_arrays(spark, tmp_path):
    np.save(tmp_path / "a.npy", np.arange(6).reshape(2, 3))
    np.savez(tmp_path / "b.npz", np.arange(8).reshape(2, 2, 2))
    got = images.read_arrays(spark, str(tmp_path)).orderBy("path", "row").collect()
    assert [(r.row, r["shape"], len(r["values"])) for r in got] == [(0, [2, 3], 6), (0, [2, 2], 4), (1, [2, 2], 4)]
    r = spark.range(1).select(images.frame_index(F.lit(1.0), 30.0, F.lit(40)).alias("a"), images.frame_index(F.lit(1.01), 30.0, F.lit(40)).alias("b"), images.frame_index(F.lit(2.0), 30.0, F.lit(40)).alias("c")).first()
    assert tuple(r) == (30, None, None)


def test_records(spark):
    df = spark.createDataFrame([([(1, 2.0), (3, 4.0)],)], "r array<struct<a:int,b:double>>")
    back = df.select(*records.columns_of("r", ["a", "b"])).select(records.records_of({"a": "a", "b": "b"}).alias("r"))
    assert back.collect() == df.collect()
    assert records.positional_names(["a"], ["x"]) == {"a": "x"} and records.positional_names(["a"], ["b", "a"]) == {"a": "a"}
    with pytest.raises(ValueError):
        records.positional_names(["a"], ["x", "y"])
    v = spark.createDataFrame([(1, [1.0]), (1, [1.0, 2.0]), (2, [1.0])], "e int, v array<double>")
    assert records.shape_faults(v, {"v": 1}).first().n_v == 1 and [r.e for r in records.one_size(v, ["e"], "v").collect()] == [1]
    assert records.complete_stats({"a": {k: [0] for k in records.STATISTICS}}, ["a"], 1) and not records.complete_stats({"a": {"mean": [0]}}, ["a"])
    f = spark.createDataFrame([(1, i, "aabbbc"[i]) for i in range(6)], "e int, i int, d string")
    r = records.sampled_repeat_ratio(f, ["e"], "i", "d").first()
    assert (r.ratio, r.pairs) == (3 / 5, 5)
    w = records.windows_of(spark.createDataFrame([(1, t) for t in (0, 5, 10, 19)], "e int, t long"), ["e"], "t", 10, 5)
    assert sorted((r.t, r.window) for r in w.collect()) == [(0, 0), (5, 0), (5, 1), (10, 1), (10, 2), (19, 2), (19, 3)]


def test_interpolated_chunks(spark):
    t, v = np.array([0.0, 1.0, 1.0, 2.0]), np.array([[0.0], [2.0], [9.0], [4.0]])
    assert records.interpolated(t, v, np.array([0.5, 1.5])).ravel().tolist() == [1, 3]
    for bad in (np.array([-1.0]), np.array([3.0])):
        with pytest.raises(ValueError):
            records.interpolated(t, v, bad)
    with pytest.raises(ValueError):
        records.interpolated(t[:1], v[:1], np.array([0.0]))
    a, b = [0, 0, 0, 1.0], [0, 0, math.sin(0.4), math.cos(0.4)]
    half = records.interpolated(np.array([0.0, 1.0]), np.array([a, b]), np.array([0.5]), slice(0, 4))
    assert np.allclose(half[0], [0, 0, math.sin(0.2), math.cos(0.2)])
    df = spark.createDataFrame([([0.0, 1.0], [[0.0], [10.0]], [0.25])], "t array<double>, c array<array<double>>, at array<double>")
    assert records.interpolated_chunks(df, "t", "c", "at").first().interpolated == [[2.5]]


def test_legacy_conversion(spark):
    rows = []
    for e, skew in ((0, 1), (1, 1), (2, 60)):
        rows += [(e, "cam", i * 100, None) for i in range(60)]
        rows += [(e, "arm", i * 100 + skew, [0.0 if e == 1 else float(i)]) for i in range(-1, 62)]
    df = spark.createDataFrame(rows, "episode int, stream string, t long, v array<double>")
    out = legacy.converted(df, "cam", ["arm"], 0.5, 1000.0, 30)
    got = {r.episode: r.reasons for r in out["quality"].collect()}
    assert got == {0: [], 1: ["no_motion"], 2: ["skew"]}
    frames = out["frames"].orderBy("t").collect()
    assert {r.episode for r in frames} == {0} and [r.v[0] for r in frames[:3]] == [0, 0.5, 1.25]
    s = out["summary"].first()
    assert (s.episodes, s.failed) == (3, 2) and out["fps"].first().fps == 10
    empty = legacy.summary(out["quality"].where("episode < 0")).first()
    assert (empty.episodes, empty.frames, empty.mean_length) == (0, 0, 0)


def test_statistics_files(spark, tmp_path):
    root = str(tmp_path)
    rng = np.random.default_rng(1)
    rows = [(rng.normal(size=2).tolist(), rng.normal(size=2).tolist(), i / 30, i, e, 0, 0, 0) for e in (0, 1) for i in range(20)]
    episodes.write_frames(spark.createDataFrame(rows, episodes.FRAMES_DDL), root)
    episodes.rename_files(root)
    features = episodes.feature_table(["x", "y"], ["a", "b"], {}, 30.0)
    episodes.write_metadata(root, [{"episode_index": e, "tasks": ["t"], "length": 20} for e in (0, 1)], [], features, {}, 30.0)
    assert dataset_stats.generate(spark, root, {"arm": ((0, 2), (0, 2), 4)})
    assert not dataset_stats.generate(spark, root, {"arm": ((0, 2), (0, 2), 4)})
    assert dataset_stats.generate(spark, root, {"arm": ((0, 2), (0, 2), 5)})
    s = episodes.read_json(root, "stats.json")["observation.state"]
    x = np.array([r[0] for r in rows])
    assert np.allclose(s["mean"], x.mean(0), atol=1e-5) and np.allclose(s["std"], x.std(0), atol=1e-5)
    rel = episodes.read_json(root, "relative_stats.json")["arm"]
    assert len(rel["mean"]) == 5 and all(a <= b for p, q in zip(rel["q01"], rel["q99"]) for a, b in zip(p, q))


def test_command_line(spark, tmp_path, capsys):
    import test_sources

    test_sources.write_bag(tmp_path / "bags" / "one", n=40)
    profile = tmp_path / "p.yaml"
    profile.write_text("""
name: small
minimum_frames: 5
streams:
  video.head: {topic: /cam, message_type: img, semantic: image, alignment: anchor}
  state.arm: {topic: /joint, message_type: js, semantic: joint, alignment: linear, max_gap_s: 0.05}
  action.arm: {topic: /pose, message_type: pose, semantic: pose, alignment: previous, max_age_s: 0.05, max_gap_s: 0.05}
""")
    bags = str(tmp_path / "bags")
    assert cli.main(["validate", str(profile), bags]) == 0
    assert json.loads(capsys.readouterr().out)["profile"] == "small"
    with pytest.raises(ValueError):
        cli.main(["validate", str(profile), bags, "--episodes", "7"])
    out = str(tmp_path / "out")
    assert cli.main(["convert", str(profile), bags, out]) == 0
    # The writer's first header time is zero, so the audit rejects the bag.
    assert json.loads(capsys.readouterr().out) == {"accepted": 0, "rejected": 1}
    assert cli.main(["summarize", f"{out}/quality/rejected.jsonl"]) == 0
    assert sum(json.loads(capsys.readouterr().out).values()) >= 1


def test_checks_of_metadata(spark):
    """The checks themselves, and the same by rows of a table."""
    info = lambda **more: {"chunks_size": 1000, "features": {"v": {"shape": [4], "info": {"video.fps": 30}}}, "modality": {"a": 1}} | more
    assert etl.incompatible(info(), info(features={"v": {"shape": [4], "info": {"video.fps": 15}}})) == []
    assert etl.incompatible(info(), info(features={"v": {"shape": [5]}}, modality={}, chunks_size=1)) == ["chunks_size", "features", "modality"]
    assert config.overlapping(["/a/b", "/a/bc", "/d", "/a/b/c", "/d/"]) == [("/a/b", "/a/b/c"), ("/d", "/d")]
    assert records.positional_names(["head", "wrist"], ["ego", "hand"]) == {"head": "ego", "wrist": "hand"}
    with pytest.raises(ValueError):
        records.positional_names(["head"], ["ego", "hand"])
    rows = spark.createDataFrame([(0, '{"n": 2}'), (1, '{"n": -1}'), (2, None), (3, "no json")], "i int, t string")

    def root(x):
        if x["n"] < 0:
            raise ValueError("below zero")
        return x["n"] * 2

    assert {r.i: r.found for r in records.judged(rows, "t", root).collect()} == {0: "4", 1: "error", 2: "error", 3: "error"}
    assert records.judged(rows.where("i > 9"), "t", root).count() == 0


def test_nested_paths(spark):
    rows = spark.createDataFrame([("/a/b",), ("/a/bc",), ("/a/b/c/d",), ("/a",), ("/d/",), ("/d",), (None,), ("",), ("/a/b",)], "p string")
    got = {tuple(r) for r in records.nested_paths(rows, "p").collect()}
    assert got == {("/a", "/a/b"), ("/a", "/a/bc"), ("/a", "/a/b/c/d"), ("/a/b", "/a/b/c/d")}


def test_checks_of_statistics_modalities_and_dimensions():
    full = {"a": {k: [0.0] * 4 for k in records.STATISTICS}}
    short = {"a": {k: v for k, v in full["a"].items() if k != "q01"}}
    assert records.complete_stats(full, ["a"], 4) and not records.complete_stats(full, ["a"], 3) and not records.complete_stats(short, ["a"])
    language = {"modality_keys": ["task"], "delta_indices": [0]}
    assert sorted(config.check_modality({"state": {}, "language": language, "sound": {}})) == ["language", "state"]
    for wrong in ({"state": {}}, {"language": language | {"delta_indices": [0, 1]}}):
        with pytest.raises(config.ConfigError):
            config.check_modality(wrong)
    assert vectors.dimensions({"arm": 7, "hand": 20}) == 27 and vectors.dimensions({"arm": 7, "hand": 20}, ["arm"]) == 34
