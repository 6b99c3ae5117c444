"""mcap storage, video frames, side tables, processors, image transforms and reports."""

import json
import struct

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_sources import joint, pose, write_bag

from kinetrace.operators import images, processors
from kinetrace.plans import legacy
from kinetrace.sources import bag, config, episodes, mcap, sides, video


def record(op, body):
    return struct.pack("<BQ", op, len(body)) + body


def named(text):
    return struct.pack("<I", len(text)) + text.encode()


def message(channel, t, data):
    return record(0x05, struct.pack("<HIQQ", channel, 0, t, t) + data)


def write_mcap(path, compression="zstd"):
    """Two chunks whose times overlap, and a message outside of them."""
    import zstandard

    heads = b""
    for i, (topic, kind) in enumerate((("/joint", "sensor_msgs/msg/JointState"), ("/pose", "geometry_msgs/msg/PoseStamped")), 1):
        heads += record(0x03, struct.pack("<H", i) + named(kind) + named("ros2msg") + struct.pack("<I", 0))
        heads += record(0x04, struct.pack("<HH", i, i) + named(topic) + named("cdr") + struct.pack("<I", 0))
    parts = [heads + b"".join(message(1, t, joint(t, ["a"], [t / 10])) for t in (10, 30, 50)), b"".join(message(1 + t % 2, t, pose(t, [t] * 7) if t % 2 else joint(t, ["a"], [t / 10])) for t in (20, 25, 40))]
    out = mcap.MAGIC + record(0x01, named("ros2") + named("test"))
    for raw in parts:
        packed = zstandard.ZstdCompressor().compress(raw) if compression == "zstd" else raw
        out += record(0x06, struct.pack("<QQQI", 0, 0, len(raw), 0) + named(compression) + struct.pack("<Q", len(packed)) + packed)
    out += message(2, 5, pose(5, [5.0] * 7)) + record(0x02, bytes(20)) + mcap.MAGIC
    path.write_bytes(out)


@pytest.mark.parametrize("compression", ["zstd", ""])
def test_mcap_in_order_of_time(tmp_path, compression):
    write_mcap(tmp_path / "x.mcap", compression)
    rows = list(mcap.read(tmp_path / "x.mcap"))
    assert [(r[0], r[2]) for r in rows] == [("/pose", 5), ("/joint", 10), ("/joint", 20), ("/pose", 25), ("/joint", 30), ("/joint", 40), ("/joint", 50)]
    assert [r[2] for r in mcap.read(tmp_path / "x.mcap", ["/pose"])] == [5, 25]
    raw = (tmp_path / "x.mcap").read_bytes()
    for bad in (raw[:-60], b"nothing", raw.replace(b"zstd", b"zzzz") if compression else raw[:40]):
        (tmp_path / "bad.mcap").write_bytes(bad)
        with pytest.raises((ValueError, struct.error)):
            if list(mcap.read(tmp_path / "bad.mcap")) != rows:
                raise ValueError("rows are missing")


def test_mcap_bags_beside_others(spark, tmp_path):
    write_bag(tmp_path / "a")
    b = tmp_path / "b"
    b.mkdir()
    write_mcap(b / "b_0.mcap")
    (b / "metadata.yaml").write_text("rosbag2_bagfile_information:\n  storage_identifier: mcap\n  relative_file_paths: [b_0.mcap]\n  topics_with_message_count:\n    - topic_metadata: {name: /joint, type: sensor_msgs/msg/JointState}\n      message_count: 5\n")
    rows = bag.read(spark, str(tmp_path)).where("bag like '%/b'").orderBy("bag_time_ns").collect()
    assert len(rows) == 7 and [r.sequence for r in rows if r.topic == "/joint"] == [0, 1, 2, 3, 4]
    assert next(r for r in rows if r.bag_time_ns == 20)["values"] == [2.0] and rows[0]["values"] == [5.0] * 7
    assert bag.read(spark, str(tmp_path), ["/joint"]).count() == 11
    assert bag.backend_of(b / "b_0.mcap", "sqlite3") == "mcap"


def test_video_frames(spark, tmp_path):
    stream = b"".join(b"\xff\xd8" + bytes([i]) + b"\xff\xd9" for i in range(3))
    assert [x[2] for x in video.jpeg_frames(stream)] == [0, 1, 2]
    with pytest.raises(video.VideoError):
        list(video.jpeg_frames(stream[:-1]))
    (tmp_path / "v.mp4").write_bytes(stream)
    frames = video.read_frames(spark, str(tmp_path), decoder=lambda raw: list(video.jpeg_frames(raw)))
    name = frames.first().video
    asks = spark.createDataFrame([(name, 0.1), (name, 0.2)], "video string, seconds double")
    assert [r.image[2] for r in video.at_times(frames, asks, 10.0).orderBy("seconds").collect()] == [1, 2]
    with pytest.raises(Exception, match="no frame at 0.15"):
        video.at_times(frames, spark.createDataFrame([(name, 0.15)], "video string, seconds double"), 10.0).collect()
    written = video.write_videos(frames.withColumn("video", F.lit("w")), f"{tmp_path}/{{video}}.out", 10.0, encoder=lambda images, fps, target: open(target, "wb").write(b"".join(images)))
    assert written.first().n_frames == 3 and (tmp_path / "w.out").read_bytes() == stream
    assert video.parsed_probe('{"streams": [{"nb_frames": "7", "avg_frame_rate": "30000/1001"}]}') == (7, 30000 / 1001)
    with pytest.raises(video.VideoError):
        video.parsed_probe('{"streams": []}')
    with pytest.raises(video.VideoError, match="isn't installed"):
        video.resolve_backend("ffmpeg", {"ffmpeg": False})
    assert video.resolve_backend(None, {"a": False, "b": True}) == "b"


def test_hdf5_interface(spark, tmp_path):
    (tmp_path / "e.hdf5").write_bytes(b"x")
    opener = lambda raw: {"observations/qpos": np.arange(6).reshape(3, 2), "action": np.ones((3, 1))}
    rows = sides.read_hdf5_episodes(spark, str(tmp_path), opener=opener).orderBy("frame_index").collect()
    assert [(r.frame_index, r.qpos, r.action, r.ee_pose) for r in rows] == [(0, [0, 1], [1], None), (1, [2, 3], [1], None), (2, [4, 5], [1], None)]
    with pytest.raises(Exception, match="rows"):
        sides.read_hdf5_episodes(spark, str(tmp_path), opener=lambda raw: {"action": np.ones((3, 1)), "observations/qpos": np.ones((2, 1))}).collect()


@pytest.fixture
def doubled():
    """Made here so that workers, which can't import the tests, get its code."""

    class Doubled(processors.Processor):
        schema = "k long, x double"

        def process(self, batch):
            by = self.statistics["by"] if self.training else 1
            return batch.assign(x=batch["x"] * by)

        def decode(self, batch):
            return batch.assign(x=batch["x"] / self.statistics["by"])

    return Doubled()


def test_processors(spark, doubled):
    df = spark.createDataFrame([(1, 2.0), (2, 5.0)], "k long, x double")
    p = doubled.set_statistics({"by": 2})
    assert sorted(r.x for r in p.apply(df).collect()) == [4, 10]
    assert sorted(r.x for r in p.apply_decode(p.apply(df), p.schema).collect()) == [2, 5]
    assert sorted(r.x for r in p.train(False).apply(df).collect()) == [2, 5]
    with pytest.raises(ValueError):
        p.set_statistics({"by": 3})
    with pytest.raises(TypeError):
        processors.Processor()


def test_modalities(tmp_path):
    m = processors.Modalities()
    m.register("Arm", {"language": {"modality_keys": ["t"], "delta_indices": [0]}, "action": {"delta_indices": [0, 1, 2]}})
    assert m.horizon("arm") == 3
    (tmp_path / "m.yaml").write_text("hand:\n  language: {modality_keys: [t], delta_indices: [0]}\n")
    m.register_file(tmp_path / "m.yaml")
    assert sorted(m.known) == ["arm", "hand"]
    for bad in (lambda: m.register("ARM", {}), lambda: m.register("x", {"state": {}}), lambda: m.of("none")):
        with pytest.raises(config.ConfigError):
            bad()


def test_image_transforms_share_a_seed(spark):
    v = np.random.default_rng(0).integers(0, 255, (6, 8, 3))
    rows = [(w, seed, v.astype(float).ravel().tolist(), [6, 8, 3]) for w, seed in (("a", 1), ("b", 1), ("c", 2))]
    df = spark.createDataFrame(rows, "view string, seed long, values array<double>, shape array<int>")
    out = {r.view: r for r in images.transformed(df, [("random_crop", {"share": 0.5}), ("jitter", {"brightness": 0.3}), ("resize", {"height": 4, "width": 4})]).collect()}
    assert out["a"]["values"] == out["b"]["values"] != out["c"]["values"] and out["a"]["shape"] == [4, 4, 3]
    with pytest.raises(ValueError, match="unknown"):
        images.transformed(df, [("sharpen", {})])


def test_reports(spark, tmp_path):
    summary = episodes.write_roster(tmp_path / "audit", [{"index": 0}], [{"status": "PASS"}, {"status": "REJECT", "reasons": ["x", "y"]}])
    assert summary == {"episode_count": 2, "pass_count": 1, "reject_count": 1, "reject_reasons": {"x": 1, "y": 1}}
    assert len((tmp_path / "audit" / "rejected_episodes.jsonl").read_text().splitlines()) == 1
    q = spark.createDataFrame([(1, 40, 0.01, 0.015, 0.02, 0.5, []), (2, 10, 0.01, 0.02, 0.09, 0.0, ["skew"])], "episode int, n long, mean_skew double, p90_skew double, max_skew double, mean_velocity double, reasons array<string>")
    legacy.write_report(q, str(tmp_path / "quality.json"))
    data = json.loads((tmp_path / "quality.json").read_text())
    assert data["summary"]["failed"] == 1 and [e["episode"] for e in data["episodes"]] == [1, 2]
    assert "2 episodes, 1 failed" in (tmp_path / "quality.txt").read_text()


def test_legacy_p90(spark):
    rows = [(1, i, "s", i, None, float(i)) for i in range(11)]
    q = legacy.quality(spark.createDataFrame(rows, "episode int, frame_index long, stream string, t long, v array<double>, skew double"), 1e9, 5.0).first()
    assert (q.p90_skew, q.mean_skew, q.max_skew, q.reasons) == (9.0, 5.0, 10.0, ["skew", "too_short", "no_motion"])


def test_pose_interpolation_against_numpy(spark):
    from kinetrace.operators import asof

    rng = np.random.default_rng(5)
    q = rng.normal(size=(2, 4))
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    p = rng.normal(size=(2, 3))
    source = spark.createDataFrame([(1, t, [*map(float, p[i]), *map(float, q[i])]) for i, t in enumerate((0, 10))], "k int, t long, v array<double>")
    anchors = spark.createDataFrame([(1, t) for t in (-1, 0, 3, 10, 11)], "k int, t long")
    got = {r.t: r for r in asof.pose(anchors, source, ["k"]).collect()}
    assert got[-1].v is None and got[11].v is None and got[0].gap == got[10].gap == 0 and got[3].gap == 10
    a, b = q
    d = a @ b
    b, d = (b, d) if d >= 0 else (-b, -d)
    th = np.arccos(d)
    x, y, z, w = (np.sin(0.7 * th) * a + np.sin(0.3 * th) * b) / np.sin(th)
    rows = [1 - 2 * (y * y + z * z), 2 * (x * y - z * w), 2 * (x * z + y * w), 2 * (x * y + z * w), 1 - 2 * (x * x + z * z), 2 * (y * z - x * w)]
    assert np.allclose(got[3].v, [*(0.7 * p[0] + 0.3 * p[1]), *rows], atol=1e-9)

