"""Bags, configuration, episode stores."""

import json
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F

from kinetrace.sources import bag, config, episodes


class Writer:
    """CDR, little-endian."""

    def __init__(self):
        self.data = bytearray(b"\0\1\0\0")

    def pack(self, code, size, value):
        self.data += b"\0" * (-(len(self.data) - 4) % size) + struct.pack("<" + code, value)
        return self

    def text(self, s):
        raw = s.encode() + b"\0"
        self.pack("I", 4, len(raw))
        self.data += raw
        return self

    def header(self, ns):
        return self.pack("i", 4, ns // 10**9).pack("I", 4, ns % 10**9).text("base")

    def doubles(self, xs, count=True):
        if count:
            self.pack("I", 4, len(xs))
        for x in xs:
            self.pack("d", 8, x)
        return self


def joint(ns, names, values):
    w = Writer().header(ns).pack("I", 4, len(names))
    for n in names:
        w.text(n)
    return bytes(w.doubles(values).doubles([]).doubles([]).data)


def image(ns, raw):
    w = Writer().header(ns).text("jpeg").pack("I", 4, len(raw))
    return bytes(w.data + raw)


def pose(ns, values):
    return bytes(Writer().header(ns).doubles(values, count=False).data)


TYPES = {"/joint": "sensor_msgs/msg/JointState", "/cam": "sensor_msgs/msg/CompressedImage", "/pose": "geometry_msgs/msg/PoseStamped"}


def write_bag(folder, n=5, zstd=False):
    folder.mkdir(parents=True)
    db = folder / "bag_0.db3"
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE topics (id INTEGER PRIMARY KEY, name TEXT, type TEXT, serialization_format TEXT)")
    con.execute("CREATE TABLE messages (id INTEGER PRIMARY KEY, topic_id INTEGER, timestamp INTEGER, data BLOB)")
    for i, (name, kind) in enumerate(TYPES.items()):
        con.execute("INSERT INTO topics VALUES (?, ?, ?, 'cdr')", (i, name, kind))
    for i in range(n):
        t = 10**9 + i * 10**7
        con.execute("INSERT INTO messages (topic_id, timestamp, data) VALUES (0, ?, ?)", (t + 1000, joint(t if i else 0, ["a", "bc"], [i, 0.5])))
        con.execute("INSERT INTO messages (topic_id, timestamp, data) VALUES (1, ?, ?)", (t + 2000, image(t, b"\xff\xd8" + bytes([i]))))
        con.execute("INSERT INTO messages (topic_id, timestamp, data) VALUES (2, ?, ?)", (t + 3000, pose(t, [0.1, 0.2, 0.3, 0, 0, 0, 1.0])))
    con.execute("INSERT INTO messages (topic_id, timestamp, data) VALUES (0, ?, ?)", (2 * 10**9, b"\0\1"))
    con.commit()
    con.close()
    name = db.name
    if zstd:
        import zstandard

        packed = folder / (name + ".zstd")
        packed.write_bytes(zstandard.ZstdCompressor().compress(db.read_bytes()))
        db.unlink()
        name = packed.name
    topics = "".join(f"    - topic_metadata: {{name: {k}, type: {v}}}\n      message_count: {n}\n" for k, v in TYPES.items())
    (folder / "metadata.yaml").write_text(f"rosbag2_bagfile_information:\n  storage_identifier: sqlite3\n  relative_file_paths: [{name}]\n  topics_with_message_count:\n{topics}")


@pytest.fixture(scope="module")
def root(tmp_path_factory):
    root = tmp_path_factory.mktemp("bags")
    write_bag(root / "b" / "two")
    write_bag(root / "a", zstd=True)
    return root


def test_bag_scan(spark, root):
    df = bag.read(spark, str(root))
    rows = df.orderBy("bag", "topic", "sequence").collect()
    assert len(rows) == 32 and len({r.bag for r in rows}) == 2
    joints = [r for r in rows if r.topic == "/joint" and r.bag.endswith("a")]
    assert [r.sequence for r in joints] == list(range(6)) and joints[2]["values"] == [2, 0.5] and joints[2].names == ["a", "bc"]
    assert joints[0].t == joints[0].bag_time_ns and joints[1].t == joints[1].header_time_ns
    assert joints[5].error is not None and joints[5].header_time_ns is None
    assert next(r for r in rows if r.topic == "/cam").image[:2] == b"\xff\xd8"
    assert next(r for r in rows if r.topic == "/pose")["values"] == [0.1, 0.2, 0.3, 0, 0, 0, 1]
    assert bag.read(spark, str(root), ["/cam"]).count() == 10
    assert bag.read(spark, str(root), ["/joint"], "bag").where("t != bag_time_ns").count() == 0
    times = bag.topic_times(spark, str(root), "/cam").agg(F.min("seconds").alias("s")).first()
    assert abs(times.s - 1e-6) < 1e-12


def test_topic_filter_reaches_the_reader(root):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In

    r = bag.BagReader(str(root), dict(bag.ADAPTERS))
    left = list(r.pushFilters([EqualTo(("topic",), "/cam"), GreaterThan(("sequence",), 1), In(("topic",), ("/cam", "/pose"))]))
    assert len(left) == 1 and r.topics == ["/cam"]
    assert len(r.partitions()) == 2 and all(x[1] == "/cam" for x in r.read(r.partitions()[0]))


def test_roster_and_metadata(spark, root, tmp_path):
    got = bag.roster(spark, [{"task": "t", "roots": [str(root / "b"), str(root / "a")]}]).collect()
    assert [(r.roster_index, r.bag.rsplit("/", 1)[1]) for r in got] == [(0, "two"), (1, "a")]
    with pytest.raises(config.ConfigError):
        bag.roster(spark, [{"task": "t", "roots": [str(root), str(root / "a")]}])
    bad = tmp_path / "bad"
    bad.mkdir()
    (bad / "metadata.yaml").write_text("rosbag2_bagfile_information:\n  storage_identifier: csv\n  relative_file_paths: []\n  topics_with_message_count: []\n")
    with pytest.raises(config.ConfigError):
        bag.bag_metadata(bad)


PROFILE = """
name: base
fps: 30
streams:
  video.head: {topic: /head, message_type: img, semantic: image, alignment: anchor}
  state.arm: {topic: /arm, message_type: js, semantic: joint, alignment: linear, max_gap_s: 0.05}
"""


def test_profiles(tmp_path):
    (tmp_path / "base.yaml").write_text(PROFILE)
    (tmp_path / "child.yaml").write_text("extends: base.yaml\nname: child\nstream_overrides:\n  state.arm: {max_gap_s: 0.1}\n")
    base, child = (config.load_profile(tmp_path / f"{n}.yaml") for n in ("base", "child"))
    assert child.name == "child" and child.of("linear")[0].max_gap_s == 0.1 and base.of("linear")[0].max_gap_s == 0.05
    assert base.sha256 != child.sha256 and len(base.sha256) == 64
    bad = {
        "dup": PROFILE + "name: again\n",
        "unknown": PROFILE + "colour: red\n",
        "missing": "name: x\n",
        "two": PROFILE.replace("alignment: linear", "alignment: anchor"),
        "semantic": PROFILE.replace("semantic: joint", "semantic: smell"),
        "topic": PROFILE.replace("/arm", "/head"),
        "cycle": "extends: cycle.yaml\nname: x\n",
        "override": "extends: base.yaml\nname: x\nstream_overrides:\n  state.leg: {max_gap_s: 1}\n",
    }
    for name, text in bad.items():
        (tmp_path / f"{name}.yaml").write_text(text)
        with pytest.raises(config.ConfigError):
            config.load_profile(tmp_path / f"{name}.yaml")


def test_other_configuration():
    good = {"version": 1, "tasks": [{"name": "a", "instruction": "do", "bags": []}]}
    assert config.load_tasks(json.dumps(good))[0]["name"] == "a"
    for bad in ({**good, "version": 2}, {"version": 1, "tasks": good["tasks"] * 2}, {"version": 1, "tasks": [{"name": " ", "instruction": "x", "bags": []}]}):
        with pytest.raises(config.ConfigError):
            config.load_tasks(json.dumps(bad))
    assert config.overlapping(["/a", "/a/b", "/c"]) == [("/a", "/a/b")]
    lang = {"language": {"modality_keys": ["task"], "delta_indices": [0]}, "smell": {}}
    assert list(config.check_modality(lang)) == ["language"]
    for bad in ({}, {"language": {"modality_keys": [], "delta_indices": [0]}}, {"language": {"modality_keys": ["t"], "delta_indices": [1]}}):
        with pytest.raises(config.ConfigError):
            config.check_modality(bad)


def test_episode_store(spark, tmp_path):
    rows = [([float(e), float(i)], [0.0], i / 30, i, e, 10 * e + i, 0, 0) for e in (0, 1, 1000) for i in range(3)]
    frames = spark.createDataFrame(rows, episodes.FRAMES_DDL)
    root = str(tmp_path / "out")
    episodes.write_frames(frames, root)
    assert episodes.rename_files(root) == 3
    assert (tmp_path / "out/data/chunk-001/episode_001000.parquet").exists()
    back = episodes.read_frames(spark, root, ["observation.state", "episode_index", "frame_index"], [0, 1000])
    assert sorted((r.episode_index, r.frame_index, r["observation.state"]) for r in back.collect()) == [(e, i, [e, i]) for e in (0, 1000) for i in range(3)]
    features = episodes.feature_table(["x", "y"], ["a"], {"video.head": (16, 24, 3)}, 30.0)
    eps = [{"episode_index": e, "tasks": ["t"], "length": 3} for e in range(3)]
    episodes.write_metadata(root, eps, [{"task_index": 0, "task": "t"}], features, {}, 30.0, {"made": "here"})
    info = episodes.read_json(root, "info.json")
    assert info["total_frames"] == 9 and set(episodes.float_features(info)) == {"observation.state", "action", "timestamp"}
    assert episodes.read_episodes(spark, root).count() == 3 and episodes.read_tasks(spark, root).first().task == "t"
    none = str(tmp_path / "none")
    episodes.write_metadata(none, [], [], features, {}, 30.0)
    assert not (tmp_path / "none/meta/info.json").exists()
    summary = episodes.write_quality(root, [{}], [], [{"reasons": ["b", "a"]}, {"reasons": ["a"]}])
    assert summary["reasons"] == {"a": 2, "b": 1}


def test_publish_is_all_or_nothing(tmp_path):
    def made(name, marker=True):
        (tmp_path / name / "meta").mkdir(parents=True)
        (tmp_path / name / "x").write_text(name)
        if marker:
            (tmp_path / name / episodes.MARKER).write_text("{}")
        return str(tmp_path / name)

    target, other = str(tmp_path / "target"), made("other", marker=False)
    episodes.publish({made("t1"): target})
    with pytest.raises(FileExistsError):
        episodes.publish({made("t2"): target})
    episodes.publish({str(tmp_path / "t2"): target}, overwrite=True)
    assert (tmp_path / "target/x").read_text() == "t2"
    with pytest.raises(FileExistsError):
        episodes.publish({made("t3"): other}, overwrite=True)
    with pytest.raises(OSError):
        episodes.publish({str(tmp_path / "t3"): target, str(tmp_path / "absent"): str(tmp_path / "new")}, overwrite=True)
    assert (tmp_path / "target/x").read_text() == "t2" and (tmp_path / "t3/x").exists()
    assert not list(tmp_path.glob("*.backup"))


def test_sidecars(tmp_path):
    (tmp_path / "s/videos/chunk-000/head").mkdir(parents=True)
    (tmp_path / "s/videos/chunk-000/head/episode_000003.mp4").write_bytes(b"v")
    assert episodes.copy_sidecars({3: 1002}, tmp_path / "s", tmp_path / "t") == 1
    assert (tmp_path / "t/videos/chunk-001/head/episode_001002.mp4").read_bytes() == b"v"
