"""Bags cut into blocks against the scan in one piece."""

import random
import sqlite3
import struct

import pytest
from pyspark.sql import functions as F
from test_sides import message, named, record
from test_sources import TYPES, joint, pose, write_bag

from kinetrace.sources import bag, bag_splits, mcap

COLUMNS = ["bag", "topic", "sequence", "bag_time_ns", "header_time_ns", "values", "names", "image", "error"]


def as_rows(df):
    return sorted(map(repr, df.select(COLUMNS).collect()))


def serial(*bags):
    from pyspark.sql import Row

    at = dict(zip(("bag", "topic", "message_type", "sequence", "header_time_ns", "bag_time_ns", "frame_id", "values", "names", "image", "image_format", "error"), range(12)))
    rows = [r for b in bags for r in bag.read_bag(b)]
    return sorted(repr(Row(**{c: r[at[c]] for c in COLUMNS})) for r in rows)


def metadata(folder, storage, files):
    topics = "".join(f"    - topic_metadata: {{name: {k}, type: {v}}}\n      message_count: 1\n" for k, v in TYPES.items())
    (folder / "metadata.yaml").write_text(f"rosbag2_bagfile_information:\n  storage_identifier: {storage}\n  relative_file_paths: [{', '.join(files)}]\n  topics_with_message_count:\n{topics}")


def write_stamps(db, stamps):
    """A SQLite file with joints and poses in turn, written in the order given; ids have gaps."""
    con = sqlite3.connect(db)
    con.execute("CREATE TABLE topics (id INTEGER PRIMARY KEY, name TEXT, type TEXT, serialization_format TEXT)")
    con.execute("CREATE TABLE messages (id INTEGER PRIMARY KEY, topic_id INTEGER, timestamp INTEGER, data BLOB)")
    con.executemany("INSERT INTO topics VALUES (?, ?, ?, 'cdr')", [(1, "/joint", TYPES["/joint"]), (2, "/pose", TYPES["/pose"])])
    for i, t in enumerate(stamps):
        con.execute("INSERT INTO messages VALUES (?, ?, ?, ?)", (3 * i + 7, 1 + i % 2, t, pose(t, [i] * 7) if i % 2 else joint(t, ["a"], [i])))
    con.commit()
    con.close()


def orders(n=240):
    live = [1000 * i for i in range(n)]
    for i in range(0, n - 7, 5):  # a little disorder, and ties across the blocks' ends
        live[i] = live[i + 7]
    mixed = list(live)
    random.Random(4).shuffle(mixed)
    return {"live": live, "mixed": mixed, "tied": [5] * n, "backwards": live[::-1]}


@pytest.mark.parametrize("order", ["live", "mixed", "tied", "backwards"])
def test_sqlite_blocks_equal_one_scan(spark, tmp_path, order):
    b = tmp_path / "bag"
    b.mkdir()
    stamps = orders()[order]
    write_stamps(b / "0.db3", stamps)
    write_stamps(b / "1.db3", [t + 500 for t in stamps[:40]])
    metadata(b, "sqlite3", ["0.db3", "1.db3"])
    split = -(-(b / "0.db3").stat().st_size // 9)
    df = bag_splits.scan(spark, str(tmp_path), None, split)
    assert as_rows(df) == serial(b)
    tasks = df.select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks == 2 if order == "tied" else tasks >= (4 if order == "live" else 2)
    only = bag_splits.scan(spark, str(tmp_path), ["/pose"], split)
    assert as_rows(only) == as_rows(df.where("topic = '/pose'")) and only.count() == 140


def test_read_takes_the_split_scan_for_large_files(spark, tmp_path):
    write_bag(tmp_path / "a", n=40)
    write_bag(tmp_path / "b", n=7, zstd=True)
    (tmp_path / "c").mkdir()
    write_stamps(tmp_path / "c" / "0.db3", [])
    metadata(tmp_path / "c", "sqlite3", ["0.db3"])
    df = bag.read(spark, str(tmp_path), split_bytes=4096)
    assert as_rows(df) == serial(tmp_path / "a", tmp_path / "b") == as_rows(bag.read(spark, str(tmp_path)))
    assert df.rdd.getNumPartitions() > 3
    assert as_rows(bag.read(spark, str(tmp_path), ["/cam"], "bag", 4096)) == as_rows(bag.read(spark, str(tmp_path), ["/cam"], "bag"))


def write_indexed(path, groups, loose=False, channels=True):
    """An mcap file whose summary names its chunks: one a group of times, each with a message index."""
    heads = b""
    for i, topic in enumerate(("/joint", "/pose"), 1):
        heads += record(0x03, struct.pack("<H", i) + named(TYPES[topic]) + named("ros2msg") + struct.pack("<I", 0))
        heads += record(0x04, struct.pack("<HH", i, i) + named(topic) + named("cdr") + struct.pack("<I", 0))
    out = mcap.MAGIC + record(0x01, named("ros2") + named("test"))
    indexes = b""
    for k, times in enumerate(groups):
        raw = (heads if k == 0 else b"") + b"".join(message(1 + t % 2, t, pose(t, [t] * 7) if t % 2 else joint(t, ["a"], [t])) for t in times)
        start = len(out)
        out += record(0x06, struct.pack("<QQQI", min(times), max(times), len(raw), 0) + named("") + struct.pack("<Q", len(raw)) + raw)
        length = len(out) - start
        index = record(0x07, struct.pack("<HI", 1, 0))
        out += index
        indexes += record(0x08, struct.pack("<QQQQ", min(times), max(times), start, length) + struct.pack("<IHQ", 10, 1, start + length) + struct.pack("<Q", len(index)) + named("") + struct.pack("<QQ", len(raw), len(raw)))
    if loose:
        out += message(2, 3, pose(3, [3.0] * 7))
    out += record(0x0F, bytes(4))
    at = len(out)
    out += (heads if channels else b"") + indexes + record(0x02, struct.pack("<QQI", at, 0, 0)) + mcap.MAGIC
    path.write_bytes(out)


@pytest.mark.parametrize("case", ["indexed", "loose", "nameless"])
def test_mcap_blocks_equal_one_scan(spark, tmp_path, case):
    b = tmp_path / "bag"
    b.mkdir()
    groups = [[10 * k + d for d in (0, 1, 4, 13, 4, 2)] for k in range(1, 30)]
    write_indexed(b / "0.mcap", groups, case == "loose", case != "nameless")
    metadata(b, "mcap", ["0.mcap"])
    found = mcap.summary(b / "0.mcap")
    assert (found is not None and len(found[1]) == 29) if case == "indexed" else found is None
    split = -(-(b / "0.mcap").stat().st_size // 8)
    df = bag_splits.scan(spark, str(tmp_path), None, split)
    assert as_rows(df) == serial(b) and df.count() == 29 * 6 + (case == "loose")
    assert (df.select(F.spark_partition_id()).distinct().count() >= 3) == (case == "indexed")
    assert as_rows(bag_splits.scan(spark, str(tmp_path), ["/pose"], split)) == as_rows(df.where("topic = '/pose'"))


def test_summaries_that_cannot_be_used(tmp_path):
    for k, raw in enumerate((b"", mcap.MAGIC * 2, mcap.MAGIC + record(0x02, bytes(20)) + mcap.MAGIC)):
        (tmp_path / str(k)).write_bytes(raw)
        assert mcap.summary(tmp_path / str(k)) is None
