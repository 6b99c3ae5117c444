"""The conversion of synthetic bags against known results."""

import math

import pytest
from pyspark.sql import functions as F

from kinetrace.plans.convert import Settings, convert
from kinetrace.sources.config import Profile, Stream

EPOCH = 1_700_000_000_000_000_000
SIDES = ("left", "right")


def profile():
    out = [Stream("video.head", "/head", "img", "image", "anchor", 30, max_gap_s=0.1)]
    for s in SIDES:
        out.append(Stream(f"video.{s}_wrist", f"/{s}_wrist", "img", "image", "nearest", 30, max_gap_s=0.1, soft_skew_s=0.02, hard_skew_s=0.04))
        for kind, hz, n, lim, sem, al in (("arm_joint", 250, 7, 6.4, "joint", "linear"), ("hand_joint", 200, 20, 3.2, "joint", "linear"), ("eef", 250, 7, 10.0, "pose", "pose")):
            out.append(Stream(f"state.{s}_{kind}", f"/s/{s}/{kind}", "x", sem, al, hz, max_gap_s=0.05, low=-lim, high=lim, filter_hz=10.0))
            out.append(Stream(f"action.{s}_{kind}", f"/a/{s}/{kind}", "x", sem, "previous", hz, max_gap_s=0.05, max_age_s=0.05, low=-lim, high=lim))
    return Profile("synthetic", tuple(out))


JOINT = Settings(
    state=tuple(f"state.{s}_{k}" for k in ("arm_joint", "hand_joint") for s in SIDES),
    action=tuple(f"action.{s}_{k}" for k in ("arm_joint", "hand_joint") for s in SIDES),
    activity=tuple(f"state.{s}_{k}" for k in ("eef", "hand_joint") for s in SIDES),
    padding_s=0.2,
)
EEF = Settings(
    state=tuple(f"state.{s}_{k}" for k in ("eef", "hand_joint") for s in SIDES),
    action=tuple(f"action.{s}_{k}" for k in ("eef", "hand_joint") for s in SIDES),
    activity=JOINT.activity,
    padding_s=0.2,
)


def bag(episode, fault=None):
    rows = []
    for s in profile().streams:
        if fault == "missing_topic" and s.key == "video.right_wrist":
            continue
        seq = 0
        for i in range(int(1.6 * s.hz) + 1):
            rel = round(i / s.hz * 1e9)
            if fault == "active_gap" and s.key == "state.left_arm_joint" and 0.65e9 <= rel <= 0.85e9:
                continue
            value = 0.0 if fault == "stationary" else math.sin(2 * math.pi * rel / 1e9)
            n = 20 if "hand" in s.key else 7
            v = None if s.semantic == "image" else [0.2 + 0.1 * value, 0.0, 0.8, 0.0, 0.0, 0.0, 1.0] if s.semantic == "pose" else [value] * n
            t = EPOCH + rel
            if fault == "zero_header" and s.key == "state.left_hand_joint" and i == 1:
                t = 0
            if fault == "duplicate_header" and s.key == "state.left_hand_joint" and i == 2:
                t = EPOCH + round(1 / s.hz * 1e9)
            rows.append((episode, s.key, seq, t, EPOCH + rel + 1_000_000, v, not (fault == "corrupt_jpeg" and s.key == "video.head" and i == 5)))
            seq += 1
    return rows


FAULTS = {0: None, 1: "missing_topic", 2: "zero_header", 3: "duplicate_header", 4: "corrupt_jpeg", 5: "active_gap", 6: "stationary"}


@pytest.fixture(scope="module")
def messages(spark):
    rows = [r for e, f in FAULTS.items() for r in bag(e, f)]
    return spark.createDataFrame(rows, "episode int, stream string, seq long, t long, bag_t long, v array<double>, decoded boolean").cache()


def test_golden_joint_episode_and_faults(messages):
    out = convert(messages, profile(), JOINT)
    got = {r.episode: r for r in out["gates"].collect()}
    assert (got[0].status, got[0].frames) == ("PASS", 47)
    assert {e: got[e].reason for e in range(1, 7)} == {1: "missing_required_topic", 2: "non_monotonic_header_timestamp", 3: "non_monotonic_header_timestamp", 4: "camera_decode_failure", 5: "raw_gap_exceeded", 6: "no_valid_motion"}
    raw = {r.episode: r for r in out["audit"].collect()}
    assert raw[2].reasons == ["non_monotonic_header_timestamp", "zero_header_timestamp"]
    frames = sorted(out["frames"].collect(), key=lambda r: r.frame_index)
    assert len(frames) == 47 and frames[-1].frame_index == 46 and abs(frames[-1].timestamp - 1.533333) < 1e-5
    assert len(frames[0].state) == 54 and len(frames[0].action) == 54
    assert abs(frames[0].state[0] - 0.21018) < 5e-4 and abs(frames[0].action[0] - 0.19971) < 1e-5
    assert all(r.age >= 0 for r in frames)


def test_eef_space_has_58_dimensions(messages):
    out = convert(messages.where("episode = 0"), profile(), EEF)
    row = out["frames"].where(F.col("frame_index") == 3).first()
    assert len(row.state) == 58 and [round(x, 6) for x in row.state[3:9]] == [1, 0, 0, 0, 1, 0]


def test_results_do_not_depend_on_partitions(spark, messages):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    rows = []
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        out = convert(messages.where("episode = 0"), profile(), JOINT)["frames"]
        rows.append(sorted((r.frame_index, tuple(round(x, 9) for x in r.state)) for r in out.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", old)
    assert rows[0] == rows[1]
