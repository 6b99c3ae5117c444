"""The conversion of raw messages to aligned episodes, and the gates on its way.

Everything is in long form, keyed by episode: (episode, stream, seq, t, bag_t, v), t in nanoseconds.
Streams of one alignment are aligned together, so the number of joins doesn't grow with the streams.
The first failing gate gives an episode's reason; the raw audit gives all of its reasons.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.rotations import quat_unit, quat_valid
from ..functions.scalars import NS, logical_time, to_ns
from ..functions.vectors import finite, in_range, part
from ..operators import asof, audit, sequences, signal
from ..session import staged
from ..sources.config import Profile, Stream

BY = ["episode"]


@dataclass(frozen=True)
class Settings:
    """What a conversion chooses beyond its profile."""

    state: tuple[str, ...]
    action: tuple[str, ...]
    activity: tuple[str, ...]
    pose_threshold: float = 0.05
    joint_threshold: float = 0.5
    window_s: float = 0.5
    padding_s: float = 0.5
    minimum_frames: int = 30
    fps: float = 30.0
    filter_order: int = 4


def by_stream(streams: list[Stream], value) -> Column:
    """A value of each stream as a column, by the stream's key."""
    out = F.lit(None)
    for s in streams:
        got = value(s)
        if got is not None:
            out = F.when(F.col("stream") == s.key, F.lit(got)).otherwise(out)
    return out


def of(df: DataFrame, keys) -> DataFrame:
    return df.where(F.col("stream").isin(list(keys)))


def raw_audit(messages: DataFrame, profile: Profile) -> DataFrame:
    """(episode, status, reasons, warnings): all reasons of all streams."""
    keys = [s.key for s in profile.streams]
    rows = of(messages, keys)
    key = [*BY, "stream"]
    each = audit.stream_audit(rows, key, NS, 1 << 62, bag_t="bag_t")
    poses = [s.key for s in profile.streams if s.semantic == "pose"]
    numeric = [s.key for s in profile.streams if s.semantic != "image"]
    bad_value = F.col("stream").isin(numeric) & ~F.coalesce(finite("v"), F.lit(False))
    bad_norm = F.col("stream").isin(poses) & ~quat_valid(part("v", 3, 7))
    bad_image = F.lit(False) if "decoded" not in messages.columns else ~F.coalesce("decoded", F.lit(True))
    faults = rows.groupBy(*key).agg(F.count_if(bad_value).alias("bad_value"), F.count_if(~bad_value & bad_norm).alias("bad_norm"), F.count_if(bad_image).alias("bad_image"))
    steps = audit.with_steps(rows, key).withColumn("limit", by_stream(list(profile.streams), lambda s: to_ns(s.max_gap_s) if s.max_gap_s else None).cast("long"))
    gaps = steps.groupBy(*key).agg(F.count_if(F.col("dt") > F.col("limit")).alias("n_gap"))
    found = each.join(faults, key).join(gaps, key)
    reasons = F.array(
        F.when(F.col("n_zero") > 0, audit.ZERO_TIME),
        F.when(F.col("n_duplicate") + F.col("n_backward") > 0, audit.NOT_MONOTONIC),
        F.when(F.col("bad_value") > 0, audit.NOT_FINITE),
        F.when(F.col("bad_norm") > 0, audit.QUATERNION_NORM),
        F.when(F.col("bad_image") > 0, audit.DECODE_FAILURE),
    )
    found = found.withColumn("reason", F.explode_outer(F.array_compact(reasons)))
    per = found.groupBy(*BY).agg(F.collect_set("reason").alias("r"), F.count_distinct("stream").alias("n"), F.bool_or(F.col("n_gap") > 0).alias("gap"))
    missing = F.when(F.col("n") < len(keys), F.array(F.lit(audit.MISSING_TOPIC))).otherwise(F.array().cast("array<string>"))
    per = per.select(*BY, F.array_sort(F.array_distinct(F.concat("r", missing))).alias("reasons"), F.when(F.col("gap"), F.array(F.lit(audit.GAP))).otherwise(F.array().cast("array<string>")).alias("warnings"))
    return per.select(*BY, F.when(F.size("reasons") > 0, "REJECT").when(F.size("warnings") > 0, "PASS_WITH_WARNING").otherwise("PASS").alias("status"), "reasons", "warnings")


def canonical(messages: DataFrame, profile: Profile) -> DataFrame:
    """Poses with unit quaternions whose signs follow one another; other values as they are."""
    poses = [s.key for s in profile.streams if s.semantic == "pose"]
    p = of(messages, poses).withColumn("q", quat_unit(part("v", 3, 7)))
    p = sequences.sign_continuous(p, [*BY, "stream"], ["t", "seq"], "q", "q")
    p = p.withColumn("v", F.concat(part("v", 0, 3), "q")).drop("q")
    return messages.where(~F.col("stream").isin(poses)).unionByName(p.select(*messages.columns))


def activity(samples: DataFrame, profile: Profile, settings: Settings) -> DataFrame:
    """Active and padded bounds per episode."""
    kind = {s.key: s.semantic for s in profile.streams}
    key = [*BY, "stream"]
    rows = of(samples, settings.activity).select(*key, "t", "v")
    joint = sequences.speed(of(rows, [k for k in settings.activity if kind[k] == "joint"]), key, "t", "v", float(NS), vector=True)
    poses = of(rows, [k for k in settings.activity if kind[k] == "pose"]).withColumn("v", part("v", 0, 3))
    pose = sequences.speed(poses, key, "t", "v", float(NS), vector=True, l2=True)
    both = joint.withColumn("limit", F.lit(settings.joint_threshold)).unionByName(pose.withColumn("limit", F.lit(settings.pose_threshold)))
    return sequences.activity_interval(both, asof.common_window(rows, BY), BY, "limit", to_ns(settings.window_s), to_ns(settings.padding_s))


def smoothed(samples: DataFrame, bounds: DataFrame, profile: Profile, settings: Settings) -> DataFrame:
    """State streams within the padded bounds, low-pass filtered; of poses the translation only."""
    states = [s for s in profile.streams if s.key in settings.state]
    rows = of(samples, settings.state).join(bounds.select(*BY, "padded_start", "padded_stop"), BY)
    rows = rows.where("t >= padded_start and t <= padded_stop").select(*BY, "stream", "t", "v")
    poses = [s.key for s in states if s.semantic == "pose"]
    move = rows.withColumn("v", F.when(F.col("stream").isin(poses), part("v", 0, 3)).otherwise(F.col("v"))) if poses else rows
    plain = [s.key for s in states if not s.filter_hz]
    cutoffs = {s.filter_hz for s in states if s.filter_hz}
    out = of(move, plain).withColumn("filter_error", F.lit(None).cast("string"))
    for c in sorted(cutoffs):
        out = out.unionByName(signal.filtered(of(move, [s.key for s in states if s.filter_hz == c]), [*BY, "stream"], "t", "v", float(NS), c, settings.filter_order))
    if not poses:
        return out
    turn = of(rows, poses).select(*BY, "stream", "t", part("v", 3, 7).alias("q"))
    return out.join(turn, [*BY, "stream", "t"], "left").withColumn("v", F.when(F.col("q").isNotNull(), F.concat("v", "q")).otherwise(F.col("v"))).drop("q")


def anchors(samples: DataFrame, bounds: DataFrame, profile: Profile, settings: Settings) -> DataFrame:
    """Anchor frames (episode, frame_index, t) inside the active bounds and every needed stream."""
    wrists = profile.of("nearest")
    needed = [*settings.state, *settings.action, *(s.key for s in wrists)]
    slack = {s.key: to_ns(s.hard_skew_s) for s in wrists if s.hard_skew_s}
    window = asof.common_window(of(samples, needed), BY, start_only=settings.action, slack=slack).where(F.col("n_streams") == len(needed))
    window = window.join(bounds, BY).select(*BY, F.greatest("start", "active_start").alias("start"), F.least("stop", "active_stop").alias("stop"))
    head = of(samples, [profile.of("anchor")[0].key]).select(*BY, "t")
    rows = asof.within(head, window, BY)
    return rows.withColumn("frame_index", (F.row_number().over(W.partitionBy(*BY).orderBy("t")) - 1).cast("long"))


def spread(frames: DataFrame, keys) -> DataFrame:
    return frames.withColumn("stream", F.explode(F.array(*[F.lit(k) for k in keys])))


def aligned(samples: DataFrame, states: DataFrame, frames: DataFrame, profile: Profile, settings: Settings) -> DataFrame:
    """(episode, frame_index, t, stream, v, age, gap, skew) in long form: one row per frame and stream."""
    kind = {s.key: s for s in profile.streams}
    key = [*BY, "stream"]
    cols = [*BY, "frame_index", "t", "stream"]
    none = lambda t: F.lit(None).cast(t)
    joints = [k for k in settings.state if kind[k].alignment == "linear"]
    poses = [k for k in settings.state if kind[k].alignment == "pose"]
    out = asof.linear(spread(frames, joints), of(states, joints).select(*key, "t", "v"), key, vector=True).select(*cols, "v", none("long").alias("age"), "gap", none("long").alias("skew"))
    if poses:
        p = asof.pose(spread(frames, poses), of(states, poses).select(*key, "t", "v"), key)
        out = out.unionByName(p.select(*cols, "v", none("long").alias("age"), "gap", none("long").alias("skew")))
    a = asof.backward(spread(frames, settings.action), of(samples, settings.action).select(*key, "t", "v"), key)
    out = out.unionByName(a.select(*cols, F.col("src.v").alias("v"), (F.col("t") - F.col("src.t")).alias("age"), none("long").alias("gap"), none("long").alias("skew")))
    wrists = [s.key for s in profile.of("nearest")]
    if wrists:
        n = asof.nearest(spread(frames, wrists), of(samples, wrists).select(*key, "t"), key)
        out = out.unionByName(n.select(*cols, none("array<double>").alias("v"), none("long").alias("age"), none("long").alias("gap"), (F.col("src.t") - F.col("t")).alias("skew")))
    return out


def gates(rows: DataFrame, profile: Profile, settings: Settings) -> DataFrame:
    """(episode, frames, reason, warning): the first gate an episode fails, by the gates' order."""
    ns = lambda x: to_ns(x) if x else None
    table = [(s.key, s.key in settings.state, s.key in settings.action, ns(s.max_gap_s), ns(s.max_age_s), s.low, s.high) for s in profile.streams]
    limits = rows.sparkSession.createDataFrame(table, "stream string, is_state boolean, is_action boolean, max_gap long, max_age long, lo double, hi double")
    x = rows.join(F.broadcast(limits), "stream")  # one row per stream of the profile
    state, action = F.col("is_state"), F.col("is_action")
    rules = (
        (audit.OUT_OF_RANGE, state & F.col("v").isNull()),
        (audit.BRACKET_GAP, state & (F.col("gap") > F.col("max_gap"))),
        (audit.NO_HISTORY, action & F.col("v").isNull()),
        (audit.FUTURE_ACTION, action & (F.col("age") < 0)),
        (audit.ACTION_AGE, action & (F.col("age") > F.col("max_age"))),
    )
    late = ((audit.VALUE_RANGE, F.col("v").isNotNull() & F.exists("v", lambda e: (e < F.col("lo")) | (e > F.col("hi")))),)
    hit = lambda rs: F.coalesce(*[F.when(F.bool_or(F.coalesce(bad, F.lit(False))), name) for name, bad in rs])
    out = x.groupBy(*BY).agg(F.count_distinct("frame_index").alias("frames"), hit(rules).alias("first"), hit(late).alias("last"))
    skew, warning = F.lit(None).cast("string"), F.lit(None).cast("string")
    for s in profile.of("nearest"):
        if not (s.soft_skew_s and s.hard_skew_s):
            continue
        g = audit.skew_gate(of(rows, [s.key]), BY, ["frame_index"], "skew", to_ns(s.soft_skew_s), to_ns(s.hard_skew_s), s.max_consecutive, s.max_ratio)
        name = s.key.replace(".", "_")
        out = out.join(g.select(*BY, F.col("reason").alias(f"r_{name}"), F.col("warning").alias(f"w_{name}")), BY, "left")
        skew, warning = F.coalesce(skew, F.col(f"r_{name}")), F.coalesce(warning, F.col(f"w_{name}"))
    short = F.when(F.col("frames") < settings.minimum_frames, audit.TOO_SHORT)
    return out.select(*BY, "frames", F.coalesce(short, "first", skew, "last").alias("reason"), warning.alias("warning"))


def vectors(rows: DataFrame, settings: Settings) -> DataFrame:
    """Frames with their state and action vectors, groups in the settings' order."""

    def one(keys) -> Column:
        order = by_position(keys)
        got = F.array_sort(F.collect_list(F.when(F.col("stream").isin(list(keys)), F.struct(order.alias("k"), "v"))))
        return F.flatten(F.transform(got, lambda x: x["v"]))

    out = rows.groupBy(*BY, "frame_index", "t").agg(one(settings.state).alias("state"), one(settings.action).alias("action"), F.max("age").alias("age"))
    return out.withColumn("timestamp", logical_time("frame_index", settings.fps))


def by_position(keys) -> Column:
    out = F.lit(None).cast("int")
    for i, k in enumerate(keys):
        out = F.when(F.col("stream") == k, i).otherwise(out)
    return out


def convert(messages: DataFrame, profile: Profile, settings: Settings) -> dict[str, DataFrame]:
    """{audit, activity, gates, frames, aligned}: frames of accepted episodes, and what was decided
    about all. Each step is staged in the shared folder: a lineage from messages to frames would hold
    the plan of every earlier step once for each of its uses."""
    columns = [c for c in messages.columns if c in (*BY, "stream", "seq", "t", "bag_t", "v", "decoded")]
    messages = messages.select(*columns)
    report = staged(raw_audit(messages, profile), "audit")
    good = messages.join(report.where("status != 'REJECT'").select(*BY), BY, "left_semi")
    samples = staged(canonical(good, profile), "samples")
    bounds = staged(activity(samples, profile, settings), "activity")
    limit = by_stream(list(profile.streams), lambda s: to_ns(s.max_gap_s) if s.max_gap_s and s.semantic != "image" else None).cast("long")
    gaps = audit.gaps_in_interval(samples, bounds.select(*BY, F.col("active_start").alias("start"), F.col("active_stop").alias("stop")), [*BY, "stream"], "t", 0)
    holes = gaps.withColumn("limit", limit).where(F.col("gap_stop") - F.col("gap_start") > F.col("limit")).select(*BY).distinct()
    holes = staged(holes, "holes")
    whole = bounds.join(holes, BY, "left_anti")
    states = staged(smoothed(samples, whole, profile, settings), "states")
    frames = staged(anchors(samples, whole, profile, settings), "anchors")
    rows = staged(aligned(samples, states, frames, profile, settings), "aligned")
    decided = gates(rows, profile, settings)
    everyone = report.select(*BY, F.when(F.col("status") == "REJECT", F.col("reasons")[0]).alias("raw"))
    verdict = everyone.join(bounds.select(*BY, F.lit(True).alias("moves")), BY, "left").join(holes.withColumn("hole", F.lit(True)), BY, "left").join(decided, BY, "left")
    reason = F.coalesce("raw", F.when(F.col("moves").isNull(), audit.NO_MOTION), F.when(F.col("hole"), audit.GAP), "reason", F.when(F.col("frames").isNull(), audit.TOO_SHORT))
    verdict = verdict.select(*BY, "frames", reason.alias("reason"), "warning")
    verdict = verdict.withColumn("status", F.when(F.col("reason").isNotNull(), "REJECT").when(F.col("warning").isNotNull(), "PASS_WITH_WARNING").otherwise("PASS"))
    verdict = staged(verdict, "verdict")
    frames = vectors(rows, settings).join(verdict.where("status != 'REJECT'").select(*BY), BY, "left_semi")
    return {"audit": report, "activity": bounds, "gates": verdict, "frames": frames, "aligned": rows}
