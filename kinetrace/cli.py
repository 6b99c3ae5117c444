"""python -m kinetrace.cli validate | audit | convert | summarize

validate reads the profile and the bags' metadata; audit reports on raw streams; convert writes an
episode dataset; summarize counts the reasons of existing reports. --dry-run stops after validation.
"""

from __future__ import annotations

import argparse
import json
import sys
import tempfile
from itertools import accumulate
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="kinetrace", description=__doc__)
    sub = p.add_subparsers(dest="verb", required=True)
    for verb in ("validate", "audit", "convert"):
        s = sub.add_parser(verb)
        s.add_argument("profile")
        s.add_argument("bags")
        s.add_argument("--task", default="task")
        s.add_argument("--episodes", type=int, nargs="*", help="roster indices; all if none is given")
        s.add_argument("--limit", type=int)
        if verb != "validate":
            s.add_argument("output")
            s.add_argument("--dry-run", action="store_true")
        if verb == "convert":
            s.add_argument("--overwrite", action="store_true")
    s = sub.add_parser("summarize")
    s.add_argument("reports", nargs="+")
    return p


def selected(roster: DataFrame, episodes: list[int] | None, limit: int | None) -> DataFrame:
    """Roster rows by index, then the first `limit`; an unknown index is an error."""
    if episodes:
        known = {r.roster_index for r in roster.collect()}
        unknown = sorted(set(episodes) - known)
        if unknown:
            raise ValueError(f"unknown episodes {unknown}")
        roster = roster.where(F.col("roster_index").isin(episodes))
    return roster.orderBy("roster_index").limit(limit) if limit else roster


def messages_of(spark: SparkSession, root: str, roster: DataFrame, profile) -> DataFrame:
    """Messages in the conversion's form, keyed by roster index."""
    from .sources import bag

    topics = {s.topic: s.key for s in profile.streams}
    df = bag.read(spark, root, list(topics))
    keys = F.create_map(*[F.lit(x) for kv in topics.items() for x in kv])
    bags = roster.select(F.col("roster_index").alias("episode"), "bag")
    df = df.join(bags, "bag")
    v = F.when(F.col("image").isNull(), F.col("values"))
    return df.select("episode", F.element_at(keys, F.col("topic")).alias("stream"), F.col("sequence").alias("seq"), F.coalesce("header_time_ns", F.lit(0).cast("long")).alias("t"), F.col("bag_time_ns").alias("bag_t"), v.alias("v"), F.col("error").isNull().alias("decoded"))


def settings_of(profile):
    from .plans.convert import Settings

    state = tuple(s.key for s in profile.streams if s.alignment in ("linear", "pose"))
    action = tuple(s.key for s in profile.streams if s.alignment == "previous")
    return Settings(state=state, action=action, activity=state, minimum_frames=profile.minimum_frames, fps=profile.fps)


def main(args: list[str] | None = None) -> int:
    from .operators.records import merged_reports
    from .plans.convert import convert, raw_audit
    from .session import session
    from .sources import bag, episodes
    from .sources.config import load_profile

    a = parser().parse_args(args)
    spark = SparkSession.getActiveSession() or session()
    if a.verb == "summarize":
        print(json.dumps({r.reason: r.n for r in merged_reports(spark, a.reports).orderBy("reason").collect()}))
        return 0
    profile = load_profile(a.profile)
    roster = selected(bag.roster(spark, [{"task": a.task, "roots": [a.bags]}]), a.episodes, a.limit)
    if a.verb == "validate" or a.dry_run:
        print(json.dumps({"profile": profile.name, "sha256": profile.sha256, "bags": [r.bag for r in roster.collect()]}))
        return 0
    messages = messages_of(spark, a.bags, roster, profile)
    if a.verb == "audit":
        raw = [r.asDict() for r in raw_audit(messages, profile).orderBy("episode").collect()]
        episodes.write_quality(a.output, raw, [r for r in raw if r["status"] != "REJECT"], [r for r in raw if r["status"] == "REJECT"])
        return 0
    settings = settings_of(profile)
    out = convert(messages, profile, settings)
    verdicts = [r.asDict() for r in out["gates"].orderBy("episode").collect()]
    good = [r for r in verdicts if r["status"] != "REJECT"]
    starts = accumulate((r["frames"] for r in good), initial=0)
    index = spark.createDataFrame([(r["episode"], i, start) for i, (r, start) in enumerate(zip(good, starts))], "episode int, episode_index long, start long")
    frames = out["frames"].join(index, "episode").select(F.col("state").cast("array<float>").alias("observation.state"), F.col("action").cast("array<float>").alias("action"), "timestamp", "frame_index", "episode_index", (F.col("start") + F.col("frame_index")).alias("index"), F.lit(0).cast("long").alias("task_index"), F.lit(0).cast("long").alias("annotation.human.action.task_description"))
    temp = tempfile.mkdtemp(dir=Path(a.output).resolve().parent)
    episodes.write_frames(frames, temp)
    episodes.rename_files(temp)
    sizes = {k: [f"{k}_{i}" for i in range(n)] for k, n in (("state", frames.select(F.max(F.size("`observation.state`"))).first()[0] or 0), ("action", frames.select(F.max(F.size("action"))).first()[0] or 0))}
    features = episodes.feature_table(sizes["state"], sizes["action"], {}, profile.fps)
    meta = [{"episode_index": i, "tasks": [a.task], "length": r["frames"]} for i, r in enumerate(good)]
    episodes.write_metadata(temp, meta, [{"task_index": 0, "task": a.task}], features, {}, profile.fps, {"profile": profile.sha256})
    raw = [r.asDict() for r in out["audit"].orderBy("episode").collect()]
    episodes.write_quality(temp, raw, good, [r | {"reasons": [r["reason"]]} for r in verdicts if r["status"] == "REJECT"])
    episodes.publish({temp: a.output}, a.overwrite)
    print(json.dumps({"accepted": len(good), "rejected": len(verdicts) - len(good)}))
    return 0


if __name__ == "__main__":
    sys.exit(main())
