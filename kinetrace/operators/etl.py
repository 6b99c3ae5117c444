"""Merging, splitting and re-laying episode datasets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .asof import in_intervals
from .ordering import numbered

#: Fixed value: prefixes of the consolidated layout's metadata columns.
CONSOLIDATED_PREFIXES = ("data/", "videos/", "stats/", "meta/")


def task_mapping(tasks: DataFrame) -> DataFrame:
    """(dataset, task_index, task, new_index) from (dataset, task_index, task): equal texts share an
    index, numbered by where they are first seen."""
    first = tasks.groupBy("task").agg(F.min(F.struct("dataset", "task_index")).alias("__first"))
    return tasks.join(numbered(first, ["__first", "task"], "new_index").drop("__first"), "task")


def episode_offsets(lengths: DataFrame, order: Sequence[str], length: str = "length") -> DataFrame:
    """Adds episode_index (dense, from 0) and start (frames before it). One row per episode; `order` tells
    episodes apart."""
    out = numbered(lengths, order, "episode_index", {"start": length})
    return out.withColumn("start", F.col("start").cast("long"))


def with_indices(frames: DataFrame, offsets: DataFrame, by: Sequence[str], order: Sequence[str], fps: float = 30.0) -> DataFrame:
    """Frames with frame_index, timestamp, episode_index and the global index; frames of episodes
    without an offset go."""
    i = (F.row_number().over(W.partitionBy(*by).orderBy(*order)) - 1).cast("long")
    rows = frames.withColumn("frame_index", i)
    rows = rows.join(offsets.select(*by, "episode_index", "start"), list(by))
    stamp = (F.col("frame_index").cast("float") / F.lit(fps).cast("float")).cast("float")
    return rows.withColumn("index", F.col("start") + F.col("frame_index")).withColumn("timestamp", stamp).drop("start")


def merged(datasets: Sequence[Mapping[str, DataFrame]]) -> dict[str, DataFrame]:
    """Union of datasets, each {frames, episodes, tasks}: episodes and the global index are numbered
    on, task indices mapped by text. Columns are matched by name."""
    number = lambda name: [d[name].withColumn("dataset", F.lit(k)) for k, d in enumerate(datasets)]

    def stacked(name: str) -> DataFrame:
        first, *rest = number(name)
        for other in rest:
            first = first.unionByName(other)
        return first

    mapping = task_mapping(stacked("tasks"))
    episodes = episode_offsets(stacked("episodes").withColumnRenamed("episode_index", "old_episode"), ["dataset", "old_episode"])
    frames = stacked("frames").withColumnRenamed("episode_index", "old_episode").withColumnRenamed("task_index", "old_task").drop("index")
    frames = frames.join(episodes.select("dataset", "old_episode", "episode_index", "start"), ["dataset", "old_episode"])
    frames = frames.join(mapping.select("dataset", F.col("task_index").alias("old_task"), F.col("new_index").alias("task_index")), ["dataset", "old_task"])
    frames = frames.withColumn("index", F.col("start") + F.col("frame_index")).drop("dataset", "old_episode", "old_task", "start")
    tasks = mapping.select(F.col("new_index").alias("task_index"), "task").distinct()
    return {"frames": frames, "episodes": episodes.drop("dataset", "old_episode", "start"), "tasks": tasks}


def incompatible(a: Mapping, b: Mapping) -> list[str]:
    """Keys on which two datasets' metadata differ so that they can't be merged; a video's frame rate
    may differ."""
    strip = lambda f: {k: {x: y for x, y in v.items() if x != "info"} | {"info": {x: y for x, y in v.get("info", {}).items() if x != "video.fps"}} for k, v in f.items()}
    found = [k for k in ("codebase_version", "data_path", "video_path", "chunks_size") if a.get(k) != b.get(k)]
    if strip(a.get("features", {})) != strip(b.get("features", {})):
        found.append("features")
    if a.get("modality") != b.get("modality"):
        found.append("modality")
    return found


def split_ranges(frames: DataFrame, episodes: DataFrame, index: str = "index", width: int = 4096) -> DataFrame:
    """Frames of a consolidated file with the episode whose [from_index, to_index) holds them."""
    f = frames.withColumn("__block", F.floor(F.col(index) / width))
    e = episodes.where("from_index < to_index").withColumn("__block", F.explode(F.sequence(F.floor(F.col("from_index") / width), F.floor((F.col("to_index") - 1) / width))))
    return f.join(e, "__block").where((F.col(index) >= F.col("from_index")) & (F.col(index) < F.col("to_index"))).drop("__block")


def consolidated_episodes(meta: DataFrame) -> DataFrame:
    """Per-episode metadata without the consolidated layout's columns; the length follows from the
    range where it is missing."""
    names = [c for c in meta.columns if not c.startswith(CONSOLIDATED_PREFIXES)]
    out = meta.select(*[F.col(f"`{c}`") for c in names])
    if "length" not in names:
        out = out.withColumn("length", F.col("dataset_to_index") - F.col("dataset_from_index"))
    return out


def unflattened_stats(meta: DataFrame) -> DataFrame:
    """(episode_index, feature, stat, values) from columns stats/<feature>/<stat>."""
    cols = [c for c in meta.columns if c.startswith("stats/")]
    items = [F.struct(F.lit(c.split("/", 1)[1].rsplit("/", 1)[0]).alias("feature"), F.lit(c.rsplit("/", 1)[1]).alias("stat"), F.col(f"`{c}`").cast("array<double>").alias("values")) for c in cols]
    return meta.select("episode_index", F.explode(F.array(*items)).alias("x")).select("episode_index", "x.*")


def files_of(episodes: DataFrame, chunk: str = "chunk", file: str = "file") -> DataFrame:
    """Episodes of each consolidated file, in order."""
    return episodes.groupBy(chunk, file).agg(F.array_sort(F.collect_list("episode_index")).alias("episodes"))


def with_tasks(frames: DataFrame, tasks: DataFrame, strict: bool = True) -> DataFrame:
    """Frames with the text of their task; an unknown index raises, or gives null."""
    out = frames.join(tasks, "task_index", "left")
    if strict:
        out = out.withColumn("task", F.coalesce("task", F.raise_error(F.lit("a frame's task is not in the task table")).cast("string")))
    return out


def used_tasks(tasks: DataFrame, frames: DataFrame) -> DataFrame:
    return tasks.join(frames.select("task_index").distinct(), "task_index", "left_semi")


def first_n(rows: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    """The first n rows per key."""
    return rows.withColumn("__r", F.row_number().over(W.partitionBy(*by).orderBy(*order))).where(F.col("__r") <= n).drop("__r")


def cut_to_length(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """Frames within both the nominal and the actual length of their episode."""
    return frames.join(episodes.select("episode_index", "length"), "episode_index").where(F.col("frame_index") < F.col("length")).drop("length")


def subtask_text(frames: DataFrame, intervals: DataFrame, horizon: int, seed: int) -> DataFrame:
    """Frames with one of the texts whose interval, widened to the left by half the horizon, holds
    them; an empty text where none does. The choice is seeded by episode and frame."""
    wide = intervals.select("episode_index", "text", F.greatest(F.lit(0).cast("long"), F.col("start") - horizon // 2).alias("start"), "stop")
    hit = in_intervals(frames.select("episode_index", "frame_index"), wide, ["episode_index"], "frame_index", "start", "stop")
    texts = hit.groupBy("episode_index", "frame_index").agg(F.array_sort(F.collect_list("text")).alias("__t"))
    pick = F.get("__t", F.pmod(F.xxhash64(F.lit(seed), "episode_index", "frame_index"), F.size("__t")).cast("int"))
    return frames.join(texts, ["episode_index", "frame_index"], "left").withColumn("text", F.coalesce(pick, F.lit(""))).drop("__t")


def selected_episodes(frames: DataFrame, ids: Sequence[int] | None = None, first: int | None = None, by: str = "episode_index") -> DataFrame:
    """Frames of the episodes asked for, all if none are named, and of those the first few. An id that
    the table doesn't have raises when rows are read."""
    have = frames.select(by).distinct()
    if ids is not None:
        asked = frames.sparkSession.createDataFrame([(int(i),) for i in dict.fromkeys(ids)], f"{by} long")
        known = asked.join(have.withColumn("__known", F.lit(True)), by, "left")
        message = F.concat(F.lit("no episode "), F.col(by).cast("string"))
        have = known.where(F.coalesce("__known", F.raise_error(message).cast("boolean"))).select(by)
    if first is not None:
        have = have.orderBy(by).limit(first)
    return frames.join(have, by, "left_semi")


def kept_episodes(frames: DataFrame, verdicts: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Frames of accepted episodes, renumbered densely in the order of the keys."""
    good = verdicts.where("status != 'REJECT'").select(*by)
    lengths = frames.join(good, list(by), "left_semi").groupBy(*by).agg(F.count("*").alias("length"))
    return with_indices(frames, episode_offsets(lengths, by), by, order)
