"""Episode datasets: reading and writing the columnar layout and its metadata.

Frames are `data/chunk-NNN/episode_NNNNNN.parquet`; metadata is JSON beside them. Column names hold
dots, so they are always quoted.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The frame columns of the layout, in order.
FRAME_COLUMNS = ("observation.state", "action", "timestamp", "frame_index", "episode_index", "index", "task_index", "annotation.human.action.task_description")
DATA_PATH = "data/chunk-{episode_chunk:03d}/episode_{episode_index:06d}.parquet"
VIDEO_PATH = "videos/chunk-{episode_chunk:03d}/{video_key}/episode_{episode_index:06d}.mp4"
CHUNK_SIZE = 1000
FRAMES_DDL = "`observation.state` ARRAY<FLOAT>, `action` ARRAY<FLOAT>, `timestamp` FLOAT, frame_index BIGINT, episode_index BIGINT, `index` BIGINT, task_index BIGINT, `annotation.human.action.task_description` BIGINT"
EPISODES_DDL = "episode_index BIGINT, tasks ARRAY<STRING>, length BIGINT, source_file STRING"
TASKS_DDL = "task_index BIGINT, task STRING"


def read_frames(spark: SparkSession, root: str, columns: Sequence[str] | None = None, episodes: Sequence[int] | None = None) -> DataFrame:
    """Frames of a dataset, in the layout's files or in Spark's partition folders; the columns asked for
    are all that is read, and episodes are a pushed filter."""
    df = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").parquet(f"{root}/data")
    if episodes is not None:
        df = df.where(F.col("episode_index").isin(list(episodes)))
    return df.select(*[F.col(f"`{c}`") for c in columns]) if columns else df


def read_episodes(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(EPISODES_DDL).json(f"{root}/meta/episodes.jsonl")


def read_tasks(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.schema(TASKS_DDL).json(f"{root}/meta/tasks.jsonl")


def read_json(root: str | Path, name: str) -> dict:
    return json.loads(Path(root, "meta", name).read_text())


def consolidated_metadata(spark: SparkSession, root: str) -> DataFrame:
    return spark.read.parquet(f"{root}/meta/episodes/chunk-*/file-*.parquet").orderBy("episode_index")


def float_features(info: Mapping) -> list[str]:
    return [k for k, v in info["features"].items() if "float" in v.get("dtype", "")]


def write_json(path: str | Path, data) -> None:
    """Written beside and moved over, so readers see the old or the new file."""
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temp = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    temp.write_text(json.dumps(data, indent=2, sort_keys=True) + "\n")
    os.replace(temp, path)


def write_lines(path: str | Path, rows: Sequence[Mapping]) -> None:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    temp = path.with_name(f".{path.name}.{uuid.uuid4().hex}")
    temp.write_text("".join(json.dumps(r, sort_keys=True) + "\n" for r in rows))
    os.replace(temp, path)


def write_frames(frames: DataFrame, root: str, chunk_size: int = CHUNK_SIZE) -> None:
    """One file per episode under its chunk, by one shuffle on the episode. `rename_files` gives the
    layout's file names where the store is a local folder."""
    out = frames.withColumn("episode_chunk", F.floor(F.col("episode_index") / chunk_size)).withColumn("__episode", F.col("episode_index"))
    out = out.repartition("__episode").sortWithinPartitions("__episode", "frame_index")
    out.write.mode("overwrite").partitionBy("episode_chunk", "__episode").parquet(f"{root}/data")


def rename_files(root: str | Path) -> int:
    """Spark's partition folders to chunk folders and episode files; returns the number of files."""
    data, n = Path(root, "data"), 0
    for part in sorted(data.glob("episode_chunk=*/__episode=*/*.parquet")):
        chunk, episode = (int(p.name.split("=")[1]) for p in (part.parent.parent, part.parent))
        to = Path(root, DATA_PATH.format(episode_chunk=chunk, episode_index=episode))
        to.parent.mkdir(parents=True, exist_ok=True)
        os.replace(part, to)
        n += 1
    for d in data.glob("episode_chunk=*"):
        shutil.rmtree(d)
    return n


def feature_table(state: Sequence[str], action: Sequence[str], videos: Mapping[str, Sequence[int]], fps: float) -> dict:
    vector = lambda names: {"dtype": "float32", "shape": [len(names)], "names": list(names)}
    out = {"observation.state": vector(state), "action": vector(action)}
    out |= {k: {"dtype": "video", "shape": list(shape), "names": ["height", "width", "channel"], "info": {"video.fps": fps}} for k, shape in videos.items()}
    out["timestamp"] = {"dtype": "float32", "shape": [1]}
    return out | {c: {"dtype": "int64", "shape": [1]} for c in FRAME_COLUMNS[3:]}


def write_metadata(root: str | Path, episodes: Sequence[Mapping], tasks: Sequence[Mapping], features: Mapping, modality: Mapping, fps: float, manifest: Mapping | None = None) -> None:
    """tasks and episodes by line, info, modality, and the manifest of what made the dataset. Without an
    accepted episode there is no info."""
    meta = Path(root, "meta")
    write_lines(meta / "tasks.jsonl", tasks)
    write_lines(meta / "episodes.jsonl", episodes)
    write_json(meta / "modality.json", modality)
    if manifest is not None:
        write_json(meta / "pipeline_manifest.json", manifest)
    if episodes:
        n = sum(e["length"] for e in episodes)
        write_json(meta / "info.json", {"codebase_version": "v2.1", "total_episodes": len(episodes), "total_frames": n, "total_tasks": len(tasks), "chunks_size": CHUNK_SIZE, "fps": fps, "splits": {"train": f"0:{len(episodes)}"}, "data_path": DATA_PATH, "video_path": VIDEO_PATH, "features": features})


def write_roster(root: str | Path, roster: Sequence[Mapping], reports: Sequence[Mapping]) -> dict:
    """The roster, a report line per episode and per rejected one, and a summary with the count of each
    reason: what an audit leaves behind."""
    root = Path(root)
    rejected = [r for r in reports if r["status"] == "REJECT"]
    reasons: dict[str, int] = {}
    for r in rejected:
        for reason in r.get("reasons", []):
            reasons[reason] = reasons.get(reason, 0) + 1
    summary = {"episode_count": len(reports), "pass_count": len(reports) - len(rejected), "reject_count": len(rejected), "reject_reasons": dict(sorted(reasons.items()))}
    write_json(root / "processing_roster.json", {"episodes": list(roster)})
    write_json(root / "dataset_summary.json", summary)
    write_lines(root / "episode_reports.jsonl", reports)
    write_lines(root / "rejected_episodes.jsonl", rejected)
    return summary


def write_quality(root: str | Path, raw: Sequence[Mapping], accepted: Sequence[Mapping], rejected: Sequence[Mapping]) -> dict:
    """Audit, accepted and rejected records by line, and a summary with the count of each reason."""
    quality = Path(root, "quality")
    write_lines(quality / "raw_audit.jsonl", raw)
    write_lines(quality / "accepted.jsonl", accepted)
    write_lines(quality / "rejected.jsonl", rejected)
    reasons: dict[str, int] = {}
    for r in rejected:
        for reason in r.get("reasons", []):
            reasons[reason] = reasons.get(reason, 0) + 1
    summary = {"audited": len(raw), "accepted": len(accepted), "rejected": len(rejected), "reasons": dict(sorted(reasons.items()))}
    write_json(quality / "summary.json", summary)
    return summary


def write_diagnostics(rows: DataFrame, path: str) -> None:
    """Per-frame alignment diagnostics in long form (episode, stream, frame, ...)."""
    rows.write.mode("overwrite").parquet(path)


def diagnostics_json(rows: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    rest = [c for c in rows.columns if c not in by]
    return rows.groupBy(*by).agg(F.to_json(F.array_sort(F.collect_list(F.struct(order, *[c for c in rest if c != order])))).alias("json"))


MARKER = "meta/pipeline_manifest.json"


def publish(outputs: Mapping[str, str], overwrite: bool = False) -> None:
    """Move temporary folders to their targets, all or none. An existing target is replaced only with
    overwrite and if a pipeline made it; what was moved is moved back where a later one fails."""
    for target in outputs.values():
        if os.path.exists(target) and not (overwrite and os.path.exists(os.path.join(target, MARKER))):
            raise FileExistsError(f"{target} exists" + (" and no pipeline made it" if overwrite else ""))
    backups: dict[str, str] = {}
    moved: list[tuple[str, str]] = []
    try:
        for temp, target in outputs.items():
            Path(target).parent.mkdir(parents=True, exist_ok=True)
            if os.path.exists(target):
                backups[target] = f"{target}.{uuid.uuid4().hex}.backup"
                os.rename(target, backups[target])
            os.rename(temp, target)
            moved.append((temp, target))
    except OSError:
        for temp, target in reversed(moved):
            os.rename(target, temp)
        for target, backup in backups.items():
            os.rename(backup, target)
        raise
    for backup in backups.values():
        shutil.rmtree(backup)


def copy_sidecars(mapping: Mapping[int, int], source: str | Path, target: str | Path, chunk_size: int = CHUNK_SIZE) -> int:
    """Videos and masks of renumbered episodes: episode_<old>.* as episode_<new>.*."""
    n = 0
    for kind in ("videos", "masks"):
        for f in sorted(Path(source, kind).rglob("episode_*.*")):
            old = int(f.stem.split("_")[1])
            if old in mapping:
                rel = f.relative_to(Path(source, kind)).parts
                to = Path(target, kind, f"chunk-{mapping[old] // chunk_size:03d}", *rel[1:-1], f"episode_{mapping[old]:06d}{f.suffix}")
                to.parent.mkdir(parents=True, exist_ok=True)
                shutil.copy2(f, to)
                n += 1
    return n
