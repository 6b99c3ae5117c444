"""Video frames: a table of encoded frames, its scans by index, time or whole, and the checks of an
encoded file.

Frames are rows (video, frame_index, image) with the image as bytes; no pixel passes a Spark expression.
Decoding and encoding call ffmpeg where the executors have it, and say so where they don't.
"""

from __future__ import annotations

import json
import shutil
import subprocess
from collections.abc import Iterator
from fractions import Fraction

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.images import frame_index

#: Fixed value: how far from a frame's time a request may lie, in frames.
TOLERANCE = 0.01
SCHEMA = "video string, frame_index long, image binary"


class VideoError(RuntimeError):
    """A video can't be read, written or checked."""


def resolve_backend(asked: str | None = None, available: dict[str, bool] | None = None) -> str:
    """The backend asked for, or the first that this machine has."""
    have = available if available is not None else {"ffmpeg": shutil.which("ffmpeg") is not None}
    if asked is not None:
        if asked not in have:
            raise VideoError(f"unknown backend {asked!r}: {', '.join(sorted(have))}")
        if not have[asked]:
            raise VideoError(f"backend {asked!r} isn't installed here")
        return asked
    for name, there in have.items():
        if there:
            return name
    raise VideoError("no video backend is installed here: " + ", ".join(sorted(have)))


def jpeg_frames(stream: bytes) -> Iterator[bytes]:
    """The images of a motion-JPEG stream."""
    at = stream.find(b"\xff\xd8")
    while at >= 0:
        end = stream.find(b"\xff\xd9", at)
        if end < 0:
            raise VideoError("the last frame is cut off")
        yield stream[at : end + 2]
        at = stream.find(b"\xff\xd8", end + 2)


def decode(raw: bytes) -> list[bytes]:
    """The frames of a video file as JPEG images."""
    resolve_backend("ffmpeg")
    run = subprocess.run(["ffmpeg", "-v", "error", "-i", "pipe:0", "-f", "image2pipe", "-c:v", "mjpeg", "-q:v", "2", "pipe:1"], input=raw, capture_output=True)
    if run.returncode:
        raise VideoError(run.stderr.decode(errors="replace").strip())
    return list(jpeg_frames(run.stdout))


def read_frames(spark: SparkSession, path: str, glob: str = "*.mp4", decoder=decode) -> DataFrame:
    """SCHEMA of all videos under path; a task holds one file at a time."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, raw in zip(pdf["path"], pdf["content"]):
                images = decoder(raw)
                yield pd.DataFrame({"video": name, "frame_index": range(len(images)), "image": images})

    return files.select("path", "content").mapInPandas(run, SCHEMA)


def lengths(frames: DataFrame) -> DataFrame:
    return frames.groupBy("video").agg((F.max("frame_index") + 1).alias("n_frames"))


def at_indices(frames: DataFrame, asks: DataFrame) -> DataFrame:
    """Frames by (video, frame_index), as often as they are asked for; a request beyond the video has no
    image."""
    return asks.join(frames, ["video", "frame_index"], "left")


def at_times(frames: DataFrame, asks: DataFrame, fps: float, strict: bool = True, tolerance: float = TOLERANCE) -> DataFrame:
    """Frames by (video, seconds): the nearest frame. Where a request lies off by more than the tolerance,
    or beyond the video, strict reading raises and the other has no frame."""
    rows = asks.join(lengths(frames), "video", "left")
    index = frame_index(F.col("seconds"), fps, F.col("n_frames"), tolerance)
    if strict:
        reason = F.concat(F.lit("no frame at "), F.col("seconds").cast("string"), F.lit(" s of "), F.col("video"))
        index = F.coalesce(index, F.raise_error(reason).cast("long"))
    return at_indices(frames, rows.withColumn("frame_index", index).drop("n_frames"))


def encode(images: list[bytes], fps: float, target: str) -> None:
    """JPEG images as an H.264 file; its frames and rate are checked afterwards."""
    resolve_backend("ffmpeg")
    run = subprocess.run(["ffmpeg", "-v", "error", "-y", "-f", "mjpeg", "-r", str(fps), "-i", "pipe:0", "-c:v", "libx264", "-pix_fmt", "yuv420p", target], input=b"".join(images), capture_output=True)
    if run.returncode:
        raise VideoError(run.stderr.decode(errors="replace").strip())
    n, rate = probe(target)
    if n != len(images) or abs(rate - fps) > 1e-3:
        raise VideoError(f"{target} has {n} frames at {rate}, {len(images)} at {fps} were written")


def parsed_probe(text: str) -> tuple[int, float]:
    """(frames, rate) from the prober's JSON."""
    try:
        stream = json.loads(text)["streams"][0]
        return int(stream.get("nb_frames") or stream["nb_read_frames"]), float(Fraction(stream["avg_frame_rate"]))
    except (KeyError, ValueError, IndexError, ZeroDivisionError) as e:
        raise VideoError(f"the probe can't be read: {e}") from e


def probe(path: str) -> tuple[int, float]:
    if not shutil.which("ffprobe"):
        raise VideoError("ffprobe isn't installed here")
    fields = "stream=nb_frames,nb_read_frames,avg_frame_rate"
    return parsed_probe(subprocess.check_output(["ffprobe", "-v", "error", "-count_frames", "-select_streams", "v:0", "-show_entries", fields, "-of", "json", path], text=True))


def write_videos(frames: DataFrame, target: str, fps: float, encoder=encode) -> DataFrame:
    """(video, n_frames): one file per video, written by the task that has its frames. `target` formats a
    video's name to a path that executors share."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("frame_index")
        encoder(pdf["image"].tolist(), fps, target.format(video=pdf["video"].iloc[0]))
        return pd.DataFrame({"video": [pdf["video"].iloc[0]], "n_frames": [len(pdf)]})

    return frames.select("video", "frame_index", "image").groupBy("video").applyInPandas(run, "video string, n_frames long")


def encoding_faults(probes: DataFrame, frames: DataFrame, fps: float) -> DataFrame:
    """(video, n_frames, found_frames, fault): what a probe (video, found_frames, found_fps) finds against
    the frames meant: missing_file, frame_count_mismatch, frame_rate_mismatch, or null."""
    rows = lengths(frames).join(probes, "video", "left")
    fault: Column = F.when(F.col("found_frames").isNull(), "missing_file").when(F.col("found_frames") != F.col("n_frames"), "frame_count_mismatch")
    fault = fault.when(F.abs(F.col("found_fps") - fps) > 1e-3, "frame_rate_mismatch")
    return rows.select("video", "n_frames", "found_frames", fault.alias("fault"))
