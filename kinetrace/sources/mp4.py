"""The index of MP4 and MOV files: what each frame's bytes are and when it is shown, without decoding.

The boxes of a file are walked by their headers; of the media data nothing is read. A frame table has a row
a sample of the video track, from which requests by index or time become byte ranges: a frame needs the
samples from the last sync sample on, in decoding order. Intra-coded tracks give images as they are; others
need a decoder for the samples of a group.

Fragmented files have no sample tables for their fragments and are an error, as are files without a video
track or with tables cut short.
"""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .video import VideoError

#: Fixed values of the format: boxes that hold boxes on the way to a track's sample tables, and the codecs
#: whose every sample is an image file.
PARENTS = {b"moov", b"trak", b"mdia", b"minf", b"stbl", b"edts"}
IMAGE_CODECS = ("jpeg", "mjpa", "png ")
HEADER_LIMIT = 1 << 30
#: sample counts in decoding order, frame_index in order of time; both start at 0. group is the last sync
#: sample at or before the sample. Samples that an edit list hides have no frame_index.
SCHEMA = "video string, sample long, frame_index long, group long, sync boolean, start long, size long, seconds double"
FACTS = "video string, codec string, width int, height int, n_frames long, fps double, seconds double, config binary"


def boxes(f, at: int, end: int) -> Iterator[tuple[bytes, int, int]]:
    """(kind, start, stop) of the boxes between two places, bodies unread."""
    while at + 8 <= end:
        f.seek(at)
        size, kind = struct.unpack(">I4s", f.read(8))
        head = 8
        if size == 1:
            (size,) = struct.unpack(">Q", f.read(8))
            head = 16
        elif size == 0:
            size = end - at
        if size < head or at + size > end:
            raise VideoError(f"a box {kind!r} is cut off")
        yield kind, at + head, at + size
        at += size


def tree(f, at: int, end: int) -> dict[bytes, list]:
    """Bodies of the boxes by kind; those of PARENTS are trees."""
    out: dict[bytes, list] = {}
    for kind, a, b in boxes(f, at, end):
        if kind in PARENTS:
            out.setdefault(kind, []).append(tree(f, a, b))
        elif kind != b"mdat":
            if b - a > HEADER_LIMIT:
                raise VideoError(f"a box {kind!r} of {b - a} bytes is no table")
            f.seek(a)
            out.setdefault(kind, []).append(f.read(b - a))
    return out


def table(body: bytes, columns: int, kind: str = ">u4") -> np.ndarray:
    """A counted table's rows."""
    (n,) = struct.unpack_from(">I", body, 4)
    out = np.frombuffer(body, kind, n * columns, 8)
    return out.reshape(n, columns).astype(np.int64)


def one(boxes_: dict, *kinds: bytes):
    for kind in kinds:
        if kind in boxes_:
            return boxes_[kind][0]
    raise VideoError(f"no box {kinds[0]!r}")


def video_track(f) -> dict:
    """The boxes of the first video track."""
    f.seek(0, 2)
    top = {}
    for kind, a, b in boxes(f, 0, f.tell()):
        if kind == b"moov":
            top = tree(f, a, b)
    if b"mvex" in top:
        raise VideoError("the file is fragmented: its fragments have no sample tables")
    for trak in top.get(b"trak", []):
        mdia = one(trak, b"mdia")
        if one(mdia, b"hdlr")[8:12] == b"vide":
            return trak
    raise VideoError("the file has no video track")


def track_samples(trak: dict) -> dict:
    """start, size, ticks (of decoding and of showing), sync per sample, and the track's facts."""
    try:
        return _track_samples(trak)
    except (struct.error, ValueError, IndexError) as e:
        raise VideoError(f"a table is cut off: {e}") from e


def _track_samples(trak: dict) -> dict:
    mdia = one(trak, b"mdia")
    stbl = one(one(mdia, b"minf"), b"stbl")
    head = one(mdia, b"mdhd")
    (scale,) = struct.unpack_from(">I", head, 20 if head[0] else 12)
    if b"stz2" in stbl and b"stsz" not in stbl:
        raise VideoError("compact sample sizes aren't read")
    sizes = one(stbl, b"stsz")
    same, n = struct.unpack_from(">II", sizes, 4)
    size = np.full(n, same, np.int64) if same else np.frombuffer(sizes, ">u4", n, 12).astype(np.int64)
    chunks = table(stbl[b"stco"][0], 1)[:, 0] if b"stco" in stbl else table(one(stbl, b"co64"), 1, ">u8")[:, 0]
    runs = table(one(stbl, b"stsc"), 3)
    # Each run of chunks has so many samples a chunk, up to where the next run begins.
    upto = np.append(runs[1:, 0], len(chunks) + 1)
    per_chunk = np.repeat(runs[:, 1], upto - runs[:, 0])[: len(chunks)]
    if per_chunk.sum() < n:
        raise VideoError(f"{n} samples, {int(per_chunk.sum())} of which have a chunk")
    chunk = np.repeat(np.arange(len(per_chunk)), per_chunk)[:n]
    before = np.cumsum(size) - size
    first = np.minimum(np.cumsum(per_chunk) - per_chunk, max(n - 1, 0))
    start = chunks[chunk] + before - before[first][chunk] if n else before
    steps = table(one(stbl, b"stts"), 2)
    delta = np.repeat(steps[:, 1], steps[:, 0])[:n]
    if len(delta) < n:
        raise VideoError(f"{n} samples, {len(delta)} of which have a duration")
    shown = np.cumsum(delta) - delta
    if b"ctts" in stbl:
        body = stbl[b"ctts"][0]
        late = table(body, 2, ">i4" if body[0] else ">u4")
        shown = shown + np.repeat(late[:, 1], late[:, 0])[:n]
    sync = np.ones(n, bool)
    if b"stss" in stbl:
        sync[:] = False
        sync[table(stbl[b"stss"][0], 1)[:, 0] - 1] = True
    opening = 0
    if b"edts" in trak and b"elst" in trak[b"edts"][0]:
        body = trak[b"edts"][0][b"elst"][0]
        wide = np.dtype([("n", ">u8"), ("t", ">i8"), ("r", ">i4")]) if body[0] else np.dtype([("n", ">u4"), ("t", ">i4"), ("r", ">i4")])
        edits = np.frombuffer(body, wide, struct.unpack_from(">I", body, 4)[0], 8)["t"]
        opening = int(edits[edits >= 0][0]) if (edits >= 0).any() else 0
    entry = one(stbl, b"stsd")[8:]
    width, height = struct.unpack_from(">HH", entry, 32)
    total = int(delta.sum())
    return {"start": start, "size": size, "ticks": shown - opening, "sync": sync, "scale": scale, "codec": entry[4:8].decode("latin-1"), "width": width, "height": height, "fps": n * scale / total if total else None, "seconds": total / scale, "config": entry[86 : struct.unpack_from(">I", entry)[0]]}


Opener = Callable[[str], object]


def opened(path: str):
    """A file of a path that executors share."""
    return open(path.removeprefix("file://").removeprefix("file:"), "rb")


def _files(spark: SparkSession, path: str, glob: str) -> DataFrame:
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", glob).load(path)
    return found.select("path")


def facts(spark: SparkSession, path: str, glob: str = "*.mp4", opener: Opener = opened) -> DataFrame:
    """FACTS, a row a video: what a prober would tell. config holds the boxes of the codec's set-up."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for name in batch.column(0).to_pylist():
                with opener(name) as f:
                    t = track_samples(video_track(f))
                out.append({"video": name, "n_frames": int((t["ticks"] >= 0).sum()), **{k: t[k] for k in ("codec", "width", "height", "fps", "seconds", "config")}})
            schema = pa.schema([("video", pa.string()), ("codec", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("n_frames", pa.int64()), ("fps", pa.float64()), ("seconds", pa.float64()), ("config", pa.binary())])
            yield pa.RecordBatch.from_pylist(out, schema)

    return _files(spark, path, glob).mapInArrow(run, FACTS)


def probes(facts_: DataFrame) -> DataFrame:
    """Facts as `video.encoding_faults` takes them."""
    return facts_.select("video", F.col("n_frames").alias("found_frames"), F.col("fps").alias("found_fps"))


def frame_table(spark: SparkSession, path: str, glob: str = "*.mp4", opener: Opener = opened, rows: int = 1 << 16) -> DataFrame:
    """SCHEMA, a row a sample of every video under path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for name in batch.column(0).to_pylist():
                with opener(name) as f:
                    t = track_samples(video_track(f))
                n = len(t["size"])
                sample = np.arange(n)
                order = np.argsort(t["ticks"], kind="stable")
                hidden = int((t["ticks"] < 0).sum())
                index = np.empty(n, np.int64)
                index[order] = np.arange(n) - hidden
                group = np.maximum.accumulate(np.where(t["sync"], sample, 0)) if n else sample
                for a in range(0, n, rows):
                    b = slice(a, a + rows)
                    own = index[b]
                    columns = [pa.array([name] * len(own)), pa.array(sample[b]), pa.array(own, mask=own < 0), pa.array(group[b]), pa.array(t["sync"][b]), pa.array(t["start"][b]), pa.array(t["size"][b]), pa.array(t["ticks"][b] / t["scale"])]
                    yield pa.RecordBatch.from_arrays(columns, names=[c.split()[0] for c in SCHEMA.split(", ")])

    return _files(spark, path, glob).mapInArrow(run, SCHEMA)


def needed(samples: DataFrame, asks: DataFrame) -> DataFrame:
    """The samples that must be decoded to show the frames asked for by (video, frame_index): from each one's
    sync sample up to the last one asked for in its group, once each."""
    wanted = asks.select("video", "frame_index").distinct().join(samples, ["video", "frame_index"])
    last = wanted.groupBy("video", "group").agg(F.max("sample").alias("__last"))
    return samples.join(last, ["video", "group"]).where(F.col("sample") <= F.col("__last")).drop("__last")


def byte_ranges(needed_: DataFrame) -> DataFrame:
    """(video, start, stop, n_samples): samples that lie side by side in a file make one range."""
    w = W.partitionBy("video").orderBy("start", "sample")
    stop = F.col("start") + F.col("size")
    rows = needed_.select("video", "sample", "start", stop.alias("stop")).withColumn("__new", F.coalesce((F.lag("stop").over(w) != F.col("start")).cast("long"), F.lit(1)))
    rows = rows.withColumn("__range", F.sum("__new").over(w.rowsBetween(W.unboundedPreceding, 0)))
    return rows.groupBy("video", "__range").agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.count("*").alias("n_samples")).drop("__range")


def frames_at(samples: DataFrame, facts_: DataFrame, asks: DataFrame, decoder: Callable[[str, bytes, list[bytes]], list[bytes]] | None = None, opener: Opener = opened) -> DataFrame:
    """(video, frame_index, image) of the frames asked for, each once; only the bytes of their groups are
    read, a group a time. decoder takes codec, config and a group's samples in decoding order, and gives
    their images in that order; image codecs need none."""
    named = needed(samples, asks).join(facts_.select("video", "codec", "config"), "video")
    wanted = asks.select("video", "frame_index").distinct().withColumn("__asked", F.lit(True))
    rows = named.join(wanted, ["video", "frame_index"], "left")
    groups = rows.groupBy("video", "group").agg(F.first("codec").alias("codec"), F.first("config").alias("config"), F.array_sort(F.collect_list(F.struct("sample", "start", "size", "frame_index", F.coalesce("__asked", F.lit(False)).alias("asked")))).alias("samples"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                with opener(row["video"]) as f:
                    raw = []
                    for s in row["samples"]:
                        f.seek(s["start"])
                        raw.append(f.read(s["size"]))
                        if len(raw[-1]) != s["size"]:
                            raise VideoError(f"{row['video']}: sample {s['sample']} is cut off")
                if row["codec"] not in IMAGE_CODECS:
                    if decoder is None:
                        raise VideoError(f"{row['video']}: codec {row['codec']!r} needs a decoder")
                    raw = decoder(row["codec"], row["config"], raw)
                kept = [(s["frame_index"], image) for s, image in zip(row["samples"], raw) if s["asked"]]
                yield pa.RecordBatch.from_arrays([pa.array([row["video"]] * len(kept)), pa.array([k for k, _ in kept], pa.int64()), pa.array([i for _, i in kept], pa.binary())], names=["video", "frame_index", "image"])

    return groups.mapInArrow(run, "video string, frame_index long, image binary")
