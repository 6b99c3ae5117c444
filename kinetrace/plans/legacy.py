"""The older conversion: nearest alignment on one stream's clock, EMA, motion trim, quality verdicts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..operators import asof, sequences, statistics
from ..operators.ordering import numbered
from ..sources.episodes import write_json

BY = ["episode"]


def aligned(samples: DataFrame, clock: str, streams: Sequence[str]) -> DataFrame:
    """Frames at the clock's times inside the window that all streams share, each with the nearest row
    of every stream: (episode, frame_index, t, stream, v, skew)."""
    rows = samples.where(F.col("stream").isin([clock, *streams]))
    window = asof.common_window(rows, BY).where(F.col("n_streams") == len(set([clock, *streams])))
    frames = asof.within(rows.where(F.col("stream") == clock).select(*BY, "t"), window, BY)
    frames = frames.withColumn("frame_index", (F.row_number().over(W.partitionBy(*BY).orderBy("t")) - 1).cast("long"))
    asked = frames.withColumn("stream", F.explode(F.array(*[F.lit(s) for s in streams])))
    near = asof.nearest(asked, rows.select(*BY, "stream", "t", "v"), [*BY, "stream"])
    return near.select(*BY, "frame_index", "t", "stream", F.col("src.v").alias("v"), (F.col("src.t") - F.col("t")).alias("skew"))


def smoothed(rows: DataFrame, alpha: float) -> DataFrame:
    """EMA of each dimension of each stream in single precision's stead, in double."""
    flat = rows.select(*BY, "stream", "t", F.posexplode("v").alias("dim", "x"))
    out = sequences.ema(flat, [*BY, "stream", "dim"], ["t"], "x", alpha)
    return out.groupBy(*BY, "stream", "t").agg(F.transform(F.array_sort(F.collect_list(F.struct("dim", "ema"))), lambda s: s["ema"]).alias("v"))


def reasons(skew: float, length: int = 30, velocity: float = 0.001) -> Column:
    """Why an episode's quality (max_skew, n, mean_velocity) fails."""
    return F.array_compact(F.array(F.when(F.col("max_skew") > skew, "skew"), F.when(F.col("n") < length, "too_short"), F.when(F.col("mean_velocity") < velocity, "no_motion")))


def quality(rows: DataFrame, per_second: float, max_skew: float) -> DataFrame:
    """Per episode: frames, skew statistics, mean velocity, and the reasons to drop it."""
    skew = rows.groupBy(*BY).agg(F.count_distinct("frame_index").alias("n"), F.avg(F.abs("skew")).alias("mean_skew"), F.percentile(F.abs("skew"), 0.9).alias("p90_skew"), F.max(F.abs("skew")).alias("max_skew"))
    v = sequences.speed(rows.where("v is not null"), [*BY, "stream"], "t", "v", per_second, vector=True)
    moving = v.groupBy(*BY).agg(F.avg("speed").alias("mean_velocity"))
    out = skew.join(moving, BY, "left").withColumn("mean_velocity", F.coalesce("mean_velocity", F.lit(0.0)))
    return out.withColumn("reasons", reasons(max_skew))


def summary(per_episode: DataFrame) -> DataFrame:
    """One row over all episodes; zeros where there are none."""
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("double")
    return per_episode.agg(F.count("*").alias("episodes"), F.count_if(F.size("reasons") > 0).alias("failed"), zero(F.sum("n")).alias("frames"), zero(F.avg("n")).alias("mean_length"), zero(F.median("n")).alias("median_length"), zero(F.avg("max_skew")).alias("mean_max_skew"))


def report_text(episodes: Sequence[Mapping], total: Mapping) -> str:
    """The quality report to read: a line per episode, then what all come to."""
    lines = [f"{e['episode']}: {e['n']} frames, skew {e['mean_skew'] or 0:.4f} mean {e['max_skew'] or 0:.4f} max, velocity {e['mean_velocity']:.4f}: {', '.join(e['reasons']) or 'good'}" for e in episodes]
    return "\n".join([*lines, f"{total['episodes']} episodes, {total['failed']} failed, {total['frames']:.0f} frames, {total['mean_length']:.1f} on average", ""])


def write_report(quality: DataFrame, path: str) -> None:
    """The report as JSON, and as text beside it; one row per episode comes to the driver."""
    rows = [r.asDict() for r in quality.orderBy(*BY).collect()]
    total = summary(quality).first().asDict()
    write_json(path, {"episodes": rows, "summary": total})
    Path(path).with_suffix(".txt").write_text(report_text(rows, total))


def converted(samples: DataFrame, clock: str, streams: Sequence[str], alpha: float, per_second: float, max_skew: float) -> dict[str, DataFrame]:
    """Aligned, smoothed and judged; `frames` has accepted episodes only, numbered densely."""
    rows = aligned(samples, clock, streams)
    verdict = quality(rows, per_second, max_skew)
    smooth = smoothed(rows.where("v is not null"), alpha)
    good = verdict.where(F.size("reasons") == 0).select(*BY)
    index = numbered(good, BY, "episode_index")
    frames = rows.drop("v").join(smooth, [*BY, "stream", "t"], "left").join(index, BY)
    return {"frames": frames, "quality": verdict, "summary": summary(verdict), "fps": statistics.median_fps(rows.select(*BY, "t").distinct(), BY, "t", per_second)}


