"""Statistics files of an episode dataset: per feature, and of relative action chunks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import part
from ..operators import sequences, sketches, statistics
from ..operators.records import STATISTICS, complete_stats
from ..sources import episodes


def feature_stats(frames: DataFrame, features: Sequence[str], exact: bool = False) -> dict:
    """{feature: {mean, std, min, max, q01, q99}}; what comes to the driver is one row per dimension."""
    out = {}
    for f in features:
        scalar = not frames.schema[f].dataType.typeName().startswith("array")
        v = F.array(F.col(f"`{f}`")) if scalar else F.col(f"`{f}`")
        rows = statistics.vector_stats(frames.select(v.alias("v")), "v", exact=exact).orderBy("dim").collect()
        out[f] = {k: [r[k] for r in rows] for k in STATISTICS}
    return out


def relative_stats(frames: DataFrame, state: tuple[int, int], action: tuple[int, int], horizon: int, exact: bool = False) -> dict:
    """Statistics per (step, dim) of action chunks relative to the state at their first step, over windows
    that lie whole within their episode."""
    rows = frames.select("episode_index", "frame_index", part("`observation.state`", *state).alias("s"), part("`action`", *action).alias("a"))
    c = sequences.chunks(rows, ["episode_index"], ["frame_index"], "a", horizon, pad=False).where(F.size("chunk") == horizon)
    got = statistics.chunk_stats(c.select(sequences.relative_chunk("chunk", F.col("s")).alias("c")), "c", exact=exact).orderBy("step", "dim").collect()
    steps = sorted({r.step for r in got})
    return {k: [[r[k] for r in got if r.step == s] for s in steps] for k in STATISTICS}


def feature_states(frames: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, dim, state): the mergeable states of all features, in one pass over the frames."""
    arrays = [F.array(F.col(f"`{f}`")) if not frames.schema[f].dataType.typeName().startswith("array") else F.col(f"`{f}`") for f in features]
    rows = frames.select(F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), v.cast("array<double>").alias("v")) for f, v in zip(features, arrays)])).alias("f"))
    return sketches.vector_states(rows.select("f.feature", "f.v"), "v", ["feature"])


def write_states(spark: SparkSession, root: str, features: Sequence[str] | None = None) -> str:
    """The states of a dataset's features as meta/stats_states.parquet, whose path is returned."""
    features = features or episodes.float_features(episodes.read_json(root, "info.json"))
    path = str(Path(root, "meta", "stats_states.parquet"))
    feature_states(episodes.read_frames(spark, root, features), features).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def union_stats(spark: SparkSession, roots: Sequence[str]) -> DataFrame:
    """(feature, dim, n, mean, std, min, max, q01, q99, n_distinct) of all frames of several datasets, from
    the states stored with each; their frames aren't read."""
    held = spark.read.parquet(*[str(Path(r, "meta", "stats_states.parquet")) for r in roots])
    return sketches.read(sketches.merged(held, ["feature", "dim"]))


def generate(spark: SparkSession, root: str, relative: Mapping[str, tuple[tuple[int, int], tuple[int, int], int]] | None = None, exact: bool = False) -> bool:
    """Write meta/stats.json and meta/relative_stats.json unless they are complete; whether anything was
    written. relative: action key -> (state range, action range, horizon). Quantiles are sketches unless exact ones are asked for."""
    info = episodes.read_json(root, "info.json")
    features = episodes.float_features(info)
    path, wrote = Path(root, "meta", "stats.json"), False
    if not (path.exists() and complete_stats(episodes.read_json(root, "stats.json"), features)):
        episodes.write_json(path, feature_stats(episodes.read_frames(spark, root, features), features, exact))
        wrote = True
    path = Path(root, "meta", "relative_stats.json")
    held = episodes.read_json(root, "relative_stats.json") if path.exists() else {}
    for key, (state, action, horizon) in sorted((relative or {}).items()):
        if not complete_stats(held, [key], horizon):
            held[key] = relative_stats(episodes.read_frames(spark, root), state, action, horizon, exact)
            wrote = True
            episodes.write_json(path, held)
    return wrote
