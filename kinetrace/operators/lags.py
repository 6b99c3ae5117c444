"""How far a state follows behind its action, from additive moments.

Both series are put on one grid. The grid is cut into blocks that carry a few rows of their neighbours, so
velocities and shifted pairs are made within a block. A correlation is a merge of moments (count, means,
centred second moments), summed per shift over all blocks, and per shift and window for the windows; no
task holds a pair's whole series.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..session import staged
from . import asof
from .ordering import group_quantile

#: The pairs that a conversion audits (name, action stream, state stream, kind).
LAG_PAIRS = (
    ("arm.left", "action.left_arm_joint", "state.left_arm_joint", "joint"),
    ("arm.right", "action.right_arm_joint", "state.right_arm_joint", "joint"),
    ("hand.left", "action.left_hand_joint", "state.left_hand_joint", "joint"),
    ("hand.right", "action.right_hand_joint", "state.right_hand_joint", "joint"),
    ("eef.left", "action.left_eef", "state.left_eef", "pose"),
    ("eef.right", "action.right_eef", "state.right_eef", "pose"),
)


@dataclass(frozen=True)
class LagRules:
    """The audit's defaults. Times in seconds, the rate in samples per second."""

    max_lag: float = 0.3
    rate: float = 200.0
    excitation: float = 1e-3
    window: float = 3.0


#: Grid points of a block.
BLOCK_POINTS = 4096


def paired(samples: DataFrame, intervals: DataFrame, by: Sequence[str], pairs=LAG_PAIRS, t: str = "t", value: str = "v") -> tuple[DataFrame, DataFrame]:
    """(actions, states), each (by, pair, t, value): the samples of each pair inside the active interval
    (active_start to active_stop, ends included); of poses the translation."""
    table = samples.sparkSession.createDataFrame([(n, r, k, kind == "pose") for n, a, s, kind in pairs for r, k in (("action", a), ("state", s))], "pair string, role string, stream string, is_pose boolean")
    rows = samples.join(F.broadcast(table), "stream").join(intervals.select(*by, "active_start", "active_stop"), list(by))
    rows = rows.where((F.col(t) >= F.col("active_start")) & (F.col(t) <= F.col("active_stop")))
    rows = rows.withColumn(value, F.when(F.col("is_pose"), F.slice(value, 1, 3)).otherwise(F.col(value)))
    return tuple(rows.where(F.col("role") == r).select(*by, "pair", t, value) for r in ("action", "state"))


def overlaps(actions: DataFrame, states: DataFrame, by: Sequence[str], t: str, value: str, per_second: float, rate: float) -> DataFrame:
    """(by, origin, begin, n, width): the grid of what both sides cover, in seconds from the earlier first
    sample; n is null where a side has no two samples. Widths that differ raise."""
    ends = lambda df, k: df.groupBy(*by).agg(F.min(t).alias(f"{k}0"), F.max(t).alias(f"{k}1"), F.count("*").alias(f"{k}n"), F.max(F.size(value)).alias(f"{k}w"))
    both = ends(actions, "a").join(ends(states, "s"), list(by), "full")
    origin = F.least("a0", "s0")
    begin = (F.greatest("a0", "s0") - origin) / F.lit(per_second)
    points = F.ceil(((F.least("a1", "s1") - origin) / F.lit(per_second) - begin) * rate)
    usable = (F.col("an") > 1) & (F.col("sn") > 1)
    fault = F.raise_error(F.concat(F.lit("an action of "), F.col("aw"), F.lit(" dimensions has a state of "), F.col("sw"))).cast("long")
    n = F.when(usable & (F.col("aw") != F.col("sw")), fault).when(usable, points)
    return both.select(*by, origin.alias("origin"), begin.alias("begin"), n.alias("n"), F.coalesce("aw", "sw").alias("width"))


def gridded(actions: DataFrame, states: DataFrame, grids: DataFrame, by: Sequence[str], t: str, value: str, per_second: float, rate: float) -> DataFrame:
    """(by, n, i, action, state) on the grids: actions held, states interpolated."""
    points = grids.select(*by, "n", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("i"), "begin")
    points = points.select(*by, "n", "i", (F.col("begin") + F.col("i") / F.lit(float(rate))).alias("g"))
    sided = lambda df: df.join(grids.select(*by, "origin"), list(by)).select(*by, ((F.col(t) - F.col("origin")) / F.lit(per_second)).alias("g"), F.col(value).cast("array<double>").alias("v"))
    bucket = BLOCK_POINTS / rate
    held = asof.backward(points, sided(actions), by, "g", "held", bucket)
    both = asof.linear(held, sided(states), by, "g", "v", vector=True, bucket=bucket)
    return both.select(*by, "n", "i", F.col("held.v").alias("action"), F.col("v").alias("state"))


def velocity(points: Column, field: str, n: Column, rate: float) -> Column:
    """Central differences within a block's points, one-sided at the series' ends."""

    def at(x: Column, j: Column) -> Column:
        here, before, after = x[field], F.get(points, j - 1)[field], F.get(points, j + 1)[field]
        return F.when(x["i"] == 0, (after - here) * rate).when(x["i"] == n - 1, (here - before) * rate).otherwise((after - before) * (rate / 2))

    return F.transform(points, at)


def blocked(rows: DataFrame, by: Sequence[str], shifts: int, rate: float) -> DataFrame:
    """(by, axis, n, first, core, actions, states, va, vs): blocks of grid points with their velocities.
    `core` of the points are the block's own, from position `first` on; `shifts` more follow them."""
    size = max(BLOCK_POINTS, 2 * (shifts + 2))
    own, place = F.floor(F.col("i") / size), F.col("i") % size
    # Each block takes one point before its own and shifts + 1 after them.
    blocks = F.array_compact(F.array(own, F.when((place <= shifts) & (own > 0), own - 1), F.when((place == size - 1) & (F.col("i") < F.col("n") - 1), own + 1)))
    rows = rows.withColumn("block", F.explode(blocks))
    rows = rows.select(*by, "n", "i", "block", F.posexplode(F.arrays_zip("action", "state")).alias("axis", "x"))
    point = F.struct("i", F.col("x.action").alias("a"), F.col("x.state").alias("s"))
    out = rows.groupBy(*by, "axis", "n", "block").agg(F.array_sort(F.collect_list(point)).alias("points"))
    first = F.col("block") * size - F.col("points")[0]["i"]
    out = out.withColumn("first", first).withColumn("core", F.least(F.lit(size).cast("long"), F.col("n") - F.col("block") * size))
    points, n = F.col("points"), F.col("n")
    series = [F.transform("points", lambda p: p["a"]).alias("actions"), F.transform("points", lambda p: p["s"]).alias("states")]
    return out.select(*by, "axis", "n", (F.col("block") * size).alias("begin"), "first", "core", *series, velocity(points, "a", n, rate).alias("va"), velocity(points, "s", n, rate).alias("vs"))


def pairs_at(blocks: DataFrame, by: Sequence[str], shift: str, *more: str) -> DataFrame:
    """(by, axis, n, shift, i, x, y, error): velocities of action i and state i + shift, and the distance of
    their positions, for each block's own points as far as the series goes."""
    count = F.least(F.col("core"), F.col("n") - F.col("begin") - F.col(shift))
    own = lambda c: F.slice(c, F.col("first").cast("int") + 1, count.cast("int"))
    ahead = lambda c: F.slice(c, (F.col("first") + F.col(shift)).cast("int") + 1, count.cast("int"))
    zipped = F.arrays_zip(own("va").alias("x"), ahead("vs").alias("y"), own("actions").alias("p"), ahead("states").alias("q"))
    rows = blocks.where(count > 0).select(*by, "axis", "n", shift, "begin", *more, F.posexplode(zipped).alias("j", "z"))
    return rows.select(*by, "axis", "n", shift, *more, (F.col("begin") + F.col("j")).alias("i"), F.col("z.x").alias("x"), F.col("z.y").alias("y"), F.abs(F.col("z.p") - F.col("z.q")).alias("error"))


def correlations(pairs: DataFrame, keys: Sequence[str], least: float) -> DataFrame:
    """(keys, shift, moves, score): the correlation where both sides move by `least`, else null."""
    out = pairs.groupBy(*keys, "shift").agg(F.covar_pop("x", "y").alias("c"), F.stddev_pop("x").alias("sx"), F.stddev_pop("y").alias("sy"))
    moves = (F.col("sx") >= least) & (F.col("sy") >= least)
    return out.select(*keys, "shift", moves.alias("moves"), F.when(moves, F.try_divide("c", F.col("sx") * F.col("sy"))).alias("score"))


def best_shifts(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, moves, shift, corr, margin): the smallest shift of the largest score, its lead over the next
    best, and whether both sides move without a shift. A row per shift comes together for each key."""
    item = F.when(F.col("score").isNotNull(), F.struct((-F.col("score")).alias("order"), "shift"))
    out = scores.groupBy(*keys).agg(F.array_sort(F.collect_list(item)).alias("s"), F.bool_or(F.when(F.col("shift") == 0, F.col("moves"))).alias("moves"))
    best, second = F.get("s", F.lit(0)), F.get("s", F.lit(1))
    return out.select(*keys, "moves", best["shift"].alias("shift"), (-best["order"]).alias("corr"), (second["order"] - best["order"]).alias("margin"))


def window_lags(blocks: DataFrame, by: Sequence[str], rules: LagRules) -> DataFrame:
    """(by, axis, lag, centre) of half-overlapping windows in which both sides move."""
    size = max(4, round(rules.window * rules.rate))
    hop = max(1, size // 2)
    pairs = pairs_at(blocks.where(F.col("shift") <= size // 3), by, "shift")
    low = F.greatest(F.lit(0).cast("long"), F.ceil((F.col("i") + F.col("shift") - size + 1) / hop))
    high = F.least(F.floor(F.col("i") / hop), F.floor((F.col("n") - size) / hop))
    inside = pairs.where(low <= high).withColumn("w", F.explode(F.sequence(low, high)))
    found = best_shifts(correlations(inside, [*by, "axis", "w"], rules.excitation), [*by, "axis", "w"])
    found = found.where("moves and shift is not null")
    return found.select(*by, "axis", (F.col("shift") / rules.rate).alias("lag"), ((F.col("w") * hop + size / 2) / rules.rate).alias("centre"))


LAG_NUMBERS = ("lag", "corr", "margin", "agreement", "error_mean", "error_p95", "error_max", "duration", "window_median", "window_mad", "window_range", "window_trend", "window_max_step")


def lag_audit(actions: DataFrame, states: DataFrame, by: Sequence[str], t: str = "t", value: str = "v", per_second: float = 1e9, rules: LagRules = LagRules()) -> DataFrame:
    """(by, axis, LAG_NUMBERS, reason): per axis the response lag in seconds of a state behind its action.
    Both (by, t, vector) come on their own times. The shift of the largest correlation of velocities is the
    lag; beside it stand its margin over the second best, the share of moving points whose directions
    agree and the position errors at that shift, and how the lags of windows vary. The reason says why an
    axis has no lag: insufficient_overlap or insufficient_excitation. Rows without a key are left out."""
    by = list(by)
    known = " and ".join(f"`{c}` is not null" for c in by)
    actions, states = actions.where(known), states.where(known)
    grids = staged(overlaps(actions, states, by, t, value, per_second, rules.rate), "grids")
    most = round(rules.max_lag * rules.rate)
    rows = gridded(actions, states, grids.where("n >= 4"), by, t, value, per_second, rules.rate)
    blocks = staged(blocked(rows, by, most, rules.rate), "blocks")
    bound = F.least(F.lit(most).cast("long"), F.floor(F.col("n") / 3))
    shifted = blocks.withColumn("shift", F.explode(F.sequence(F.lit(0).cast("long"), bound)))
    axis = [*by, "axis"]
    best = best_shifts(correlations(pairs_at(shifted, by, "shift"), [*axis, "n"], rules.excitation), [*axis, "n"]).where("moves")
    best = staged(best.drop("moves"), "best")
    at_best = staged(pairs_at(blocks.join(best.select(*axis, "shift"), axis), by, "shift"), "pairs")
    moving = F.abs("x") + F.abs("y") > rules.excitation
    errors = at_best.groupBy(*axis).agg(
        F.avg(F.when(moving, (F.signum("x") == F.signum("y")).cast("double"))).alias("agreement"),
        F.avg("error").alias("error_mean"), F.max("error").alias("error_max"),
    )
    p95 = group_quantile(at_best.select(*axis, "error"), axis, "error", 0.95, "error_p95")
    lags = window_lags(shifted.join(best.select(*axis), axis, "left_semi"), by, rules)
    trend = window_trend(staged(lags, "windows"), axis, "centre", "lag").select(*axis, *[F.col(c).alias(f"window_{c2}") for c, c2 in (("median", "median"), ("mad", "mad"), ("range", "range"), ("slope", "trend"), ("max_step", "max_step"))])
    axes = grids.select(*by, "n", F.explode(F.sequence(F.lit(0), F.col("width") - 1)).alias("axis"))
    out = axes.join(best.drop("n"), axis, "left").join(errors, axis, "left").join(p95, axis, "left").join(trend, axis, "left")
    short = F.col("n").isNull() | (F.col("n") < 4)
    reason = F.when(short, F.lit("insufficient_overlap")).when(F.col("shift").isNull(), F.lit("insufficient_excitation"))
    out = out.withColumn("lag", F.col("shift") / rules.rate).withColumn("duration", (F.col("n") - F.col("shift")) / rules.rate)
    return out.select(*axis, *LAG_NUMBERS, reason.alias("reason"))


def consensus(lags: DataFrame, by: Sequence[str]) -> DataFrame:
    """Median of the axes that have a lag, and how many do."""
    return lags.groupBy(*by).agg(F.median("lag").alias("lag"), F.count("lag").alias("active_axes"))


def lag_correlation(df: DataFrame, by: Sequence[str], n: str, a: str, b: str, shifts: range) -> DataFrame:
    """Correlation of a at n with b at n + shift, best shift per key, the smallest on ties. Rows are
    numbered 1, 2, ... per key."""
    left = df.select(*by, F.explode(F.array(*[F.lit(s) for s in shifts])).alias("shift"), F.col(n).alias("__n"), F.col(a).alias("__a")).withColumn("__m", F.col("__n") + F.col("shift"))
    right = df.select(*by, F.col(n).alias("__m"), F.col(b).alias("__b"))
    each = left.join(right, [*by, "__m"]).groupBy(*by, "shift").agg(F.corr("__a", "__b").alias("corr"), F.count("*").alias("pairs"))
    rank = F.row_number().over(W.partitionBy(*by).orderBy(F.desc_nulls_last("corr"), "shift"))
    return each.withColumn("__r", rank).where("__r = 1").drop("__r")


def window_trend(df: DataFrame, by: Sequence[str], centre: str, lag: str) -> DataFrame:
    """Median, median absolute deviation, range, slope, and largest step of windowed lags."""
    step = F.abs(F.col(lag) - F.lag(lag).over(W.partitionBy(*by).orderBy(centre)))
    rows = df.withColumn("__step", step)
    mid = rows.groupBy(*by).agg(F.median(lag).alias("median"), (F.max(lag) - F.min(lag)).alias("range"), F.regr_slope(lag, centre).alias("slope"), F.max("__step").alias("max_step"))
    mad = rows.join(mid.select(*by, "median"), list(by)).groupBy(*by).agg(F.median(F.abs(F.col(lag) - F.col("median"))).alias("mad"))
    return mid.join(mad, list(by))
