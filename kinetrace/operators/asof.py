"""Time joins within a key: backward hold, nearest, bracketing interpolation, common windows.

All of them union both sides and take the last non-null source in time order, so a key needs one
shuffle and one sort, whatever the rates of the two sides. A key with very many rows can be cut into
time buckets (`bucket`): each bucket then starts with the last source before it, which a small table
of one row per bucket provides, and buckets are separate tasks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.rotations import quat_rot6d, slerp
from ..functions.vectors import lerp, part

ANCHOR, SOURCE = "__anchor", "__source"


def _both(anchors: DataFrame, source: DataFrame, by: Sequence[str], t: str, anchor_first: bool) -> DataFrame:
    kinds = (0, 1) if anchor_first else (1, 0)
    a = anchors.select(*by, F.col(t).alias("__t"), F.lit(kinds[0]).alias("__kind"), F.struct(*anchors.columns).alias(ANCHOR))
    s = source.select(*by, F.col(t).alias("__t"), F.lit(kinds[1]).alias("__kind"), F.struct(*source.columns).alias(SOURCE))
    return a.unionByName(s, allowMissingColumns=True)


def _bucketed(rows: DataFrame, source: DataFrame, by: Sequence[str], t: str, bucket: int, kind: int, both: bool) -> DataFrame:
    """rows with `__bucket`, and in each bucket a copy of the last source row before it, and with `both`
    of the first one after it."""
    rows = rows.withColumn("__bucket", F.floor(F.col("__t") / bucket))
    one = F.struct(F.col(t).alias("__t"), F.struct(*source.columns).alias("row"))
    ends = source.groupBy(*by, F.floor(F.col(t) / bucket).alias("__b")).agg(F.max(one).alias("last"), F.min(one).alias("first"))
    used = rows.select(*by, F.col("__bucket").alias("__b")).distinct().join(ends, [*by, "__b"], "left")
    order = W.partitionBy(*by).orderBy("__b")
    # Buckets backwards, since a frame that ends at the last row is read anew for each row.
    used = used.withColumn("before", F.last("last", ignorenulls=True).over(order.rowsBetween(W.unboundedPreceding, -1)))
    if both:
        used = used.withColumn("after", F.last("first", ignorenulls=True).over(W.partitionBy(*by).orderBy(F.desc("__b")).rowsBetween(W.unboundedPreceding, -1)))
    sides = F.array("before", "after") if both else F.array("before")
    carried = used.select(*by, "__b", F.explode(F.array_compact(sides)).alias("x"))
    carried = carried.select(*by, F.col("x.__t").alias("__t"), F.lit(kind).alias("__kind"), F.col("x.row").alias(SOURCE), F.col("__b").alias("__bucket"))
    return rows.unionByName(carried, allowMissingColumns=True)


def backward(anchors: DataFrame, source: DataFrame, by: Sequence[str], t: str = "t", name: str = "src", bucket: int | None = None) -> DataFrame:
    """Anchors with `name`, the struct of the last source row at or before each anchor's time, or
    null. Among source rows of equal time the largest row counts."""
    rows = _both(anchors, source, by, t, anchor_first=False)
    keys = list(by)
    if bucket:
        rows = _bucketed(rows, source, by, t, bucket, 0, both=False)
        keys.append("__bucket")
    before = W.partitionBy(*keys).orderBy("__t", "__kind", SOURCE).rowsBetween(W.unboundedPreceding, 0)
    held = rows.withColumn(name, F.last(SOURCE, ignorenulls=True).over(before))
    return held.where(F.col(ANCHOR).isNotNull()).select(f"{ANCHOR}.*", name)


def bracketed(anchors: DataFrame, source: DataFrame, by: Sequence[str], t: str = "t", left: str = "left_src", right: str = "right_src", bucket: int | None = None) -> DataFrame:
    """Anchors with the source rows strictly before and at or after each anchor's time."""
    rows = _both(anchors, source, by, t, anchor_first=True)
    keys = list(by)
    if bucket:
        rows = _bucketed(rows, source, by, t, bucket, 1, both=True)
        keys.append("__bucket")
    asc = W.partitionBy(*keys).orderBy("__t", "__kind", SOURCE).rowsBetween(W.unboundedPreceding, 0)
    # A frame that ends at the last row is read anew for each row; the same order backwards is not.
    desc = W.partitionBy(*keys).orderBy(F.desc("__t"), F.desc("__kind"), F.desc(SOURCE)).rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn(left, F.last(SOURCE, ignorenulls=True).over(asc)).withColumn(right, F.last(SOURCE, ignorenulls=True).over(desc))
    return rows.where(F.col(ANCHOR).isNotNull()).select(f"{ANCHOR}.*", left, right)


def nearest(anchors: DataFrame, source: DataFrame, by: Sequence[str], t: str = "t", name: str = "src", bucket: int | None = None) -> DataFrame:
    """The source row nearest in time; the earlier on ties; beyond the ends the first or last one."""
    both = bracketed(anchors, source, by, t, "__l", "__r", bucket)
    l, r = F.col(f"__l.{t}"), F.col(f"__r.{t}")
    pick = F.when(r.isNull() | (F.col(t) - l <= r - F.col(t)), F.col("__l")).otherwise(F.col("__r"))
    return both.withColumn(name, pick).drop("__l", "__r")


def _fraction(t: Column, l: Column, r: Column) -> Column:
    return (t - l).cast("double") / (r - l).cast("double")


def linear(anchors: DataFrame, source: DataFrame, by: Sequence[str], t: str = "t", value: str = "v", vector: bool = False, bucket: int | None = None) -> DataFrame:
    """Anchors with the value interpolated at their time, and the gap of the bracket: an exact hit
    copies the row and has gap 0; outside the source's range both are null."""
    both = bracketed(anchors, source, by, t, "__l", "__r", bucket)
    l, r = F.col(f"__l.{t}"), F.col(f"__r.{t}")
    f = _fraction(F.col(t), l, r)
    lv, rv = F.col(f"__l.{value}"), F.col(f"__r.{value}")
    between = lerp(lv, rv, f) if vector else lv + f * (rv - lv)
    hit = r == F.col(t)
    out = F.when(hit, rv).when(l.isNotNull() & r.isNotNull(), between)
    gap = F.when(hit, F.lit(0).cast("long")).when(l.isNotNull() & r.isNotNull(), r - l)
    return both.withColumn(value, out).withColumn("gap", gap).drop("__l", "__r")


def pose(anchors: DataFrame, source: DataFrame, by: Sequence[str], t: str = "t", value: str = "v", bucket: int | None = None) -> DataFrame:
    """As `linear` for poses xyz + quaternion xyzw, with spherical interpolation of the rotation; the
    result is xyz + 6D rotation."""
    both = bracketed(anchors, source, by, t, "__l", "__r", bucket)
    l, r = F.col(f"__l.{t}"), F.col(f"__r.{t}")
    f = _fraction(F.col(t), l, r)
    lv, rv = F.col(f"__l.{value}"), F.col(f"__r.{value}")
    between = F.concat(lerp(part(lv, 0, 3), part(rv, 0, 3), f), quat_rot6d(slerp(part(lv, 3, 7), part(rv, 3, 7), f)))
    exact = F.concat(part(rv, 0, 3).cast("array<double>"), quat_rot6d(part(rv, 3, 7)))
    hit = r == F.col(t)
    inside = l.isNotNull() & r.isNotNull()
    gap = F.when(hit, F.lit(0).cast("long")).when(inside, r - l)
    return both.withColumn(value, F.when(hit, exact).when(inside, between)).withColumn("gap", gap).drop("__l", "__r")


def common_window(samples: DataFrame, by: Sequence[str], stream: str = "stream", t: str = "t", start_only: Sequence[str] = (), slack: dict[str, int] | None = None) -> DataFrame:
    """Per key the interval all streams cover: the latest start and the earliest end. Streams in
    start_only bound the start alone; slack widens a stream's range on both sides."""
    wide = F.lit(0).cast("long")
    for name, by_ns in (slack or {}).items():
        wide = F.when(F.col(stream) == name, F.lit(by_ns).cast("long")).otherwise(wide)
    ends = samples.groupBy(*by, stream).agg(F.min(t).alias("lo"), F.max(t).alias("hi"))
    bound_end = ~F.col(stream).isin(list(start_only)) if start_only else F.lit(True)
    return ends.withColumn("__wide", wide).groupBy(*by).agg(
        F.max(F.col("lo") - F.col("__wide")).alias("start"),
        F.min(F.when(bound_end, F.col("hi") + F.col("__wide"))).alias("stop"),
        F.count("*").alias("n_streams"),
    )


def within(anchors: DataFrame, window: DataFrame, by: Sequence[str], t: str = "t") -> DataFrame:
    """Anchors inside their key's window, ends included; one row per key, so Spark may broadcast it."""
    return anchors.join(window.select(*by, "start", "stop"), list(by)).where((F.col(t) >= F.col("start")) & (F.col(t) <= F.col("stop"))).drop("start", "stop")


#: Steps that one row may be spread over: an array's length.
MAX_STEPS = 50_000_000


def steps_within(start: Column, stop: Column, step: Column | int, what: str) -> Column:
    """start, start + step, ... up to stop, as an array; more than MAX_STEPS of them raise."""
    step = step if isinstance(step, Column) else F.lit(step).cast("long")
    n = (stop - start) / step
    reason = F.concat(F.lit(f"{what} would have "), n.cast("long").cast("string"), F.lit(" steps: is a time zero or in another unit?"))
    return F.sequence(start, F.when(n <= MAX_STEPS, stop).otherwise(F.raise_error(reason).cast("long")), step)


def regular_grid(source: DataFrame, by: Sequence[str], t: str = "t", step: int | None = None) -> DataFrame:
    """Anchors at first + k * step up to the last sample; the step is the rounded median interval of
    the key where none is given."""
    order = W.partitionBy(*by).orderBy(t)
    gaps = source.withColumn("__dt", F.col(t) - F.lag(t).over(order))
    width = F.lit(step).cast("long") if step else F.rint(F.percentile(F.when(F.col("__dt") > 0, F.col("__dt")), 0.5)).cast("long")
    ends = gaps.groupBy(*by).agg(F.min(t).alias("__a"), F.max(t).alias("__b"), width.alias("__step")) if not step else gaps.groupBy(*by).agg(F.min(t).alias("__a"), F.max(t).alias("__b")).withColumn("__step", F.lit(step).cast("long"))
    return ends.where("__step > 0").select(*by, F.posexplode(steps_within(F.col("__a"), F.col("__b"), F.col("__step"), "a grid")).alias("k", t))


def resampled(source: DataFrame, by: Sequence[str], t: str = "t", value: str = "v", step: int | None = None) -> DataFrame:
    return linear(regular_grid(source, by, t, step), source.select(*by, t, value), by, t, value)


def first_in_bucket(samples: DataFrame, by: Sequence[str], t: str, width: int, cols: Sequence[str]) -> DataFrame:
    """One sample per time bucket since the key's first: the first in each, repeated over buckets
    that have none until the next one."""
    first = F.min(t).over(W.partitionBy(*by))
    rows = samples.withColumn("bucket", F.floor((F.col(t) - first) / width))
    heads = rows.groupBy(*by, "bucket").agg(F.min(F.struct(t, *cols)).alias("x"))
    after = F.lead("bucket").over(W.partitionBy(*by).orderBy("bucket"))
    heads = heads.withColumn("__next", F.coalesce(after, F.col("bucket") + 1))
    return heads.select(*by, F.explode(F.sequence("bucket", F.col("__next") - 1)).alias("bucket"), F.col(f"x.{t}").alias(t), *[F.col(f"x.{c}").alias(c) for c in cols])


def in_intervals(points: DataFrame, intervals: DataFrame, by: Sequence[str], at: str, start: str, stop: str, width: int = 64) -> DataFrame:
    """Points with each interval [start, stop) of their key that holds them. Intervals are dealt to
    the blocks of `width` units that they touch, so the join is an equi-join by key and block."""
    p = points.withColumn("__block", F.floor(F.col(at) / width))
    i = intervals.where(F.col(start) < F.col(stop)).withColumn("__block", F.explode(steps_within(F.floor(F.col(start) / width), F.floor((F.col(stop) - 1) / width), 1, "an interval")))
    return p.join(i, [*by, "__block"]).where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("__block")
