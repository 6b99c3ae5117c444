"""Operators over ordered samples of a key: differences, smoothing, runs, unwrapping, chunks."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from ..functions.vectors import dot, max_abs, minus, norm, scaled
from .scans import row_numbers, running_total


def ordered(by: Sequence[str], *order: str):
    return W.partitionBy(*by).orderBy(*order)


def difference(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, name: str = "diff") -> DataFrame:
    return df.withColumn(name, F.col(value) - F.lag(value).over(ordered(by, *order)))


def speed(df: DataFrame, by: Sequence[str], t: str, value: str, per_second: float, vector: bool = False, l2: bool = False) -> DataFrame:
    """Speed between neighbours at the middle of their times (`t_mid`, `speed`). Keys with a time step
    that is not positive give no rows."""
    w = ordered(by, t)
    before, dt = F.lag(value).over(w), F.col(t) - F.lag(t).over(w)
    rows = df.withColumn("__dt", dt).withColumn("__before", before)
    bad = F.max(F.when(F.col("__dt") <= 0, 1).otherwise(0)).over(W.partitionBy(*by))
    rows = rows.withColumn("__bad", bad).where("__dt is not null and __bad = 0")
    step = (norm if l2 else max_abs)(minus(value, "__before")) if vector else F.abs(F.col(value) - F.col("__before"))
    return rows.withColumn("speed", step / (F.col("__dt") / per_second)).withColumn("t_mid", F.col(t) - F.col("__dt") / 2).drop("__dt", "__before", "__bad")


def windowed_mean(df: DataFrame, by: Sequence[str], t: str, value: str, width: int, name: str = "mean") -> DataFrame:
    """Mean over [t - width / 2, t + width / 2], both ends included."""
    half = width // 2
    return df.withColumn(name, F.avg(value).over(ordered(by, t).rangeBetween(-half, half)))


def sliding_mean_valid(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, n: int, name: str = "mean") -> DataFrame:
    """Means of n neighbours, where all n are there; a shorter key gives its one mean."""
    w = ordered(by, *order)
    size, i = F.count("*").over(W.partitionBy(*by)), F.row_number().over(w)
    rows = df.withColumn(name, F.avg(value).over(w.rowsBetween(0, n - 1))).withColumn("__n", size).withColumn("__i", i)
    return rows.where(F.col("__i") <= F.greatest(F.lit(1), F.col("__n") - n + 1)).drop("__n", "__i")


def gradient(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, step: float = 1.0, name: str = "gradient") -> DataFrame:
    """Central differences; one-sided at the ends."""
    w = ordered(by, *order)
    x, a, b = F.col(value), F.lag(value).over(w), F.lead(value).over(w)
    return df.withColumn(name, F.when(a.isNull(), (b - x) / step).when(b.isNull(), (x - a) / step).otherwise((b - a) / (2 * step)))


def run_ids(df: DataFrame, by: Sequence[str], order: Sequence[str], fresh: Column, name: str = "run", bucket: int | None = None) -> DataFrame:
    """Numbers runs: a row where `fresh` holds starts one. With `bucket`, of the order's first column, a key
    is cut into time buckets."""
    return running_total(df, by, order, lambda before: F.when(fresh, 1).otherwise(0), name, bucket)


def longest_run(df: DataFrame, by: Sequence[str], order: Sequence[str], flag: Column, name: str = "longest") -> DataFrame:
    """Per key the longest run of rows whose flag is true."""
    rows = run_ids(df.withColumn("__flag", F.coalesce(flag, F.lit(False))), by, order, ~F.coalesce(flag, F.lit(False)), "__run")
    each = rows.groupBy(*by, "__run").agg(F.sum(F.col("__flag").cast("long")).alias("__n"))
    return each.groupBy(*by).agg(F.max("__n").alias(name))


def frozen_run(df: DataFrame, by: Sequence[str], order: Sequence[str], digest: str, name: str = "frozen") -> DataFrame:
    """Per key the longest run of equal neighbours, 0 if none has two rows."""
    before = F.lag(digest).over(ordered(by, *order))
    rows = df.withColumn("__fresh", before.isNull() | (before != F.col(digest)))
    rows = run_ids(rows, by, order, F.col("__fresh"), "__run")
    each = rows.groupBy(*by, "__run").agg(F.count("*").alias("__n"))
    return each.groupBy(*by).agg(F.max(F.when(F.col("__n") >= 2, F.col("__n")).otherwise(0)).alias(name))


def reused(df: DataFrame, by: Sequence[str], order: Sequence[str], source: str, name: str = "reused") -> DataFrame:
    return df.withColumn(name, F.coalesce(F.col(source) == F.lag(source).over(ordered(by, *order)), F.lit(False)))


def unwrapped(df: DataFrame, by: Sequence[str], order: Sequence[str], angle: str, name: str = "unwrapped", bucket: int | None = None) -> DataFrame:
    """Angles without jumps over half a turn: each jump turns all that follows by whole turns. With
    `bucket`, of the order's first column, a key is cut into time buckets."""

    def turns(before: Column) -> Column:
        d = F.col(angle) - before[angle]
        own = -F.floor((d + F.pi()) / (2 * F.pi()))
        # Half a turn upwards stays as it is.
        own = F.when((own == -1) & (d == F.pi()), 0).otherwise(own)
        return F.coalesce(F.when(F.abs(d) > F.pi(), own), F.lit(0))

    rows = running_total(df, by, order, turns, "__turns", bucket, [angle])
    return rows.withColumn(name, F.col(angle) + 2 * F.pi() * F.col("__turns")).drop("__turns")


def sign_continuous(df: DataFrame, by: Sequence[str], order: Sequence[str], q: str, name: str = "continuous", bucket: int | None = None) -> DataFrame:
    """Quaternions turned so that each has no negative product with the one before: the sign is the
    parity of the negative products so far. With `bucket`, of the order's first column, a key is cut into
    time buckets."""
    rows = running_total(df, by, order, lambda before: F.when(dot(q, before[q]) < 0, 1).otherwise(0), "__flips", bucket, [q])
    return rows.withColumn("__sign", 1.0 - 2.0 * (F.col("__flips") % 2)).withColumn(name, scaled(q, F.col("__sign"))).drop("__flips", "__sign")


#: Rows of a key that one closed form covers, at most.
EMA_BLOCK = 512


def ema(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, alpha: float, name: str = "ema", bucket: int | None = None) -> DataFrame:
    """y = (1 - alpha) y + alpha x from the first value on, one row per key's sample (`n` from 1); rows
    without a value are left out. Within a block, y is a weighted running sum; a block starts from
    where the one before ends, which a table of one row per block carries over."""
    if not 0 < alpha <= 1:
        raise ValueError("alpha must lie in (0, 1]")
    rest = 1.0 - alpha
    rows = df.where(F.col(value).isNotNull()).select(*by, *order, F.col(value).cast("double").alias("__x"))
    rows = row_numbers(rows, by, order, "n", bucket)
    if rest == 0:
        return rows.select(*by, "n", *order, F.col("__x").alias(name))
    size = max(1, min(EMA_BLOCK, int(600 / -math.log(rest))))  # so that no weight leaves a double's range
    rows = rows.withColumn("__b", F.floor((F.col("n") - 1) / size)).withColumn("__i", ((F.col("n") - 1) % size).cast("double"))
    weight = F.when(F.col("n") == 1, 1.0).otherwise(alpha) * F.pow(F.lit(1 / rest), F.col("__i"))
    so_far = W.partitionBy(*by, "__b").orderBy("n").rowsBetween(W.unboundedPreceding, 0)
    rows = rows.withColumn("__y", F.pow(F.lit(rest), F.col("__i")) * F.sum(F.col("__x") * weight).over(so_far))
    ends = rows.groupBy(*by, "__b").agg(F.max_by("__y", "n").alias("__end")).groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("__b", "__end"))).alias("__e"))
    start = F.struct(F.lit(0.0).alias("y"), F.array().cast("array<double>").alias("out"))
    step = lambda acc, e: F.struct((acc["y"] * rest**size + e["__end"]).alias("y"), F.concat(acc["out"], F.array(acc["y"])).alias("out"))
    carried = ends.withColumn("__c", F.aggregate("__e", start, step, lambda acc: acc["out"]))
    carried = carried.select(*by, F.explode(F.arrays_zip("__e", "__c")).alias("z")).select(*by, F.col("z.__e.__b").alias("__b"), F.col("z.__c").alias("__before"))
    out = rows.join(carried, [*by, "__b"])
    return out.select(*by, "n", *order, (F.col("__y") + F.col("__before") * F.pow(F.lit(rest), F.col("__i") + 1)).alias(name))


def history(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, deltas: Sequence[int], name: str = "history") -> DataFrame:
    """Values at fixed offsets back in time, the first value where there is none yet."""
    w = ordered(by, *order)
    first = F.first(value).over(w.rowsBetween(W.unboundedPreceding, 0))
    return df.withColumn(name, F.array(*[F.coalesce(F.lag(value, -d).over(w), first) if d else F.col(value) for d in deltas]))


def chunks(df: DataFrame, by: Sequence[str], order: Sequence[str], value: str, horizon: int, pad: bool = True, every: int = 1, name: str = "chunk") -> DataFrame:
    """The value of each row and the horizon - 1 after it; padded with the key's last value, or cut.
    With `every`, rows whose position is a multiple of it only."""
    w = ordered(by, *order)
    # A struct is null beyond the end alone, whatever the value.
    one = F.struct(F.col(value).alias("x"))
    ahead = F.array(one, *[F.lead(one, k).over(w) for k in range(1, horizon)])
    rows = df.withColumn("__ahead", ahead).withColumn("__pos", F.row_number().over(w) - 1).withColumn("__got", F.array_compact("__ahead").getField("x")).drop("__ahead")
    if pad:
        rows = rows.withColumn(name, F.concat("__got", F.array_repeat(F.element_at("__got", -1), F.lit(horizon) - F.size("__got"))))
    else:
        rows = rows.withColumn(name, F.col("__got"))
    return rows.where(F.col("__pos") % every == 0).drop("__got", "__pos")


def delta_gather(df: DataFrame, by: Sequence[str], step: str, value: str, deltas: Sequence[int], boundary: str = "clamp") -> DataFrame:
    """Rows (by, step, delta, value) of each step's neighbours at fixed offsets. Steps are 0, 1, ... per
    key; beyond the ends `clamp` takes the end's row, `wrap` counts from the other end, and `error`
    raises."""
    size = df.groupBy(*by).agg(F.count("*").alias("__n"))
    base = df.select(*by, step).join(size, list(by)).withColumn("delta", F.explode(F.array(*[F.lit(d) for d in deltas])))
    want = F.col(step) + F.col("delta")
    if boundary == "clamp":
        want = F.greatest(F.lit(0).cast("long"), F.least(F.col("__n") - 1, want))
    elif boundary == "wrap":
        want = F.when(want < 0, want + F.col("__n")).otherwise(want)
    elif boundary == "error":
        want = F.when((want < 0) | (want >= F.col("__n")), F.raise_error(F.lit("a step lies outside its episode"))).otherwise(want)
    else:
        raise ValueError(f"unknown boundary {boundary!r}: clamp, wrap, error")
    rows = df.select(*by, F.col(step).alias("__at"), value)
    return base.withColumn("__at", want).join(rows, [*by, "__at"]).select(*by, step, "delta", value)


def relative_chunk(chunk: str | Column, reference: Column | None = None) -> Column:
    """Each vector of a chunk minus the reference, which is the first vector where none is given."""
    chunk = F.col(chunk) if isinstance(chunk, str) else chunk
    base = F.get(chunk, F.lit(0)) if reference is None else reference
    return F.transform(chunk, lambda v: minus(v, base))


def delta_chunk(chunk: str | Column, reference: Column | None = None) -> Column:
    """Each vector minus the one before; the first minus the reference or itself."""
    chunk = F.col(chunk) if isinstance(chunk, str) else chunk
    base = F.get(chunk, F.lit(0)) if reference is None else reference
    return F.transform(chunk, lambda v, i: minus(v, F.when(i == 0, base).otherwise(F.get(chunk, i - 1))))


def absolute_chunk(chunk: str | Column, reference: Column) -> Column:
    chunk = F.col(chunk) if isinstance(chunk, str) else chunk
    return F.transform(chunk, lambda v: F.zip_with(v, reference, lambda a, b: a + b))


def done_episodes(df: DataFrame, by: Sequence[str], order: Sequence[str], done: str, name: str = "episode") -> DataFrame:
    """Numbers the episodes of a stream that a flag ends."""
    w = ordered(by, *order)
    before = F.lag(F.col(done).cast("int")).over(w)
    rows = df.withColumn("__before", F.coalesce(before, F.lit(0)))
    return rows.withColumn(name, F.sum("__before").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("__before")


def activity_interval(speeds: DataFrame, ranges: DataFrame, by: Sequence[str], threshold: float | str, width: int, padding: int, t: str = "t_mid", value: str = "speed", stream: str = "stream") -> DataFrame:
    """Per key the span of times whose windowed mean speed on any stream reaches the threshold (a number,
    or the name of a column), clipped to the common range (start, stop), and that span padded and clipped again. Keys without
    such a time, or whose span is empty, have no row."""
    mean = windowed_mean(speeds.withColumn("__t", F.col(t).cast("long")), [*by, stream], "__t", value, width, "__mean")
    limit = F.col(threshold) if isinstance(threshold, str) else F.lit(threshold)
    active = mean.where(F.col("__mean") >= limit).groupBy(*by).agg(F.min("__t").alias("__a"), F.max("__t").alias("__b"))
    j = active.join(ranges.select(*by, "start", "stop"), list(by))
    a, b = F.greatest("__a", "start"), F.least("__b", "stop")
    j = j.withColumn("active_start", a).withColumn("active_stop", b)
    j = j.withColumn("padded_start", F.greatest(a - padding, F.col("start"))).withColumn("padded_stop", F.least(b + padding, F.col("stop")))
    return j.where("active_start < active_stop").select(*by, "active_start", "active_stop", "padded_start", "padded_stop")


def motion_window(df: DataFrame, by: Sequence[str], order: str, signals: dict[str, float], n: int, minimum: int = 1) -> DataFrame:
    """Legacy motion trim: the largest of the signals over their thresholds, averaged over n rows, above
    1. Returns start and stop (exclusive) row positions per key; the whole key where nothing moves or
    the span is shorter than `minimum`."""
    top = F.greatest(*[F.col(c) / t for c, t in signals.items()]) if len(signals) > 1 else [F.col(c) / t for c, t in signals.items()][0]
    w = ordered(by, order)
    rows = df.withColumn("__top", top).withColumn("__pos", F.row_number().over(w) - 1)
    size = rows.groupBy(*by).agg(F.count("*").alias("__n"))
    means = sliding_mean_valid(rows.where("__top is not null"), by, [order], "__top", n, "__mean")
    hit = means.where("__mean > 1").groupBy(*by).agg(F.min("__pos").alias("__a"), (F.max("__pos") + n).alias("__b"))
    j = size.join(hit, list(by), "left")
    stop = F.least(F.col("__b"), F.col("__n"))
    good = F.col("__a").isNotNull() & (stop - F.col("__a") >= minimum)
    return j.select(*by, F.when(good, F.col("__a")).otherwise(0).cast("long").alias("start"), F.when(good, stop).otherwise(F.col("__n")).cast("long").alias("stop"))
