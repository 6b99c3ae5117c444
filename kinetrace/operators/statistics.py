"""Statistics of vector columns, their merge, and evaluation reductions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .ordering import group_numbers


def _six(x: Column, exact: bool) -> list[Column]:
    q = F.percentile(x, F.array(F.lit(0.01), F.lit(0.99))) if exact else F.percentile_approx(x, [0.01, 0.99], 10000)
    return [F.avg(x).alias("mean"), F.stddev_pop(x).alias("std"), F.min(x).alias("min"), F.max(x).alias("max"), q.alias("__q")]


def vector_stats(df: DataFrame, vector: str, by: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """(by..., dim, n, mean, std, min, max, q01, q99) with population std and interpolated quantiles.
    Quantiles are sketches of bounded size; exact ones keep each dimension's distinct values while
    aggregating, which suits small tables."""
    rows = df.select(*by, F.posexplode(F.col(vector).cast("array<double>")).alias("dim", "__x"))
    out = rows.groupBy(*by, "dim").agg(F.count("__x").alias("n"), *_six(F.col("__x"), exact))
    return out.select(*by, "dim", "n", "mean", "std", "min", "max", F.get("__q", F.lit(0)).alias("q01"), F.get("__q", F.lit(1)).alias("q99"))


def chunk_stats(df: DataFrame, chunk: str, by: Sequence[str] = (), exact: bool = False) -> DataFrame:
    """The same per (step, dim) of a column of chunks."""
    steps = df.select(*by, F.posexplode(chunk).alias("step", "__v"))
    return vector_stats(steps, "__v", [*by, "step"], exact)


def as_vectors(stats: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One row per key with each statistic as a vector ordered by dimension."""
    names = [c for c in ("mean", "std", "min", "max", "q01", "q99") if c in stats.columns]
    packed = stats.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct("dim", *names))).alias("__s"))
    return packed.select(*by, *[F.col(f"__s.{c}").alias(c) for c in names])


def merged_stats(stats: DataFrame, weight: str, by: Sequence[str]) -> DataFrame:
    """Statistics of a weighted mixture of datasets: weights are normalised per key; the quantiles of
    a mixture are bounded by the smallest and largest. Entries without a mean don't count."""
    s = stats.where(F.col("mean").isNotNull())
    w = F.col(weight)
    total = F.sum(w)
    mean = F.sum(w * F.col("mean")) / total
    second = F.sum(w * (F.col("std") * F.col("std") + F.col("mean") * F.col("mean"))) / total
    out = s.groupBy(*by).agg(mean.alias("mean"), second.alias("__m2"), F.min("min").alias("min"), F.max("max").alias("max"), F.min("q01").alias("q01"), F.max("q99").alias("q99"))
    return out.withColumn("std", F.sqrt(F.greatest(F.lit(0.0), F.col("__m2") - F.col("mean") * F.col("mean")))).drop("__m2")


def errors(pairs: DataFrame, predicted: str, truth: str, by: Sequence[str]) -> DataFrame:
    """Mean squared and absolute error per trajectory over steps and dimensions."""
    rows = pairs.select(*by, F.explode(F.arrays_zip(F.col(predicted).alias("p"), F.col(truth).alias("t"))).alias("z"))
    d = F.col("z.p").cast("double") - F.col("z.t").cast("double")
    return rows.groupBy(*by).agg(F.avg(d * d).alias("mse"), F.avg(F.abs(d)).alias("mae"))


def mean_errors(per_trajectory: DataFrame) -> DataFrame:
    """Each trajectory counts once."""
    return per_trajectory.agg(F.avg("mse").alias("mse"), F.avg("mae").alias("mae"), F.count("*").alias("n"))


def masked_mean(error: Column, mask: Column) -> Column:
    return F.sum(error * mask) / (F.sum(mask) + F.lit(1e-6))


def token_accuracy(df: DataFrame, by: Sequence[str], order: Sequence[str], predicted: str, label: str, ignored: int = -100) -> DataFrame:
    """Predictions against the next row's label; ignored labels don't count. Partial sums per key."""
    nxt = F.lead(label).over(W.partitionBy(*by).orderBy(*order))
    rows = df.withColumn("__next", nxt).where((F.col("__next").isNotNull()) & (F.col("__next") != ignored))
    return rows.groupBy(*by).agg(F.count("*").alias("n"), F.count_if(F.col(predicted) == F.col("__next")).alias("correct"))


def rollouts(df: DataFrame, by: Sequence[str], order: str, success: str, reward: str, progress: str, score: str, valid: str) -> DataFrame:
    """Per episode: any success, sums, the last progress, the best score, and whether all steps were
    valid."""
    return df.groupBy(*by).agg(
        F.bool_or(success).alias("success"),
        F.sum(reward).alias("reward"),
        F.count("*").alias("steps"),
        F.max_by(progress, order).alias("progress"),
        F.max(score).alias("best"),
        F.bool_and(valid).alias("valid"),
    )


def reward_over(mode: str, reward: str | Column) -> Column:
    kinds = {"max": F.max, "min": F.min, "mean": F.avg, "sum": F.sum}
    if mode not in kinds:
        raise ValueError(f"unknown reward aggregation {mode!r}: {', '.join(sorted(kinds))}")
    return kinds[mode](reward)


def median_fps(df: DataFrame, by: Sequence[str], t: str, per_second: float, default: float = 30.0) -> DataFrame:
    """Frames per second by the median positive step of each episode."""
    dt = F.col(t) - F.lag(t).over(W.partitionBy(*by).orderBy(t))
    rows = df.withColumn("__dt", dt)
    median = F.percentile(F.when(F.col("__dt") > 0, F.col("__dt")), 0.5)
    return rows.groupBy(*by).agg(F.coalesce(F.lit(per_second) / median, F.lit(default)).alias("fps"))


def nearest_ranks(df: DataFrame, by: Sequence[str], x: str, fractions: dict[str, float]) -> DataFrame:
    """Per key and named fraction f the value sorted[round(f * (n - 1))], halves to even. Rows are
    numbered by ranges of the order, so one key may hold them all, and of each key only those asked for go on."""
    rows = df.where(F.col(x).isNotNull()).select(*by, F.col(x).alias("__x"), F.monotonically_increasing_id().alias("__place"))
    rows = group_numbers(rows, by, ["__x", "__place"], "__r", "__n")
    at = {name: F.rint(F.lit(f) * (F.col("__n") - 1)) == F.col("__r") for name, f in fractions.items()}
    wanted = None
    for hit in at.values():
        wanted = hit if wanted is None else wanted | hit
    return rows.where(wanted).groupBy(*by).agg(*[F.max(F.when(hit, F.col("__x"))).alias(name) for name, hit in at.items()])


def spread(x: str | Column) -> list[Column]:
    """min, p50, p95, max with interpolated percentiles."""
    return [F.min(x).alias("min"), F.percentile(x, 0.5).alias("p50"), F.percentile(x, 0.95).alias("p95"), F.max(x).alias("max")]


def sliced_stats(stats: DataFrame, layout: dict[str, tuple[int, int]]) -> DataFrame:
    """Statistics of each named range of a vector, dimensions counted from the range's start."""
    table = [F.struct(F.lit(n).alias("group"), F.lit(a).alias("a"), F.lit(b).alias("b")) for n, (a, b) in layout.items()]
    rows = stats.withColumn("__g", F.explode(F.array(*table))).where("dim >= __g.a and dim < __g.b")
    rest = [c for c in stats.columns if c != "dim"]
    return rows.select(F.col("__g.group").alias("group"), (F.col("dim") - F.col("__g.a")).alias("dim"), *rest)
