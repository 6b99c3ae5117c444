"""Statistics as mergeable states: moments, a KLL sketch for quantiles and an HLL sketch for distinct values.

A state is one row of bounded size per key, whatever number of rows it stands for, so datasets are summed
up once and any union of them is read from their states. Null and NaN components don't count; a key
without any other keeps a state with n = 0, whose statistics are null.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: KLL's parameter: a state takes some tens of KB, and with 99 per cent confidence the rank of a quantile
#: is off by no more than RANK_ERROR of the rows.
KLL_K = 2000
RANK_ERROR = 0.003
#: Bits of an HLL register's index: the estimate's standard error is about 1.04 / 2^(HLL_BITS / 2) of it.
HLL_BITS = 14
#: What a state keeps: `m2` is the sum of squared deviations from the mean.
STATE = ("n", "mean", "m2", "min", "max", "quantiles", "distinct")


def states(df: DataFrame, x: str, by: Sequence[str] = (), k: int = KLL_K, bits: int = HLL_BITS) -> DataFrame:
    """(by..., STATE). Partial states are made before the shuffle: what travels is a state per task and key."""
    v = F.col("__x")
    rows = df.select(*by, F.col(x).cast("double").alias("__x")).withColumn("__x", F.when(~F.isnan(v), v))
    return rows.groupBy(*by).agg(
        F.count(v).alias("n"),
        F.avg(v).alias("mean"),
        F.coalesce(F.var_pop(v) * F.count(v), F.lit(0.0)).alias("m2"),
        F.min(v).alias("min"),
        F.max(v).alias("max"),
        F.kll_sketch_agg_double(v, F.lit(k)).alias("quantiles"),
        F.hll_sketch_agg(F.when(v.isNotNull(), F.xxhash64(v + 0.0)), F.lit(bits)).alias("distinct"),
    )


def vector_states(df: DataFrame, vector: str, by: Sequence[str] = (), k: int = KLL_K, bits: int = HLL_BITS) -> DataFrame:
    """The same per dimension `dim` of a column of vectors."""
    rows = df.select(*by, F.posexplode(F.col(vector).cast("array<double>")).alias("dim", "__v"))
    return states(rows, "__v", [*by, "dim"], k, bits)


def _merging(k: int) -> list[Column]:
    n, mean = F.col("n"), F.col("mean")
    whole = F.sum(n * mean) / F.sum(n)
    between = F.sum(n * mean * mean) - F.sum(n) * whole * whole
    return [
        F.sum(n).alias("n"),
        F.try_divide(F.sum(n * mean), F.sum(n)).alias("mean"),
        (F.sum("m2") + F.greatest(F.lit(0.0), F.coalesce(between, F.lit(0.0)))).alias("m2"),
        F.min("min").alias("min"),
        F.max("max").alias("max"),
        F.kll_merge_agg_double("quantiles", F.lit(k)).alias("quantiles"),
        F.hll_union_agg("distinct").alias("distinct"),
    ]


def merged(held: DataFrame, by: Sequence[str] = (), k: int = KLL_K) -> DataFrame:
    """States of the unions of all rows that share `by`: any subset of the keys they were made with."""
    return held.groupBy(*by).agg(*_merging(k))


def rolled_up(held: DataFrame, by: Sequence[str], k: int = KLL_K) -> DataFrame:
    """States of every subset of `by` from the finest ones, so that a cube reads its rows once.
    Keys left out are null; `grouping_id` tells them from nulls in the data."""
    return held.cube(*by).agg(F.grouping_id().alias("grouping_id"), *_merging(k))


def read(held: DataFrame, fractions: Mapping[str, float] | None = None) -> DataFrame:
    """The statistics that states stand for: the keys, n, mean, std, min, max, a quantile for each of
    `fractions` (q01 and q99), and `n_distinct`."""
    fractions = fractions or {"q01": 0.01, "q99": 0.99}
    keys = [c for c in held.columns if c not in STATE]
    some = F.col("n") > 0
    q = [F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(float(f)))).alias(name) for name, f in fractions.items()]
    std = F.when(some, F.sqrt(F.col("m2") / F.col("n"))).alias("std")
    return held.select(*keys, "n", "mean", std, "min", "max", *q, F.hll_sketch_estimate("distinct").alias("n_distinct"))


def share_upto(x: float | Column) -> Column:
    """The share of a state's rows that are at most x, null for an empty state."""
    return F.when(F.col("n") > 0, F.kll_sketch_get_rank_double("quantiles", x if isinstance(x, Column) else F.lit(float(x))))
