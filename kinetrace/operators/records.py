"""Records as arrays and maps: reshaping, checks, and the merge of reports."""

from __future__ import annotations

import json
from collections.abc import Callable, Mapping, Sequence
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W


def columns_of(records: Column | str, fields: Sequence[str]) -> list[Column]:
    """An array of structs as one array per field."""
    r = F.col(records) if isinstance(records, str) else records
    return [r[f].alias(f) for f in fields]


def records_of(arrays: Mapping[str, Column | str]) -> Column:
    """Arrays of equal length as one array of structs."""
    return F.arrays_zip(*[(F.col(v) if isinstance(v, str) else v).alias(k) for k, v in arrays.items()])


def valid_only(rows: DataFrame, valid: str, lists: Sequence[str] = ()) -> DataFrame:
    """Rows whose flag is true; or, where the flag is an array, each row's lists without the places that
    it marks as invalid."""
    if not lists:
        return rows.where(F.coalesce(valid, F.lit(False)))
    keep = lambda c: F.filter(c, lambda x, i: F.coalesce(F.get(valid, i), F.lit(False)))
    return rows.withColumns({c: keep(c) for c in [*lists, valid]})


def positional_names(configured: Sequence[str], found: Sequence[str]) -> dict[str, str]:
    """Configured key -> dataset key: by name where they agree, else by position; counts must match."""
    if set(configured) <= set(found):
        return {c: c for c in configured}
    if len(configured) != len(found):
        raise ValueError(f"{len(configured)} keys are configured, the dataset has {len(found)}")
    return dict(zip(configured, found))


def shape_faults(rows: DataFrame, sizes: Mapping[str, int], by: Sequence[str] = ()) -> DataFrame:
    """Per key, how many rows have a vector of another size than expected, or none."""
    bad = [F.count_if(~F.coalesce(F.size(c) == n, F.lit(False))).alias(f"n_{c}") for c, n in sizes.items()]
    return rows.groupBy(*by).agg(*bad) if by else rows.agg(*bad)


def one_size(rows: DataFrame, by: Sequence[str], vector: str) -> DataFrame:
    """Keys whose vectors don't all have one size."""
    return rows.groupBy(*by).agg(F.count_distinct(F.size(vector)).alias("sizes")).where("sizes > 1")


#: The statistics that a complete entry holds.
STATISTICS = ("mean", "std", "min", "max", "q01", "q99")


def complete_stats(stats: Mapping, features: Sequence[str], horizon: int | None = None) -> bool:
    """All features have all statistics; with a horizon, of that many steps."""
    for f in features:
        entry = stats.get(f)
        if not entry or any(k not in entry for k in STATISTICS):
            return False
        if horizon is not None and len(entry["mean"]) != horizon:
            return False
    return True


def sampled_repeat_ratio(frames: DataFrame, by: Sequence[str], order: str, digest: str, samples: int = 100) -> DataFrame:
    """Share of evenly spaced neighbour pairs with equal payloads, of `samples` pairs at most (the
    report's own sampling)."""
    w = W.partitionBy(*by).orderBy(order)
    rows = frames.withColumn("__i", F.row_number().over(w) - 1).withColumn("__n", F.count("*").over(W.partitionBy(*by))).withColumn("__next", F.lead(digest).over(w))
    pairs = F.col("__n") - 1
    k = F.least(pairs, F.lit(samples))
    picks = F.transform(F.sequence(F.lit(0), k - 1), lambda j: F.floor(F.when(k > 1, j * (pairs - 1) / (k - 1)).otherwise(0)).cast("long"))
    chosen = rows.where("__n > 1").where(F.array_contains(picks, F.col("__i").cast("long")))
    return chosen.groupBy(*by).agg(F.avg((F.col(digest) == F.col("__next")).cast("double")).alias("ratio"), F.count("*").alias("pairs"))


def merged_reports(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(reason, n) over report lines of several files whose fields may differ."""
    out = None
    for p in paths:
        df = spark.read.json(p)
        df = df.select(df["reasons"].cast("array<string>").alias("reasons")) if "reasons" in df.columns else df.select(F.array().cast("array<string>").alias("reasons"))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.select(F.explode("reasons").alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def seeded_choice(options: Column | str, seed: int, *keys: str) -> Column:
    """One element of an array, the same for the same keys."""
    o = F.col(options) if isinstance(options, str) else options
    return F.when(F.size(o) > 0, F.get(o, F.pmod(F.xxhash64(F.lit(seed), *keys), F.size(o)).cast("int")))


def interpolated(times: np.ndarray, values: np.ndarray, at: np.ndarray, rotation: slice | None = None) -> np.ndarray:
    """A chunk at other times: rows whose time doesn't increase go; needs two rows; times outside raise.
    `rotation` marks columns of a quaternion (xyzw), which are interpolated on the sphere."""
    keep = np.concatenate([[True], times[1:] > np.maximum.accumulate(times)[:-1]])
    t, v = times[keep], values[keep]
    if len(t) < 2:
        raise ValueError("a chunk needs two rows of rising time")
    if (at < t[0]).any() or (at > t[-1]).any():
        raise ValueError("a time lies outside the chunk")
    i = np.clip(np.searchsorted(t, at, "right") - 1, 0, len(t) - 2)
    f = ((at - t[i]) / (t[i + 1] - t[i]))[:, None]
    out = v[i] + f * (v[i + 1] - v[i])
    if rotation is not None:
        a, b = v[i][:, rotation], v[i + 1][:, rotation]
        d = (a * b).sum(1, keepdims=True)
        b, d = np.where(d < 0, -b, b), np.minimum(np.abs(d), 1.0)
        th = np.arccos(d)
        s = np.where(d > 0.9995, 1.0, np.sin(th))
        q = np.where(d > 0.9995, a + f * (b - a), (np.sin((1 - f) * th) * a + np.sin(f * th) * b) / s)
        out[:, rotation] = q / np.linalg.norm(q, axis=1, keepdims=True)
    return out


def interpolated_chunks(rows: DataFrame, times: str, chunk: str, at: str, rotation: tuple[int, int] | None = None, name: str = "interpolated") -> DataFrame:
    """Each row's chunk at its own target times."""

    @F.pandas_udf("array<array<double>>")
    def run(t: pd.Series, v: pd.Series, x: pd.Series) -> pd.Series:
        part = slice(*rotation) if rotation else None
        return pd.Series([interpolated(np.asarray(a, float), np.stack([np.asarray(r, float) for r in b]), np.asarray(c, float), part).tolist() for a, b, c in zip(t, v, x)])

    return rows.withColumn(name, run(times, chunk, at))


def windows_of(rows: DataFrame, by: Sequence[str], t: str, width: int, step: int) -> DataFrame:
    """Rows with each window (number and centre) that holds them; windows start every `step`."""
    first = F.min(t).over(W.partitionBy(*by))
    rel = rows.withColumn("__r", F.col(t) - first).withColumn("__first", first)
    lo = F.greatest(F.lit(0).cast("long"), F.floor((F.col("__r") - width) / step) + 1)
    out = rel.withColumn("window", F.explode(F.sequence(lo, F.floor(F.col("__r") / step))))
    return out.withColumn("centre", F.col("__first") + F.col("window") * step + width / 2).drop("__r", "__first")


def judged(rows: DataFrame, text: str, check: Callable[[Any], object], name: str = "found") -> DataFrame:
    """rows with `name`: what `check` says of the JSON value in `text`, as a string; "error" where it raises
    ValueError or there is no JSON. Metadata of many datasets is checked where its rows lie."""

    @F.pandas_udf("string")
    def said(texts: pd.Series) -> pd.Series:
        def one(t):
            try:
                return "error" if t is None else str(check(json.loads(t)))
            except ValueError:
                return "error"

        return pd.Series([one(t) for t in texts], dtype=object)

    return rows.withColumn(name, said(F.col(text)))


def nested_paths(rows: DataFrame, path: str) -> DataFrame:
    """(outer_path, inner_path): the different absolute paths of a table of which one lies in the other, each
    pair once. Every path meets its own ancestors as equal keys; a slash at the end says nothing."""
    own = rows.where(F.col(path).isNotNull()).select(F.regexp_replace(path, "/+$", "").alias("inner_path")).distinct()
    steps = F.split("inner_path", "/")
    ends = F.when(F.size(steps) > 2, F.sequence(F.lit(2), F.size(steps) - 1)).otherwise(F.array().cast("array<int>"))
    inner = own.select("inner_path", F.explode(F.transform(ends, lambda n: F.array_join(F.slice(steps, F.lit(1), n), "/"))).alias("outer_path"))
    return inner.join(own.select(F.col("inner_path").alias("outer_path")), "outer_path").select("outer_path", "inner_path")
