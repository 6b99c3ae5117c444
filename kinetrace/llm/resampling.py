"""Importance resampling towards a target's distribution of hashed n-grams.

Each partition's texts become arrays of word ids, and the suffixes of these, as far as the longest n-gram
reaches, are sorted. A run of neighbours with a common prefix of k words is one repeated k-gram: it is
hashed once, and its bucket goes back to all places where it stands. Buckets are counted over the whole
corpus and the whole target; a document's weight is the sum of its features' gains, log ratios of smoothed
bucket shares; seeded Gumbel noise turns the highest scores into a draw without replacement.

Defined cases: a null or empty text has no features and weight 0; a document with fewer than `min_words`
words has a score but is never drawn; a null doc_id draws noise as an empty one and comes before
others in ties; rows that repeat a doc_id are rows of their own, with the same noise; long texts are read in parts that
overlap by the longest n-gram; an empty corpus gives an empty result, an empty target gains that say so;
further columns are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.ordering import numbered
from .common import Scratch, dense
from .words import BLOCK, Block, blocks, classes

#: Words are runs of digits, letters and characters beyond ASCII.
SIGNS = bytes(b for b in range(128) if not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122))
KIND = classes(SIGNS)


@dataclass(frozen=True)
class Options:
    order: int = 1
    buckets: int = 10_000
    percent: int = 10
    min_words: int = 20
    seed: int = 2024


def suffix_array(ids: np.ndarray, ends: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first `order` ids, none beyond its text's end, and for each the length
    of the prefix shared with the one before (0 for the first)."""
    n = len(ids)
    keys = []
    for k in range(order):
        key = np.full(n, -1, np.int64)
        key[: n - k] = np.where(np.arange(k, n) < ends[: n - k], ids[k:], -1)
        keys.append(key)
    suffixes = np.argsort(ids, kind="stable") if order == 1 else np.lexsort(keys[::-1])
    shared, alike = np.zeros(n, np.int64), np.ones(max(n - 1, 0), bool)
    for key in keys:
        own = key[suffixes]
        alike &= (own[1:] == own[:-1]) & (own[1:] >= 0)
        shared[1:] += alike
    return suffixes, shared


def runs(block: Block, order: int, buckets: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each n-gram size (the places of all n-grams, sorted by n-gram; where each run starts among
    them; how long it is; its bucket). A run is hashed once."""
    ids, _ = block.ids()
    ends = block.bounds[1:][block.unit] if len(ids) else ids
    suffixes, shared = suffix_array(ids, ends, order)
    data = memoryview(np.ascontiguousarray(block.data))
    for k in range(1, order + 1):
        long = suffixes + k <= ends[suffixes]
        # The next suffix of k words or more: shorter ones between two of a run would cut its prefix too.
        place, starts = suffixes[long], np.flatnonzero(shared[long] < k)
        first = place[starts]
        sizes = np.diff(np.append(starts, len(place)))
        crc = [zlib.crc32(data[a:b]) for a, b in zip(block.at[first].tolist(), (block.at[first + k] - 1).tolist())]
        yield place, starts, sizes, np.array(crc, np.int64) % buckets


def fresh_places(block: Block, place: np.ndarray, k: int) -> np.ndarray | None:
    """Which n-grams no earlier part has counted; None for all."""
    context = np.fromiter((u.context for u in block.units), np.int64, len(block.units))
    if not context.any():
        return None
    return place + k > (block.bounds[:-1] + context)[block.unit[place]]


def bucket_counts(texts: DataFrame, options: Options, limit: int = BLOCK) -> np.ndarray:
    """Features in each bucket, over all texts; each task sends one row a bucket at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(options.buckets, np.int64)
        for block in blocks(batches, 0, KIND, lambda b: [None] * b.num_rows, limit, options.order - 1):
            for k, (place, starts, sizes, bucket) in enumerate(runs(block, options.order, options.buckets), 1):
                new = fresh_places(block, place, k)
                if new is not None and len(starts):
                    sizes = np.add.reduceat(new.astype(np.int64), starts)
                total += np.bincount(bucket, sizes, options.buckets).astype(np.int64)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(total[at])], names=["bucket", "n"])

    found = dense(texts.select("text")).mapInArrow(run, "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(options.buckets, np.int64)
    out[found["bucket"].to_numpy(np.int64)] = found["n"].to_numpy(np.int64)
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * log of the smoothed share in the target over that in the corpus), a bucket each."""
    n, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [(float(t + 1) * float(s_all + n)) / (float(s + 1) * float(t_all + n)) for s, t in zip(corpus.tolist(), target.tolist())]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, options: Options, limit: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_features, weight) of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)
    schema = docs.select("doc_id", F.lit(0).cast("long").alias("n_words"), F.lit(0).cast("long").alias("n_features"), F.lit(0).cast("long").alias("weight")).schema

    def sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
        return total[bounds[1:]] - total[bounds[:-1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, open_ = shared.value, np.zeros(3, np.int64)
        ids = None

        def tags(batch: pa.RecordBatch) -> list:
            nonlocal ids
            ids = batch.schema.field(0).type
            return batch.column(0).to_pylist()

        for block in blocks(batches, 1, KIND, tags, limit, options.order - 1):
            context = np.fromiter((u.context for u in block.units), np.int64, len(block.units))
            out = np.stack([np.diff(block.bounds) - context, np.zeros_like(context), np.zeros_like(context)])
            for k, (place, starts, sizes, bucket) in enumerate(runs(block, options.order, options.buckets), 1):
                value, have = np.zeros(len(block), np.int64), np.zeros(len(block), np.int64)
                value[place], have[place] = np.repeat(gain[bucket], sizes), 1
                new = fresh_places(block, place, k)
                if new is not None:
                    value[place[~new]] = have[place[~new]] = 0
                out[1] += sums(have, block.bounds)
                out[2] += sums(value, block.bounds)
            out[:, 0] += open_  # the parts so far of a long text
            whole = np.fromiter((u.last for u in block.units), bool, len(block.units))
            open_ = np.zeros(3, np.int64) if whole[-1] else out[:, -1].copy()
            yield pa.RecordBatch.from_arrays([pa.array([u.tag for u in block.units if u.last], ids), *[pa.array(x[whole]) for x in out]], names=["doc_id", "n_words", "n_features", "weight"])

    return dense(docs.select("doc_id", "text")).mapInArrow(run, schema)


def noise(seed: int):
    """Gumbel noise of a document, in thousandths, fixed by the seed and doc_id."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.ln(-F.ln((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


def resample(spark: SparkSession, docs: DataFrame, target: DataFrame, options: Options = Options(), limit: int = BLOCK) -> DataFrame:
    """(doc_id, n_words, n_features, weight, score, rank) of every row of docs; rank counts the drawn
    documents from 1, highest score first, ties to the smaller doc_id, and is null for the others."""
    scratch = Scratch(spark, "resampling", docs)
    gain = gains(bucket_counts(docs, options, limit), bucket_counts(target, options, limit))
    rows = weights(docs, gain, options, limit).withColumn("score", F.col("weight") + noise(options.seed))
    rows = rows.withColumn("drawable", F.col("n_words") >= options.min_words).withColumn("place", F.monotonically_increasing_id())
    rows = scratch.store(rows, "scores")
    size = rows.where("drawable").count() * options.percent // 100
    order = [F.desc("drawable"), F.desc("score"), F.asc("doc_id"), F.asc("place")]
    out = numbered(rows, order, "number", ranges=scratch.width)
    rank = F.when(F.col("drawable") & (F.col("number") < size), F.col("number") + 1)
    return scratch.finish(out.select("doc_id", "n_words", "n_features", "weight", "score", rank.alias("rank")))
