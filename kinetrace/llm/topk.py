"""Exact top-k by inner product: tiles of queries and candidates, partial selection per tile, and a
tree merge of the per-query lists.

Vectors are turned into integers floor(1024 * x), held within 64 bits. Tiles are matrix products in
float64 where every sum is below 2 ** 53 and so exact, else in Python integers. Ties go to the smaller
vec_id. A tile is as large as a task's memory allows, since each vector is sent once for each tile
that it is in; within it, queries are taken a few hundred at a time.

Defined cases: vectors null or holding null or non-finite components take no part; a candidate
whose length differs from the query's is skipped; a null vec_id is no query and, as a candidate, comes last
among ties; of rows that repeat a query's vec_id and vector exactly one counts as the query's own,
the others are candidates, and each repeated query row gets the same answer once; an empty table
gives an empty result; components and scores beyond 64 bits count as the largest 64-bit number of
their sign; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import Scratch

SCALE = 1024
TILE_ROWS = 16384
TILE_QUERIES = 16384
#: Queries of a tile whose scores are held at a time.
SCORED = 256
FAN_IN = 32


def integer_vectors(table: DataFrame) -> DataFrame:
    """(vec_id, v array<long>) of the rows that take part."""
    x = F.col("embedding")
    good = x.isNotNull() & F.forall(x, lambda e: F.coalesce(F.abs(e.cast("double")) < float("inf"), F.lit(False)))
    return table.where(good).select(F.col("vec_id").cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("long")).alias("v"))


def tile_scores(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer products of all queries with all candidates."""
    if not q.size or not c.size:
        return np.zeros((len(q), len(c)), np.int64)
    far = lambda x: max(int(x.max()), -int(x.min()))
    if far(q) * far(c) * q.shape[1] < 2**53:
        return (q.astype(np.float64) @ c.astype(np.float64).T).astype(np.int64)
    info = np.iinfo(np.int64)
    return np.clip(q.astype(object) @ c.astype(object).T, info.min, info.max).astype(np.int64)


def tile_top(queries: pd.DataFrame, cands: pd.DataFrame, k: int) -> list[tuple]:
    """The k best candidates of each query in this tile."""
    out: list[tuple] = []
    for width, qs in queries.groupby(queries["v"].map(len), sort=True):
        cs = cands[cands["v"].map(len) == width]
        if cs.empty:
            continue
        null = cs["vec_id"].isna().to_numpy()
        ids = cs["vec_id"].fillna(0).to_numpy(np.int64)
        order = np.lexsort((ids, null))
        ids, null = ids[order], null[order]
        c = np.stack([np.asarray(v, np.int64) for v in cs["v"].to_numpy()[order]]) if width else np.zeros((len(cs), 0), np.int64)
        q = np.stack([np.asarray(v, np.int64) for v in qs["v"]]) if width else np.zeros((len(qs), 0), np.int64)
        for i, (query, copy) in enumerate(zip(qs["vec_id"].to_numpy(np.int64), qs["copy"].to_numpy(np.int64))):
            if i % SCORED == 0:
                scores = tile_scores(q[i : i + SCORED], c)
            row = scores[i % SCORED]
            lo, hi = np.searchsorted(ids[~null], query, "left"), np.searchsorted(ids[~null], query, "right")
            own = next((j for j in range(lo, hi) if (c[j] == q[i]).all()), -1)
            take = np.ones(len(row), bool)
            if own >= 0:
                take[own] = False
            n = int(take.sum())
            if n > k:
                kth = np.partition(row[take], n - k)[n - k]
                take &= row >= kth
            at = np.flatnonzero(take)
            # Candidates stand by vec_id, so a stable sort by falling score breaks ties as wanted.
            at = at[np.argsort(-row[at], kind="stable")][:k]
            out += [(int(query), int(copy), None if null[j] else int(ids[j]), int(row[j])) for j in at]
    return out


def top_k(spark: SparkSession, table: DataFrame, is_query, k: int = 10, tile_rows: int = TILE_ROWS, tile_queries: int = TILE_QUERIES) -> DataFrame:
    """(query_id, copy, rank, vec_id, score) for the rows that `is_query` selects, against all rows.

    Both sides are cut into blocks by a hash of vec_id; a tile is a pair of blocks, and each side is
    dealt to its tiles by an equi-join on the tile. A task holds one tile.
    """
    scratch = Scratch(spark, "topk", table)
    vectors = scratch.keep(integer_vectors(table), "vectors")
    queries = vectors.where(is_query).withColumn("copy", F.row_number().over(W.partitionBy("vec_id").orderBy("v")) - 1)
    queries = scratch.store(queries, "queries")  # also gives its columns names of their own
    n, m = vectors.count(), queries.count()
    n_blocks, q_blocks = max(1, -(-n // tile_rows)), max(1, -(-m // tile_queries))
    # Rows of one vec_id may be many, so they are dealt by vector too; a query's own row has both.
    c_block = F.pmod(F.xxhash64("vec_id", "v"), F.lit(n_blocks)).cast("int")
    q_block = F.pmod(F.xxhash64("vec_id", "copy"), F.lit(q_blocks)).cast("int")
    # The query's own row is in the block that holds the query's own hash, and only there.
    cands = vectors.withColumn("cb", c_block).withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(q_blocks - 1))))
    asks = queries.withColumn("qb", q_block).withColumn("cb", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))

    def tile(q: pd.DataFrame, c: pd.DataFrame) -> pd.DataFrame:
        if q.empty or c.empty:
            return pd.DataFrame({"query_id": [], "copy": [], "vec_id": [], "score": [], "cb": []})
        out = pd.DataFrame(tile_top(q, c, k), columns=["query_id", "copy", "vec_id", "score"])
        return out.assign(vec_id=out["vec_id"].astype("Int64"), cb=int(c["cb"].iloc[0]))

    tops = asks.groupBy("qb", "cb").cogroup(cands.groupBy("qb", "cb")).applyInPandas(tile, "query_id long, copy int, vec_id long, score long, cb long")
    best = [F.desc("score"), F.asc_nulls_last("vec_id")]
    width = n_blocks
    while width > FAN_IN:
        width = -(-width // FAN_IN)
        node = F.floor(F.col("cb") / FAN_IN).cast("long")
        tops = tops.withColumn("cb", node)
        tops = tops.withColumn("rank", F.row_number().over(W.partitionBy("query_id", "copy", "cb").orderBy(*best))).where(F.col("rank") <= k).drop("rank")
    tops = tops.withColumn("rank", F.row_number().over(W.partitionBy("query_id", "copy").orderBy(*best))).where(F.col("rank") <= k)
    return scratch.finish(tops.select("query_id", "copy", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
