"""Near-duplicate detection: banded MinHash, odd sketches, exact confirmation, components.

1. Each text becomes the set of fingerprints of its distinct word shingles. Of 512 MinHash samples 96
   give 24 band keys, and all are folded into a parity bitmap (odd sketch): each toggles one bit.
2. Texts of equal sets are one class with a representative; classes meet in band buckets.
3. The first round pairs each member of a bucket with the bucket's smallest id. The population count
   of two sketches' XOR estimates a pair's similarity; pairs far below the threshold end there, and
   the others are confirmed on the full sets.
4. Buckets that still hold documents of several labels (smallest linked ids) are searched tile by
   tile. A tile first compares sketches and keeps the members that have a partner under another label;
   their texts are then dealt to the tile, which confirms on full sets, joins what it links in a
   union-find, and emits the links that joined something: fewer than it has members. So every pair
   that shares a bucket is linked, found unlike, or already connected, and no pairs leave a tile.
5. Components come from alternating large-star and small-star rounds on tables, over representatives.

Two texts at the threshold of 0.8 share no bucket with a probability of (1 - 0.8^4)^24 = 3e-6; the
sketch test stops them with a probability of 1e-8 at most.

Defined cases: texts null, empty or without a word have no shingles and link with nothing; texts with
fewer words than a shingle are one shingle of all their words; rows with a null id are linked with
nothing, keep a null component, and stay; rows that repeat an id are one node; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, Scratch, fresh, join_groups, mix, prefix_hash, range_hash, small, spans_of, utf8

BANDS, ROWS = 24, 4
SAMPLES = 512
SKETCH_BITS = 2048
#: Probability that the sketch test stops a pair at the threshold.
MISS = 1e-8
WORDS = 5
#: Per cent.
THRESHOLD = 80
#: Members, and their shingles, of one side of a tile.
TILE, TILE_SHINGLES = 1024, 1 << 21
#: Members of one centre that are confirmed together.
CONFIRM_ROWS = 256
BLOCK = 1 << 19

_rng = np.random.default_rng(20240229)
XOR = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32)
MUL = _rng.integers(0, 1 << 32, SAMPLES, dtype=np.uint64).astype(np.uint32) | np.uint32(1)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


@lru_cache
def sketch_limit(threshold: int) -> int:
    """The least XOR count that a pair at the threshold exceeds with a probability of MISS at most:
    of the exact distribution, where the number of differing samples is binomial and each of them
    toggles two bits, which may cancel others."""
    s = threshold / 100
    share = [comb(SAMPLES, d) * (1 - s) ** d * s ** (SAMPLES - d) for d in range(SAMPLES + 1)]
    odd = np.arange(SKETCH_BITS + 1) / SKETCH_BITS
    now, mixed = np.zeros(SKETCH_BITS + 1), np.zeros(SKETCH_BITS + 1)
    now[0] = 1
    for p in share:
        mixed += p * now
        for _ in range(2):
            now = np.append(0, (now * (1 - odd))[:-1]) + np.append((now * odd)[1:], 0)
    above = np.append(mixed[::-1].cumsum()[::-1][1:], 0)
    return int(np.argmax(above <= MISS))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of the words, A-Z lower-cased, of the concatenated texts, and each text's first
    word (n+1 offsets)."""
    low = LOWER[data]
    gap = SPACE[low]
    edge = np.zeros(len(low) + 1, bool)
    edge[offsets] = True
    inside = ~gap
    before = np.concatenate([[True], gap[:-1]]) | edge[:-1] if len(low) else np.zeros(0, bool)
    after = np.concatenate([gap[1:], [True]]) | edge[1:] if len(low) else np.zeros(0, bool)
    starts, ends = np.flatnonzero(inside & before), np.flatnonzero(inside & after) + 1
    out = np.empty(len(starts), np.uint64)
    i = 0
    while i < len(starts):  # runs of words within BLOCK bytes
        j = max(int(np.searchsorted(ends, starts[i] + BLOCK, "right")), i + 1)
        base = starts[i]
        sums = prefix_hash(low[base : ends[j - 1]])
        out[i:j] = range_hash(sums, starts[i:j] - base, ends[i:j] - base)
        i = j
    return out, np.searchsorted(starts, offsets)


def shingle_sets(data: np.ndarray, offsets: np.ndarray, words: int) -> Iterator[np.ndarray]:
    """Each text's distinct shingle fingerprints, sorted."""
    hashes, first = word_hashes(data, offsets)
    n = len(hashes) - words + 1
    step = np.uint64(0xD6E8FEB86659FD93)
    if n > 0:
        acc = np.zeros(n, np.uint64)
        for k in range(words):
            acc = acc * step + hashes[k : k + n]
        acc = mix(acc)
    for a, b in zip(first[:-1], first[1:]):
        if b - a >= words:
            own = np.sort(acc[a : b - words + 1])
            yield own[np.concatenate([[True], own[1:] != own[:-1]])]
        elif b > a:
            one = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                one = one * step + h
            yield mix(one)
        else:
            yield np.zeros(0, np.uint64)


def samples_of(shingles: np.ndarray) -> np.ndarray:
    """The MinHash samples of a set with at least one shingle."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    out = np.full(SAMPLES, 0xFFFFFFFF, np.uint32)
    for i in range(0, len(x), 2048):
        part = (x[i : i + 2048, None] ^ XOR) * MUL
        np.minimum(out, part.min(axis=0), out=out)
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """Texts x bands, from texts x samples."""
    part = samples[:, : BANDS * ROWS].reshape(len(samples), BANDS, ROWS).astype(np.uint64)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), part.shape[:2]).copy()
    for k in range(ROWS):
        key = mix(key * np.uint64(0x9E3779B97F4A7C15) + part[:, :, k])
    return key.view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """Parity bitmaps (texts x bytes): a bit is the parity of the samples that fall on it."""
    n = len(samples)
    place = mix(samples.astype(np.uint64) + (np.arange(SAMPLES, dtype=np.uint64) << np.uint64(32))) % np.uint64(SKETCH_BITS)
    at = place.astype(np.int64) + np.arange(n)[:, None] * SKETCH_BITS
    parity = np.bincount(at.ravel(), minlength=n * SKETCH_BITS) & 1
    return np.packbits(parity.astype(np.uint8).reshape(n, SKETCH_BITS), axis=1)


def similarity_estimate(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity from the XOR counts of odd sketches (rows of bytes)."""
    w = np.bitwise_count(a ^ b).sum(axis=-1)
    return 1 + SKETCH_BITS / (4 * SAMPLES) * np.log(np.maximum(1 - 2 * w / SKETCH_BITS, 1e-9))


SIGNATURE = "doc_id long, n_shingles long, set_a long, set_b long, bands array<long>, sketch binary"


def signatures(docs: DataFrame, words: int) -> DataFrame:
    """One row per document; set_a and set_b together are a 128-bit digest of its set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            data, offsets = utf8(batch.column(1))
            for i, j in spans_of(offsets, BLOCK):
                own = offsets[i : j + 1] - offsets[i]
                sizes, tops, digest = [], [], []
                for s in shingle_sets(data[offsets[i] : offsets[j]], own, words):
                    sizes.append(len(s))
                    tops.append(samples_of(s) if len(s) else np.zeros(SAMPLES, np.uint32))
                    digest.append((s.sum(dtype=np.uint64), mix(s ^ np.uint64(0xABCDEF)).sum(dtype=np.uint64)))
                tops = np.stack(tops)
                keys, maps = band_keys(tops), odd_sketches(tops)
                digest = np.array(digest, np.uint64).view(np.int64)
                bands = pa.ListArray.from_arrays(pa.array(np.arange(0, keys.size + 1, BANDS), pa.int32()), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(i, j - i), pa.array(sizes, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]), bands, pa.array([m.tobytes() for m in maps], pa.binary())],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "bands", "sketch"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SIGNATURE)


def near_pairs(pairs: DataFrame, limit: int) -> DataFrame:
    """Pairs (a, b, sa, sb) whose sketches differ in `limit` bits at most, as (a, b)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(k).to_pylist()), np.uint64).reshape(batch.num_rows, -1) for k in (2, 3))
            keep = np.bitwise_count(x ^ y).sum(axis=1) <= limit
            yield pa.RecordBatch.from_arrays([batch.column(k).filter(pa.array(keep)) for k in (0, 1)], names=["a", "b"])

    return pairs.select("a", "b", "sa", "sb").mapInArrow(run, "a long, b long")


def groups_in(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Runs of rows with equal first `keys` columns, of batches that come sorted by them."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        cols = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(keys)]
        cuts = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols], axis=0)) + 1
        bounds = [0, *cuts.tolist(), n]
        for i, j in zip(bounds[:-1], bounds[1:]):
            key = tuple(c[i] for c in cols)
            if key != last and held:
                yield pa.Table.from_batches(held)
                held = []
            last = key
            held.append(batch.slice(i, j - i))
    if held:
        yield pa.Table.from_batches(held)


def asked_texts(ids: DataFrame, docs: DataFrame) -> DataFrame:
    """(doc_id, text) of the ids. While they are few they travel to the texts, so that only texts asked
    for are dealt."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.join(F.broadcast(ids), "doc_id", "left_semi") if ids.count() <= BROADCAST_ROWS else texts


def confirmed(spark: SparkSession, pairs: DataFrame, docs: DataFrame, words: int, threshold: int) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold. b is the centre; a centre's members are
    confirmed CONFIRM_ROWS or so at a time, so a centre of many is spread over many groups."""
    heavy = pairs.groupBy("b").agg(F.count("*").alias("n"))
    parts = F.ceil(F.col("n") / CONFIRM_ROWS).cast("int")
    salted = pairs.join(heavy, "b").withColumn("part", F.pmod(F.xxhash64("a"), parts).cast("int"))
    members = salted.select(F.xxhash64("b", "part").alias("g"), F.col("b").alias("centre"), F.lit(1).alias("role"), F.col("a").alias("doc_id"))
    centres = members.select("g", "centre").distinct().select("g", "centre", F.lit(0).alias("role"), F.col("centre").alias("doc_id"))
    asked = members.unionByName(centres)
    texts = asked_texts(asked.select("doc_id").distinct(), docs)
    rows = asked.join(texts, "doc_id").select("g", "centre", "role", "doc_id", "text")
    rows = rows.repartition("g").sortWithinPartitions("g", "centre", "role", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_in(batches, 2):
            data, offsets = utf8(group.column(4))
            centre = int(group.column(1)[0].as_py())
            role, ids = group.column(2).to_numpy(), group.column(3).to_numpy()
            held: list[np.ndarray] = []
            linked = set()
            at = 0
            for i, j in spans_of(offsets, 4 * BLOCK):
                for s in shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words):
                    if role[at] == 0:
                        held.append(s)
                    else:
                        for c in held:
                            both = len(np.intersect1d(c, s, assume_unique=True))
                            if both and 100 * both >= threshold * (len(c) + len(s) - both):
                                linked.add(int(ids[at]))
                    at += 1
            if linked:
                own = sorted(linked)
                yield pa.RecordBatch.from_arrays([pa.array(own, pa.int64()), pa.array([centre] * len(own), pa.int64())], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(doc_id, component_id) of every id on an edge (a, b), the smallest id it reaches."""
    total = edges.count()
    now = edges.where("a != b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now = scratch.store(now, f"{name}-0", total)
    turn, before = 0, None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).withColumn("m", F.least("u", "m"))
        large = join_groups(both.where("v > u"), low, ["u"], "n", 2 * total).select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = scratch.store(large, f"{name}-large-{turn}", total)
        low = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        few = join_groups(large, low, ["u"], "n", total)
        following = few.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        turn += 1
        now = scratch.store(following, f"{name}-{turn}", total)
        mark = now.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == before:
            break
        before, total = mark, mark.n
    out = now.select(F.col("u").alias("doc_id"), F.col("v").alias("component_id"))
    return out.unionByName(now.select(F.col("v").alias("doc_id"), F.col("v").alias("component_id")).distinct())


def linked_labels(links: DataFrame, scratch: Scratch, rows: int) -> DataFrame:
    """(doc_id, comp): for each linked id a smaller id that it is connected with, by the smallest link
    and that one's smallest link. Equal labels mean connected, different ones nothing."""
    first = scratch.store(links.groupBy("a").agg(F.min("b").alias("p")), "first-labels", rows)
    above = first.join(first.select("p").distinct().select(F.col("p").alias("a")), "a", "left_semi").select(F.col("a").alias("p"), F.col("p").alias("pp"))
    above = scratch.store(above, "second-labels", rows)
    return first.join(small(above), "p", "left").select(F.col("a").alias("doc_id"), F.coalesce("pp", "p").alias("comp"))


TILE_COLUMNS = ("g", "own", "key", "doc_id", "comp", "sketch", "bands")


def mixed_tiles(members: DataFrame, labels: DataFrame, sketches: DataFrame, scratch: Scratch) -> DataFrame:
    """TILE_COLUMNS of the buckets that hold several labels. Small buckets are one tile; of large ones,
    tiles of the smallest member's label (A) meet tiles of the others (B), and these each other. `own`
    numbers a tile's sides: those of A -1, -2, ..., those of B 0, 1, ..."""
    marked = members.join(labels, "doc_id", "left").select("key", "doc_id", F.coalesce("comp", "doc_id").alias("comp"))
    marked = scratch.keep(marked, "marked")
    stats = marked.groupBy("key").agg(F.count("*").alias("m"), F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.min_by("comp", "doc_id").alias("main"))
    stats = scratch.keep(stats.where("lo != hi").select("key", "m", "main"), "mixed")
    rows = join_groups(marked, stats, ["key"], "m", marked.count(), "inner")
    rows = rows.withColumn("is_a", F.col("comp") == F.col("main")).drop("m", "main")
    rows = scratch.keep(rows.join(sketches, "doc_id"), "mixed-rows")
    parts = lambda own: F.ceil(F.greatest(F.sum(own.cast("long")) / TILE, F.sum(F.when(own, F.col("n_shingles")).otherwise(0)) / TILE_SHINGLES)).cast("int")
    sizes = rows.groupBy("key").agg(F.count("*").alias("m"), F.sum("n_shingles").alias("total"), parts(F.col("is_a")).alias("na"), parts(~F.col("is_a")).alias("nb"))
    sizes = scratch.keep(sizes.where((F.col("m") > TILE) | (F.col("total") > TILE_SHINGLES)).drop("total"), "tile-sizes")
    spread = join_groups(rows, sizes, ["key"], "m", rows.count())
    mine = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.when(F.col("is_a"), F.col("na")).otherwise(F.col("nb"))).cast("int")
    own = F.when(F.col("na").isNull(), 0).when(F.col("is_a"), -mine - 1).otherwise(mine)
    span = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    to_b, to_a = span(F.col("nb")), F.transform(span(F.col("na")), lambda x: -x - 1)
    meet = F.when(F.col("na").isNull(), F.array(F.lit(0))).when(F.col("is_a"), to_b).otherwise(F.concat(to_a, to_b))
    spread = spread.withColumn("own", own.cast("int")).withColumn("meet", F.explode(meet))
    return spread.withColumn("g", F.xxhash64("key", F.least("own", "meet"), F.greatest("own", "meet"))).select(*TILE_COLUMNS)


class Tile:
    """The members of one tile, as their columns; rows are sorted by side."""

    def __init__(self, group: pa.Table, limit: int):
        own, key, self.ids, self.comp = (group.column(k).to_numpy() for k in range(1, 5))
        self.maps = np.frombuffer(b"".join(group.column(5).to_pylist()), np.uint64).reshape(len(self.ids), -1)
        lists = group.column(6).combine_chunks()
        self.bands = lists.values.to_numpy()[lists.offsets[0].as_py() : lists.offsets[-1].as_py()].reshape(len(self.ids), BANDS)
        self.band = int(np.argmax(self.bands[0] == key[0]))
        self.first = own == own[0]
        self.limit = limit

    def candidates(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(p, q) places of pairs that are to be confirmed, block by block: under different labels,
        passed by the sketch test, and in this bucket as the first of those that they share."""
        every = np.arange(len(self.ids))
        mine, others = (every, every) if self.first.all() else (every[self.first], every[~self.first])
        for i in range(0, len(mine), 32):
            x = mine[i : i + 32]
            far = np.bitwise_count(self.maps[x][:, None] ^ self.maps[others][None, :]).sum(axis=2)
            ahead = (x[:, None] < others[None, :]) & (self.comp[x][:, None] != self.comp[others][None, :])
            p, q = np.nonzero((far <= self.limit) & ahead)
            p, q = x[p], others[q]
            new = ~(self.bands[p, : self.band] == self.bands[q, : self.band]).any(axis=1)
            yield p[new], q[new]

    def links(self, sets: list[np.ndarray], threshold: int) -> tuple[list[int], list[int]]:
        """Places of confirmed pairs that join two labels which nothing in this tile joined before."""
        size = np.array([len(s) for s in sets])
        ends = np.cumsum(size)
        _, known = np.unique(np.concatenate(sets), return_inverse=True)
        held = np.zeros(len(known) + 1, bool)
        label = np.unique(self.comp, return_inverse=True)[1]
        out_p, out_q = [], []
        for p, q in self.candidates():
            some = (size[p] > 0) & (size[q] > 0)
            p, q = p[some], q[some]
            for i in np.unique(p):
                partners = q[p == i]
                mine = known[ends[i] - size[i] : ends[i]]
                held[mine] = True
                while len(partners := partners[label[partners] != label[i]]):
                    now, partners = partners[:64], partners[64:]
                    n = size[now]
                    at = np.arange(n.sum()) + np.repeat(ends[now] - np.cumsum(n), n)
                    both = np.add.reduceat(held[known[at]].astype(np.int64), np.cumsum(n) - n)
                    for j in now[100 * both >= threshold * (size[i] + n - both)]:
                        if label[i] != label[j]:
                            label[label == label[j]] = label[i]
                            out_p.append(int(i))
                            out_q.append(int(j))
                held[mine] = False
        return out_p, out_q


def with_partners(tiles: DataFrame, limit: int) -> DataFrame:
    """The rows of tiles that have a pair to confirm."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_in(batches, 1):
            tile = Tile(group, limit)
            asked = np.zeros(len(tile.ids), bool)
            for p, q in tile.candidates():
                asked[p] = asked[q] = True
            if asked.any():
                yield from group.filter(pa.array(asked)).to_batches()

    return tiles.repartition("g").sortWithinPartitions("g", "own", "doc_id").mapInArrow(run, tiles.schema)


def tile_links(asked: DataFrame, docs: DataFrame, words: int, threshold: int, limit: int) -> DataFrame:
    """Links (a, b), a > b, that join labels, confirmed on the full sets of the tiles' members."""
    texts = asked_texts(asked.select("doc_id").distinct(), docs)
    rows = asked.join(texts, "doc_id").select(*TILE_COLUMNS, "text").repartition("g").sortWithinPartitions("g", "own", "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in groups_in(batches, 1):
            tile = Tile(group, limit)
            data, offsets = utf8(group.column(len(TILE_COLUMNS)))
            sets: list[np.ndarray] = []
            for i, j in spans_of(offsets, 4 * BLOCK):
                sets += shingle_sets(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], words)
            p, q = tile.links(sets, threshold)
            if p:
                a, b = tile.ids[p], tile.ids[q]
                yield pa.RecordBatch.from_arrays([pa.array(np.maximum(a, b)), pa.array(np.minimum(a, b))], names=["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def near_duplicates(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per document."""
    scratch = Scratch(spark, "minhash", docs)
    limit = sketch_limit(threshold)
    table = scratch.keep(signatures(docs, words), "signatures")
    usable = table.where("doc_id is not null and n_shingles > 0")
    classes = usable.groupBy("set_a", "set_b").agg(F.count("*").alias("copies"), F.min("doc_id").alias("rep"))
    classes = scratch.keep(classes.where("copies > 1"), "classes")
    total = usable.count()
    members = join_groups(usable.select("doc_id", "set_a", "set_b"), classes, ["set_a", "set_b"], "copies", total, "inner")
    repeated = scratch.keep(members.where("doc_id != rep").select("doc_id", "set_a", "set_b", "rep").distinct(), "repeated")
    reps = usable.join(small(repeated.select("doc_id", "set_a", "set_b")), ["doc_id", "set_a", "set_b"], "left_anti")
    reps = scratch.store(reps.select("doc_id", "n_shingles", "bands", "sketch"), "reps")
    sketches = reps.select("doc_id", "n_shingles", "sketch", "bands").distinct()
    bands = reps.select("doc_id", F.explode("bands").alias("key"))
    buckets = bands.groupBy("key").agg(F.count("*").alias("m"), F.min("doc_id").alias("centre"))
    buckets = scratch.keep(buckets.where("m > 1"), "buckets")
    met = scratch.store(join_groups(bands, buckets, ["key"], "m", reps.count() * BANDS, "inner"), "met")
    n_met = met.count()
    pairs = met.where("doc_id != centre").select(F.col("doc_id").alias("a"), F.col("centre").alias("b")).distinct()
    pairs = pairs.join(sketches.select(F.col("doc_id").alias("a"), F.col("sketch").alias("sa")), "a")
    pairs = pairs.join(sketches.select(F.col("doc_id").alias("b"), F.col("sketch").alias("sb")), "b")
    pairs = scratch.store(near_pairs(pairs, limit), "pairs", n_met)
    links = scratch.store(confirmed(spark, pairs, docs, words, threshold), "links", n_met)
    tiles = mixed_tiles(met.where("m > 2").select("key", "doc_id").distinct(), linked_labels(links, scratch, n_met), sketches, scratch)
    asked = scratch.store(with_partners(tiles, limit), "asked", n_met)
    more = scratch.store(tile_links(asked, docs, words, threshold, limit), "more-links", n_met)
    # Copies take their representative's component; an id that names several texts also joins their classes.
    several = usable.groupBy("doc_id").agg(F.min("set_a").alias("lo"), F.max("set_a").alias("hi")).where("lo != hi").select("doc_id")
    joined = repeated.join(several, "doc_id", "left_semi").select(F.col("doc_id").alias("a"), F.col("rep").alias("b"))
    labels = components(links.unionByName(more).unionByName(joined), scratch, "cc")
    own = classes.join(labels.withColumnRenamed("doc_id", "rep"), "rep", "left")
    own = scratch.keep(own.select("set_a", "set_b", "copies", F.coalesce("component_id", "rep").alias("of_class")), "class-labels")
    rows = table.select("doc_id", "n_shingles", "set_a", "set_b")
    out = join_groups(rows.where("doc_id is not null"), own, ["set_a", "set_b"], "copies", total).join(labels, "doc_id", "left")
    comp = F.coalesce("component_id", "of_class", "doc_id")
    out = out.select("doc_id", "n_shingles", comp.alias("component_id"), comp.eqNullSafe(F.col("doc_id")).alias("kept"))
    nameless = rows.where("doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(True).alias("kept"))
    return scratch.finish(out.unionByName(nameless))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, words: int = WORDS, threshold: int = THRESHOLD) -> DataFrame:
    """docs with one document of each group, all columns as they were. Up to BROADCAST_ROWS dropped ids
    travel to the texts; beyond that the join shuffles the texts once."""
    scratch = Scratch(spark, "minhash-drop", docs)
    gone = fresh(docs, "lost")
    lost = near_duplicates(spark, docs, words, threshold).where(~F.col("kept")).select(F.col("doc_id").alias(gone)).distinct()
    return docs.join(small(scratch.store(lost, "lost")), F.col("doc_id") == F.col(gone), "left_anti")
